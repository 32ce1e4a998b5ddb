"""Publication and citation-metric lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions.values import strip_set, truthy, try_int


def first_by_type(ids: Column, kind: str = "doi") -> Column:
    """The value of the first (id_type, value) pair of a type, null without one."""
    return F.get(F.filter(ids, lambda x: F.lower(x["id_type"]) == kind), 0)["value"]


def joined_sections(sections: Column, gap: str = "\n\n") -> Column:
    """Abstract text: sections with text, labelled where they have a label, parted by a blank line; null without any."""
    full = F.filter(sections, lambda s: truthy(s["text"]))
    one = lambda s: F.when(truthy(s["label"]), strip_set(F.concat(s["label"], F.lit(": "), s["text"]), ": ")).otherwise(s["text"])
    return F.nullif(F.array_join(F.transform(full, one), gap), F.lit(""))


def year_of(article_year: Column, journal_year: Column) -> Column:
    return F.when(truthy(article_year), try_int(article_year, "int")).otherwise(try_int(journal_year, "int"))


def bucket(pmid: Column, width: int = 1_000_000) -> Column:
    """Ids by millions, towards zero."""
    return F.call_function("div", pmid, F.lit(width)).cast("int")


def publications(source: DataFrame) -> DataFrame:
    """The publication lookup of nested source rows; rows without an integer id are left out."""
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    refs = F.coalesce("references", F.array().cast("array<struct<pmid:string,doi:string>>"))
    keep = [c for c in ("src_rank", "src_file", "src_row") if c in source.columns]
    rows = source.select(
        try_int(F.col("pmid")).alias("pmid"),
        first_by_type(F.col("article_ids")).alias("doi"),
        "title",
        joined_sections(F.col("abstract")).alias("abstract"),
        F.col("journal.title").alias("journal_title"),
        F.col("journal.iso_abbrev").alias("journal_iso"),
        year_of(F.col("article_date.year"), F.col("journal.pub_year")).alias("pub_year"),
        F.coalesce("publication_types", empty("string")).alias("pub_types"),
        F.coalesce(F.filter(F.transform("mesh_headings", lambda m: m["descriptor_name"]), lambda m: truthy(m)), empty("string")).alias("mesh_descriptors"),
        F.filter(F.transform(refs, lambda r: try_int(r["pmid"])), lambda x: x.isNotNull()).alias("reference_pmids"),
        F.filter(F.transform(refs, lambda r: r["doi"]), lambda x: truthy(x)).alias("reference_dois"),
        *keep,
    )
    return rows.filter("pmid is not null")


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the last in ``order``; an aggregate, so partial maxima meet before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, *order)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(key, "_r.*")


def latest_publications(source: DataFrame) -> DataFrame:
    return last_wins(publications(source), "pmid", ["src_rank", "src_file", "src_row"])


def sorted_lookup(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in global order of pmid, null last: ranges, each sorted, so that files have narrow statistics."""
    by = F.col("pmid").asc_nulls_last()
    return rows.repartitionByRange(partitions, by).sortWithinPartitions(by) if partitions else rows.orderBy(by)


def pruned(lookup: DataFrame, low: int, high: int) -> DataFrame:
    """Rows with low <= pmid <= high of a lookup partitioned by bucket: the bucket's range is stated, so partitions are pruned."""
    ids = F.col("pmid").between(low, high)
    return lookup.filter(ids & F.col("pmid_bucket").between(low // 1_000_000, high // 1_000_000)) if "pmid_bucket" in lookup.columns else lookup.filter(ids)
