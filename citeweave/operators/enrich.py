"""Restriction of the citation graph to a domain on both ends, and the metadata joins onto it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.text import section_bucket
from citeweave.functions.values import first_truthy, truthy

#: Ids of 8 bytes that a broadcast may hold (some 100 MB built); beyond, semi-joins are shuffled.
MOST_IDS = 2_000_000


def domain_ids(metrics: DataFrame, flag: str = "is_clinical") -> DataFrame:
    """Distinct ids with the flag; the filter and the two columns reach the Parquet scan."""
    return metrics.filter(F.col(flag)).select("pmid").filter("pmid is not null").distinct()


def small(ids: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """``ids`` with a broadcast hint if it is small enough, by count."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def usable(references: Column) -> Column:
    """References with an id and a pmid, the last one first, so that the first of an id is its last."""
    return F.reverse(F.filter(references, lambda r: truthy(r["ref_id"]) & truthy(r["pmid"], "number")))


def found(backwards: Column, keys: Column, ref_id: Column) -> Column:
    """The reference with an id, of ``usable`` ones and their ids ``keys``; null without one."""
    return F.get(backwards, (F.array_position(keys, ref_id) - 1).cast("int"))


def edges(articles: DataFrame, ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A row for each reference of each citation event of an article in the domain that leads to a cited pmid in the domain.

    References are found inside the row, before anything is exploded: no join by article, and no row carries all references.
    ``known`` (pmid, a) is what is known of the citing articles; it is joined before the explosion too, once for each article.
    """
    citing = articles.join(ids, "pmid", "left_semi")
    citing = citing.join(known, "pmid", "left") if known is not None else citing
    citing = citing.withColumn("refs", usable(F.col("references"))).withColumn("keys", F.col("refs.ref_id"))
    led = F.transform("citations", lambda e: F.transform(e["ref_ids"], lambda i: F.struct(e.alias("e"), found(F.col("refs"), F.col("keys"), i).alias("ref"))))
    led = F.filter(F.flatten(led), lambda x: x["ref"].isNotNull())
    each = citing.select("pmcid", F.col("pmid").alias("citing_pmid"), "doi", "title", "journal", "year", "license", "subset", *(["a"] if known is not None else []), F.inline(led))
    return each.withColumn("pmid", F.col("ref.pmid")).join(ids, "pmid", "left_semi")


def enrich(articles: DataFrame, publications: DataFrame, metrics: DataFrame, flag: str = "is_clinical", keep_rejected: bool = False) -> DataFrame:
    """citing, context, cited of every edge whose cited publication has an abstract.

    ``publications`` and ``metrics`` have one row for each pmid (see ``lookups.last_wins``), else the joins would fan out.  They are
    reduced to the domain first; the wide one is never broadcast by hint.  ``keep_rejected``: also edges without an abstract,
    with ``has_abstract`` to count them by.
    """
    ids = small(domain_ids(metrics, flag))
    known = publications.join(ids, "pmid", "left_semi")
    edge = edges(articles, ids, known.select("pmid", F.struct("title", "journal_title", "pub_year", "mesh_descriptors", "pub_types").alias("a")))
    cited = known.select("pmid", F.struct("doi", "title", "abstract", "journal_title", "pub_year", "mesh_descriptors", "pub_types").alias("b"))
    impact = metrics.filter(F.col(flag)).select("pmid", F.struct("citation_count", "relative_citation_ratio", "nih_percentile", "is_clinical", "is_research_article").alias("icite"))
    has = F.coalesce(F.trim("b.abstract") != "", F.lit(False))
    rows = edge.join(cited, "pmid", "left" if keep_rejected else "inner")
    rows = rows if keep_rejected else rows.filter(has)
    rows = rows.join(impact, "pmid", "left")
    # Names of the fields, and which of two sources comes first.
    out = rows.select(
        F.struct(
            "pmcid",
            F.col("citing_pmid").alias("pmid"),
            "doi",
            first_truthy(F.col("title"), F.col("a.title")).alias("title"),
            first_truthy(F.col("journal"), F.col("a.journal_title")).alias("journal"),
            first_truthy(F.col("year"), F.col("a.pub_year"), kind="number").alias("year"),
            "license",
            "subset",
            F.col("a.mesh_descriptors").alias("mesh"),
            F.col("a.pub_types").alias("pub_types"),
        ).alias("citing"),
        F.struct(
            F.col("e.section").alias("section"),
            section_bucket(F.col("e.section")).alias("section_bucket"),
            F.col("e.paragraph_idx").alias("paragraph_idx"),
            F.col("e.in_table").alias("in_table"),
            F.col("e.in_fig").alias("in_fig"),
            F.col("e.sentence").alias("evidence_sentence"),
            F.size("e.ref_ids").alias("n_co_cited_refs"),
            F.col("e.ref_ids").alias("co_cited_ref_ids"),
        ).alias("context"),
        F.struct(
            F.col("ref.ref_id").alias("ref_id"),
            "pmid",
            first_truthy(F.col("ref.doi"), F.col("b.doi")).alias("doi"),
            first_truthy(F.col("b.title"), F.col("ref.title")).alias("title"),
            F.col("b.abstract").alias("abstract"),
            first_truthy(F.col("b.journal_title"), F.col("ref.journal")).alias("journal"),
            first_truthy(F.col("b.pub_year"), F.col("ref.year"), kind="number").alias("year"),
            F.col("b.mesh_descriptors").alias("mesh"),
            F.col("b.pub_types").alias("pub_types"),
            "icite",
        ).alias("cited"),
        has.alias("has_abstract"),
    )
    return out if keep_rejected else out.drop("has_abstract")


def edge_counts(rows: DataFrame) -> DataFrame:
    """Of rows made with ``keep_rejected``: how many were emitted and how many lack an abstract."""
    return rows.agg(F.count_if("has_abstract").alias("n_emitted"), F.count_if(~F.col("has_abstract")).alias("n_no_abstract"))
