"""One canonical row per key, stratified samples, and hash splits."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions.text import design_bucket, hash_share, record_id, record_key, report_stratum, specialty_bucket, stratum
from citeweave.functions.values import or_empty
from citeweave.operators.enrich import small

#: Fixed value: strata in the order in which cells are planned.
STRATA = ("match_strong", "match_moderate", "match_weak", "mismatch", "ambiguous")
#: Fixed value: what stands for a missing article id in the split.
NO_ARTICLE = "__NULL_PMCID__"
#: Cells of a plan that is drawn on the driver.
MOST_CELLS = 10_000


def with_key(results: DataFrame) -> DataFrame:
    i = F.col("input")
    return results.withColumn("record_key", record_key(i["citing"]["pmcid"], i["cited"]["pmid"], i["context"]["paragraph_idx"], i["context"]["evidence_sentence"]))


def tried(attempts: Column) -> Column:
    """Attempts, with none or null behind all others."""
    return F.when(F.coalesce(attempts, F.lit(0)) == 0, 99).otherwise(attempts)


def tier(ok: Column, attempts: Column) -> Column:
    """0, 1, 2 for success at that many attempts less one, 3 for any other success, 4 for failure."""
    return F.when(~F.coalesce(ok, F.lit(False)), 4).when(tried(attempts) <= 3, tried(attempts) - 1).otherwise(3).cast("int")


def best_per_key(rows: DataFrame, key: str = "record_key", order: Sequence[str] = ("tier", "tried", "line_idx")) -> DataFrame:
    """The row of each key that comes first in ``order``: an aggregate, so only one row of a key leaves each task."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*[F.col(f"_r.{c}").alias(c) if c != key else F.col(key) for c in rows.columns])


def ranked_best(rows: DataFrame, key: str = "record_key", order: Sequence[str] = ("tier", "tried", "line_idx")) -> DataFrame:
    """The same by a window, for rows too wide to carry through an aggregate."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")


def deduplicated(results: DataFrame) -> DataFrame:
    """Extraction results with line_idx, one for each record key."""
    graded = with_key(results).withColumn("tier", tier(F.col("ok"), F.col("attempts"))).withColumn("tried", tried(F.col("attempts")))
    return best_per_key(graded).drop("tier", "tried")


def drop_counts(rows: DataFrame, key: str = "record_key") -> DataFrame:
    n, u = F.count(F.lit(1)), F.count_distinct(F.coalesce(key, F.lit("None")))
    return rows.agg(n.alias("total"), u.alias("n_unique"), (n - u).alias("dropped"), F.round(F.try_divide(F.lit(100.0) * (n - u), n), 6).alias("dropped_pct"))


# Stratified sampling.


def strata_of(results: DataFrame) -> DataFrame:
    """Successful rows with stratum, design, specialty."""
    x = F.col("extracted")
    good = results.filter(F.coalesce("ok", F.lit(False)))
    return good.select("*", stratum(x["relevance_check"], x["support_strength"]).alias("stratum"), design_bucket(x["cited_study_design"]).alias("design"), specialty_bucket(F.col("input.cited.mesh")).alias("specialty"))


def cells(rows: DataFrame, by: Sequence[str], position: str = "line_idx") -> DataFrame:
    """Population of each cell and the position at which it is first seen."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("pop"), F.min(position).alias("first_seen"))


def allocated(population: DataFrame, stratum_column: str, target: int | Column) -> DataFrame:
    """Largest-remainder seats: ``n`` for each cell, so that a stratum gets ``target``, or all it has.

    One pass is enough: where the stratum exceeds the target, a cell's share is below its population, and fewer seats
    are left over than there are cells.  Among equal remainders the cell seen first comes first.
    """
    by = Window.partitionBy(stratum_column)
    target = F.lit(target).cast("double") if isinstance(target, int) else target.cast("double")
    total = F.sum("pop").over(by)
    raw = target * F.col("pop") / F.col("_total")
    rows = population.withColumn("_total", total).withColumn("_raw", raw).withColumn("_floor", F.floor("_raw"))
    left = target - F.sum("_floor").over(by)
    place = F.row_number().over(by.orderBy(F.desc(F.col("_raw") - F.col("_floor")), "first_seen"))
    seats = F.when(F.col("_total") <= target, F.col("pop")).otherwise(F.col("_floor") + (place <= left).cast("int"))
    return rows.withColumn("n", seats.cast("bigint")).drop("_total", "_raw", "_floor")


def exact_draw(plan: DataFrame, by: Sequence[str], seed: int, strata: Sequence[str] = STRATA) -> DataFrame:
    """Ranks drawn for each cell of a plan by one generator that goes through the cells in planned order.

    The plan has a row for each cell, ``MOST_CELLS`` at most, and is the only thing that reaches the driver.
    """
    if plan.limit(MOST_CELLS + 1).count() > MOST_CELLS:
        raise ValueError(f"the plan has more than {MOST_CELLS} cells; sampled_by_hash draws without the driver")
    rows = plan.collect()
    rows.sort(key=lambda r: (strata.index(r[by[0]]) if r[by[0]] in strata else len(strata), r["first_seen"]))
    rng, out = random.Random(seed), []
    for r in rows:
        if r["n"]:
            out += [(*[r[c] for c in by], k + 1) for k in rng.sample(range(r["pop"]), r["n"])]
    return plan.sparkSession.createDataFrame(out, plan.select(*by, F.lit(1).alias("rank")).schema)


def sampled_exactly(rows: DataFrame, by: Sequence[str], target: int, seed: int, position: str = "line_idx", strata: Sequence[str] = STRATA) -> DataFrame:
    """Rows drawn without replacement from each cell by rank of position (unique); only cells and positions are ranked, not whole rows."""
    known = rows.filter(F.col(by[0]).isNotNull())
    plan = allocated(cells(known, by, position), by[0], target)
    picked = exact_draw(plan, by, seed, strata)
    ranked = known.select(*by, position).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(position)))
    drawn = ranked.join(F.broadcast(picked), [*by, "rank"], "left_semi").select(position)  # target rows a stratum at most
    return known.join(small(drawn), position, "left_semi").select(rows.columns)


def sampled_by_hash(rows: DataFrame, by: Sequence[str], target: int, seed: str, key: str = "record_key", position: str = "line_idx") -> DataFrame:
    """The same sizes with ranks by digest of seed and key: no draw on the driver, stable when rows are added to other cells.

    No cell gives more than ``target`` rows, so each task passes on that many of a cell at most.
    """
    known = rows.filter(F.col(by[0]).isNotNull())
    plan = allocated(cells(known, by, position), by[0], target).select(*by, "n")
    digest = F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256)
    ranked = known.select(*by, position, digest.alias("digest")).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("digest", position))).filter(F.col("rank") <= target)
    drawn = ranked.join(plan, list(by)).filter("rank <= n").select(position)
    return known.join(small(drawn), position, "left_semi").select(rows.columns)


def gold(results: DataFrame, per_stratum: int = 200, seed: int = 20260501, version: str = "v1", exact: bool = True) -> DataFrame:
    """The reference sample in order of stratum and record id, with gold_meta."""
    rows = strata_of(with_key(results))
    by = ("stratum", "design", "specialty")
    picked = sampled_exactly(rows, by, per_stratum, seed) if exact else sampled_by_hash(rows, by, per_stratum, str(seed))
    rid = record_id(F.col("record_key"))
    meta = F.struct(rid.alias("record_id"), "stratum", F.col("design").alias("design_bucket"), F.col("specialty").alias("specialty_bucket"), F.lit(seed).cast("bigint").alias("seed"), F.lit(version).alias("input_version"))
    rank = F.array_position(F.array(*map(F.lit, STRATA)), F.col("stratum"))
    return picked.withColumn("gold_meta", meta).orderBy(rank, "gold_meta.record_id").drop("record_key", "stratum", "design", "specialty")


def unbucketed(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("stratum").isNull()).alias("n_unbucketed"))


def marginals(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts by each of the columns alone, in one pass: column, value, n."""
    one = lambda f: F.coalesce(*[F.when(F.grouping(c) == 0, f(c)) for c in columns])
    found = rows.groupingSets([[F.col(c)] for c in columns], *columns).agg(one(F.lit).alias("dimension"), F.count(F.lit(1)).alias("n"))
    return found.select("dimension", F.coalesce(*[F.when(F.col("dimension") == c, F.col(c).cast("string")) for c in columns]).alias("value"), "n")


# Splits.


def split_of(article: Column, seed: str, val: int = 50, test: int = 100) -> Column:
    """val, test or train by article: all rows of an article have one split; articles without id share one."""
    share = hash_share(seed, F.coalesce(article, F.lit(NO_ARTICLE)))
    return F.when(share < val, "val").when(share < val + test, "test").otherwise("train")


def gold_keys(gold_rows: DataFrame) -> DataFrame:
    return with_key(gold_rows).select("record_key").distinct()


def split_index(results: DataFrame, gold_key_table: DataFrame, seed: str) -> DataFrame:
    """The columns of the split table; failures go before gold, gold before the hash."""
    x, i = F.col("extracted"), F.col("input")
    rows = with_key(results).join(gold_key_table.select("record_key", F.lit(True).alias("is_gold")), "record_key", "left")
    ok = F.coalesce("ok", F.lit(False))
    split = F.when(~ok, "fail").when(F.col("is_gold"), "gold").otherwise(split_of(i["citing"]["pmcid"], seed))
    shown = lambda name: F.when(ok, F.coalesce(x[name], F.lit(""))).otherwise("FAIL").alias(name)
    return rows.select("record_key", F.coalesce(i["citing"]["pmcid"], F.lit("")).alias("citing_pmcid"), or_empty(i["cited"]["pmid"], "number").alias("cited_pmid"), split.alias("split"), shown("relevance_check"), shown("cited_study_design"), shown("support_strength"))


def materialised(results: DataFrame, index: DataFrame) -> DataFrame:
    """Results with their split, by record key; keys must be unique on both sides."""
    return with_key(results).join(index.select("record_key", "split"), "record_key")


def split_sizes(index: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    rows = index.groupBy("split").agg(n.alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # a handful of splits
    rest = F.sum(F.when(~F.col("split").isin("fail", "gold"), F.col("n"))).over(Window.partitionBy(F.lit(0)))
    return rows.select("split", "n", F.round(100.0 * F.col("n") / total, 6).alias("pct"), F.round(F.when(~F.col("split").isin("fail", "gold"), F.try_divide(100.0 * F.col("n"), rest)), 6).alias("pct_of_hashed"))


def crosstab(index: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    return index.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0, list(values))


def split_strata(index: DataFrame) -> DataFrame:
    """Rows of each split and report stratum, failures left out, most first."""
    rows = index.filter("split <> 'fail'").withColumn("stratum", report_stratum(F.col("relevance_check"), F.col("support_strength")))
    return rows.groupBy("split", "stratum").agg(F.count(F.lit(1)).alias("n")).orderBy("split", F.desc("n"), "stratum")


def pools(index: DataFrame) -> DataFrame:
    """Mismatches in each split, and its distinct articles."""
    return index.groupBy("split").agg(F.count_if(F.col("relevance_check") == "mismatch").alias("n_mismatch"), F.count_distinct("citing_pmcid").alias("n_articles"))


def pool_total(index: DataFrame) -> DataFrame:
    """Distinct articles of all rows outside the reference sample, failures left out."""
    return index.filter("split not in ('gold', 'fail')").agg(F.count_distinct("citing_pmcid").alias("n_articles"))


def split_designs(index: DataFrame) -> DataFrame:
    """Rows of each split and study design, failures left out, most first."""
    return index.filter("split <> 'fail'").groupBy("split", "cited_study_design").agg(F.count(F.lit(1)).alias("n")).orderBy("split", F.desc("n"), "cited_study_design")


def torn_articles(index: DataFrame, article: str = "citing_pmcid") -> DataFrame:
    """Articles with rows in more than one hash split; must be empty.  Least and greatest split tell, so nothing is collected."""
    rows = index.filter(~F.col("split").isin("fail", "gold"))
    return rows.groupBy(article).agg(F.min("split").alias("one"), F.max("split").alias("other")).filter("one <> other")


def require_whole_articles(index: DataFrame) -> None:
    torn = torn_articles(index).limit(5).collect()
    if torn:
        raise ValueError(f"articles in more than one split: {[r[0] for r in torn]}")
