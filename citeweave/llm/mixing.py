"""Mixing sources to target weights by pivotal dependent rounding.

Targets.  The sources, in code-point order with null last, have cyclic weights; they share a budget of words, and a
target never exceeds ``max_copies`` times what its source holds: the excess is shared anew by weight until none is
above.  The sources' table stays distributed; only sums of it reach the driver.

Copies.  Each document of a source has the same fractional number of copies, target / source size.  The integral part
is taken; the fraction is rounded by duels: of two documents, words are moved at random from one to the other so that
expectation and total stay, until one of them is whole.  The rows of a source are numbered by hash of id and text, over ranges of
a distributed sort; each run of ``block`` numbers is a block.  Blocks are rounded side by side and leave one
fraction each; those meet in a reduction tree with ``fan`` children a node.  So a source's words differ from its
target by less than one document.  Numbers and draws come from hashes and places in that order, hence reruns agree, up to
which one of equal rows is which.

Cases.  A null or empty text has size 0 and gives 0 words.  A very long text is one document like others; a source's words may miss its
target by as much as it holds.  Null is a source like any other.  Rows that repeat an id, null ids too, are
mixed as rows of their own, and blocks have no more of them than of others.  An empty table gives an empty result.  Further columns may have any names; if
one is called ``copy``, the mixture's own column has underscores behind its name.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.common import WORD, by_row, documents, fresh, is_small, one_of_equals, row_hash, saved, with_uid

WEIGHTS = (3.0, 1.0, 2.0)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """source, source_size, target of each source of ``sizes`` (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranged = saved(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row for each shuffle partition at most
    offsets, seen = {}, 0
    for row in before:
        offsets[row["part"]], seen = seen, seen + row["n"]
    spark = sizes.sparkSession
    if not offsets:
        return ranged.select("source", "source_size", "n_docs", F.lit(0.0).alias("target"))
    starts = spark.createDataFrame(list(offsets.items()), "part int, start long")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("start")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    table = saved(ranged.join(F.broadcast(starts), "part").select("source", "source_size", "n_docs", weight.alias("weight"), (F.col("source_size") * max_copies).alias("most")), "mix-weights")
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    # A source whose most / weight is below the level is full.  Each round fills those below and raises the level for the rest.
    level, full = 0.0, -1
    while True:
        row = table.agg(
            F.sum(F.when(F.col("most") <= F.col("weight") * level, F.col("most")).otherwise(0.0)).alias("held"),
            F.sum(F.when(F.col("most") <= F.col("weight") * level, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(F.col("most") <= F.col("weight") * level).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (budget - row["held"]) / row["open"]
    return table.select("source", "source_size", "n_docs", F.least(F.col("most"), F.col("weight") * level).alias("target"))


def _duels(sizes: np.ndarray, parts: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds the fractions of one block in order; gives the new fractions and the place of the one that may be left, or -1."""
    parts, left = parts.copy(), -1
    for j in range(len(parts)):
        if not 0.0 < parts[j] < 1.0:
            continue
        if left < 0:
            left = j
            continue
        i, a, b = left, sizes[left], sizes[j]
        up = min((1.0 - parts[i]) * a, parts[j] * b)  # words that i may gain from j
        down = min(parts[i] * a, (1.0 - parts[j]) * b)
        moved = up if draws[j] * (up + down) < down else -down
        parts[i] += moved / a
        parts[j] -= moved / b
        for k in (i, j):
            if parts[k] < 1e-9:
                parts[k] = 0.0
            elif parts[k] > 1.0 - 1e-9:
                parts[k] = 1.0
        left = next((k for k in (i, j) if 0.0 < parts[k] < 1.0), -1)
    return parts, left


def _round_block(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("at", kind="stable")
    block["part"], left = _duels(block["size"].to_numpy(float), block["part"].to_numpy(float), block["unit"].to_numpy(float))
    block["open"] = np.arange(len(block)) == left
    return block


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (uid, source, draw, and more) with ``at``, the place from 0 on within the source by draw.

    Ranges of the order are sorted side by side; a row's place is that within its range plus the sizes of the ranges before
    it.  Equal draws are parted by uid, so a range has no more of them than of others.
    """
    order = [F.col("source").asc_nulls_last(), F.col("draw"), F.col("uid")]
    ranged = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("m", F.monotonically_increasing_id()), "mix-ranges")
    part = F.shiftright("m", 33)
    sizes = ranged.groupBy("source", part.alias("part")).agg(F.min("m").alias("low"), F.count(F.lit(1)).alias("n"))  # a row for each source and range at most
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = saved(sizes.select(F.col("source").alias("s_source"), F.col("part").alias("s_part"), (before - F.col("low")).alias("start")), "mix-starts")
    on = (part == F.col("s_part")) & F.col("source").eqNullSafe(F.col("s_source"))
    return ranged.join(F.broadcast(starts) if is_small(starts) else starts, on).withColumn("at", F.col("m") + F.col("start")).drop("m", "s_source", "s_part", "start")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, max_copies: float = 2.0, block: int = 2048, fan: int = 256, seed: int = 17) -> DataFrame:
    """Per row of ``docs``: uid, row (its hash), doc_id, source, size, source_size, target, copies (int) and taken = size * copies."""
    sizes = with_uid(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), row_hash().alias("row")))
    sizes = saved(sizes, "mix-sizes")
    targets = saved(source_targets(sizes, weights, share, max_copies), "mix-targets")
    known = sizes.join(_spread(targets), F.col("source").eqNullSafe(F.col("t_source")), "left")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(copies + 1e-9)
    part = F.greatest(copies - whole, F.lit(0.0))
    rows = known.select("uid", "row", "doc_id", "source", "size", "source_size", "target", whole.cast("int").alias("whole"), part.alias("part"))

    # Only rows with a fraction meet in duels; documents without words need none.
    level = numbered(rows.filter("size > 0 and part > 0").select("uid", "source", "size", "part", F.xxhash64(F.lit(seed), "row").alias("draw")))
    unit = F.pmod(F.xxhash64(F.lit(seed + 1), "draw", "at"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shape = "uid long, source string, size long, at long, node long, part double, unit double, open boolean"
    level = level.select("uid", "source", "size", "at", F.floor(F.col("at") / block).cast("long").alias("node"), "part", unit.alias("unit"), F.lit(False).alias("open"))
    level = saved(level.groupBy("source", "node").applyInPandas(_round_block, shape), "mix-blocks")
    done = [level.filter("not open").select("uid", "part")]
    nodes = (level.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        level = level.filter("open").withColumn("node", F.floor(F.col("node") / fan).cast("long"))
        level = saved(level.groupBy("source", "node").applyInPandas(_round_block, shape), "mix-tree")
        done.append(level.filter("not open").select("uid", "part"))
        nodes = math.ceil(nodes / fan)
    # One fraction of each source is left: by its own draw it takes a copy or none.
    done.append(level.filter("open").select("uid", F.when(F.col("unit") < F.col("part"), 1.0).otherwise(0.0).alias("part")))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    out = rows.drop("part").join(rounded, "uid", "left")
    copies = (F.col("whole") + F.coalesce(F.round("part"), F.lit(0.0))).cast("int")
    return out.select("uid", "row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def _spread(targets: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """The sources' table as the side of a join by source: broadcast up to ``broadcast_rows``; beyond, a shuffled join
    whose skewed partitions adaptive execution splits."""
    side = targets.select(F.col("source").alias("t_source"), "source_size", "n_docs", "target")
    return F.broadcast(side) if targets.limit(broadcast_rows + 1).count() <= broadcast_rows else side


def mixture(docs: DataFrame, copy: str = "copy", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with a column ``copy`` from 1 on.

    Equal rows share their copies: which of them has how many makes no difference.
    """
    n = fresh(docs, "n_copies")
    each = mix(docs, **options).groupBy("doc_id", F.col("row").alias("uid")).agg(F.sum("copies").alias(n), F.count(F.lit(1)).alias("n_rows"))
    taken = saved(each.filter(F.col(n) > 0), "mix-taken")
    rows = by_row(docs, taken.filter("n_rows = 1").drop("n_rows"), "inner")
    more = taken.filter("n_rows > 1").drop("n_rows")
    if not more.isEmpty():
        rows = rows.unionByName(one_of_equals(by_row(docs, more, "inner")))
    return rows.withColumn(fresh(docs, copy), F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).drop(n)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
