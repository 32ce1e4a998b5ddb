"""Counts that accompany a run without a second pass, and marks for reports."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def watched(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows and further sums; ``observation.get`` has them once an action on ``df`` has ended."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]), seen


def hit_counts(rows: DataFrame, ids: DataFrame, key: str = "pmid") -> DataFrame:
    """Rows seen, and how many of them have a key in ``ids`` (distinct)."""
    marked = rows.select(key).join(ids.select(key, F.lit(True).alias("_hit")), key, "left")
    return marked.agg(F.count(F.lit(1)).alias("n_seen"), F.count("_hit").alias("n_hits"))


def seed_mark(seed: str, chars: int = 16) -> str:
    """What a report shows of a seed."""
    return hashlib.sha256(seed.encode()).hexdigest()[:chars]


def most_common(df: DataFrame, column: str, position: str) -> DataFrame:
    """Values by count, the most frequent first; among equals the one seen first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first_seen"))
    return counts.orderBy(F.desc("n"), "first_seen").select(column, "n")


def value_counts(df: DataFrame, *columns: str, none: str = "none") -> DataFrame:
    """Rows by the values of the columns together; null strings are named."""
    kinds = dict(df.dtypes)
    shown = [F.coalesce(c, F.lit(none)).alias(c) if kinds[c] == "string" else F.col(c) for c in columns]
    return df.groupBy(*shown).agg(F.count(F.lit(1)).alias("n"))


def first_where(df: DataFrame, condition: Column, position: str) -> DataFrame:
    """The first row, by position, that meets the condition; each task gives one at most."""
    return df.filter(condition).orderBy(position).limit(1)


def mismatches(df: DataFrame, column: str = "relevance_check") -> DataFrame:
    """The rows whose cited paper doesn't fit the sentence."""
    return df.filter(F.col(column) == "mismatch")
