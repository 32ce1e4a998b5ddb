"""From raw documents to a training mix: quality, exact copies, near copies, benchmark passages, source weights.

Each stage takes (spark, docs, sf_dir) and returns rows of ``documents``; the last one returns each row as often as the
mix takes it, with a further column ``copy``.  Stages are written as Parquet and read again by whoever runs them.

Cases, of all stages.  Further columns stay as they are, whatever their names; if one is called ``copy``, the last stage's own column is ``copy_``.
Rows with null ids are rows like others.  Texts of any length are read whole.  An empty table goes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeweave.llm import decontamination, exact_dedup, jaccard_join, mixing, quality
from citeweave.llm.common import documents, saved


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts.  A null or empty text is scored as a text without words; equal scores stay or go together."""
    return quality.accepted(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text, the one with the smallest id.  Null and empty texts are one text; of repeated rows one stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the 5-word shingle Jaccard join at 0.8, the one with the smallest id.  Texts without words all stay."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.  A text without words has none; with an empty benchmark all stay."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources have their target weights.  A document without words is repeated by its source's factor, rounded down."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]

#: Trained scores, components and random rounding have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
