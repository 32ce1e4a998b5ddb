"""A bounded sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import bit_set, fresh, is_small, training_row, with_asked


def held_out(doc_id, mod: int = 4, held: int = 2):
    return ~training_row(doc_id, mod, held)


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label of all training ids: one row for each id with one label, 0 or 1."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & training_row(F.col("doc_id"), 4, 2))
    return known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").select("doc_id", "label")


def near_labels(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``docs`` with an id in ``known``, and beyond a million of those ids perhaps others; texts stay where they are.

    So what is made of the rows is to be joined with ``known`` once more.
    """
    if is_small(known):
        return docs.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    asked = fresh(docs, "bit_asked")
    return with_asked(docs, bit_set(known, F.xxhash64("doc_id")), F.xxhash64("doc_id"), asked).filter(asked).drop(asked)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, label, text, and the columns ``also``, of up to ``per_class`` training documents of each label, 0 and 1, in an order by hash.

    Labels of held-out ids are never read further.  Null ids, other labels, and ids with both labels are left out; of
    repeated ids one row stays.  Ids are chosen before texts are read, so the broadcast side has 2 * per_class rows at most.
    """
    known = training_labels(labels, label)
    chosen = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id")).limit(per_class) for k in (0, 1)]
    found = docs.select("doc_id", "text", *also).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    return found.select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text"), *also)
