"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Plan.  One scan gives each row its normalised length and a hash of its first characters.  Lengths that occur once
leave first, then pairs of length and prefix hash that occur once; only rows of the groups that are left have their
full content hashed.  While texts are scanned again, those rows are told by a set of bits of the groups' hashes, broadcast as
``WORDS`` numbers of 64 bits at most, whatever the number of groups; it passes every row of a group that is left, and a part of the others,
which full hashes then part.  All that is shuffled is a few dozen bytes a row, texts never are.  DataFrame functions only.

Cases.  A null text counts as empty, and empty texts are equal to one another.  A very long text is hashed whole.  A null ``doc_id`` comes after all
others; of equal texts with the least id the first row read stays, a tie between rows that don't differ.  Of repeated rows with one id and one text exactly one stays.  An empty table gives an empty result.
Further columns of ``docs`` are not read and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import WORDS, attach_groups, bit_set, documents, keep_rows, row_hash, saved, with_asked, with_uid

#: Runs of white space other than a lone space; the rest is in normal form as it stands.
_RUN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUN, " ")


def exact_dedup(docs: DataFrame, prefix_chars: int = 64, digests: bool = False, uid: Column | None = None, words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, keep_id, group_size, kept, and sha256 (binary).

    ``digests``: give every row its digest.  Without it only rows that survive the length and the prefix stage have
    their whole text hashed, and sha256 is null elsewhere.
    """
    norm = with_uid(docs.select("doc_id", "text"), uid).select("uid", "doc_id", normalised(F.col("text")).alias("_norm"))
    ladder = [F.length("_norm").alias("n_norm"), F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("prefix_hash")]
    full = F.unhex(F.sha2(F.col("_norm").cast("binary"), 256))

    keys = norm.select("uid", "doc_id", *ladder, *([full.alias("sha256")] if digests else []))
    keys = saved(keys, "dedup-keys") if digests else saved(keys.drop("uid", "doc_id"), "dedup-lengths")
    by_prefix = keys.groupBy("n_norm", "prefix_hash").agg(F.count(F.lit(1)).alias("n"))
    by_length = by_prefix.groupBy("n_norm").agg(F.sum("n").alias("n_length")).filter("n_length > 1")
    alive = saved(by_prefix.filter("n > 1").join(by_length, "n_norm", "left_semi").select("n_norm", "prefix_hash", "n"), "dedup-alive")

    if digests:
        total = keys.count()
        rows = attach_groups(keys.withColumn("_k", F.struct("n_norm", "prefix_hash")), alive.select(F.struct("n_norm", "prefix_hash").alias("_k"), "n"), "_k", "n", total)
        rows = rows.select("uid", "doc_id", "sha256", F.col("n").isNotNull().alias("alive"))
    else:
        g = F.xxhash64("n_norm", "prefix_hash")
        rows = with_asked(norm.select("uid", "doc_id", "_norm", *ladder), bit_set(alive, g, words), g, "asked", words)
        rows = rows.select("uid", "doc_id", F.when(F.col("asked"), full).alias("sha256"))
        rows = saved(rows, "dedup-rows").withColumn("alive", F.col("sha256").isNotNull())
        total = rows.count()

    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    groups = rows.filter("alive").groupBy("sha256").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n_group")).filter("n_group > 1")
    groups = saved(groups.select("sha256", "first", "n_group"), "dedup-groups")
    out = attach_groups(rows, groups, "sha256", "n_group", total)
    first = F.col("first").isNull() | ((F.col("first.uid") == F.col("uid")) & F.col("first.doc_id").eqNullSafe(F.col("doc_id")))
    return out.select(
        "uid",
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n_group", F.lit(1)).cast("long").alias("group_size"),
        first.alias("kept"),
        "sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    found = exact_dedup(docs, uid=row_hash())
    return keep_rows(docs, found.select("doc_id", "uid", "kept", (F.col("group_size") > 1).alias("once")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(documents(spark, sf_dir), digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
