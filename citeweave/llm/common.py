"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regular expressions of a word between white space, and of one white-space character.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded(docs: DataFrame, mb: int = 8) -> DataFrame:
    """``docs``, with the session told to hand Python batches of that many MB at most (a longer row comes alone)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", mb << 20)
    return docs


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session in one local JVM (as in tests) may go without that setting; it gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="citeweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/citeweave/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def forget(*tables: DataFrame) -> None:
    """Deletes what ``saved`` wrote for tables that no later plan reads."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def with_uid(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """Adds ``uid``, by default a number of each row, which holds only within one job: save what carries it before use."""
    return docs.withColumn("uid", F.monotonically_increasing_id() if uid is None else uid)


def row_hash() -> Column:
    """A uid that another scan gives again: rows share it only if id and text are the same."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def training_row(doc_id: Column, mod: int, held: int) -> Column:
    """True where crc32 of the id as text leaves another remainder than ``held``; a null id is a training row."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)) != held, F.lit(True))


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, parts: int = 400, how: str = "left") -> DataFrame:
    """``rows`` joined with the one row that ``groups`` has per ``key``, with hot keys split.

    ``size`` is the column of ``groups`` that counts a key's rows.  A key is hot if it holds more than 1/parts of
    ``total`` rows; at most ``parts`` keys can be, so the list of hot keys has a proven bound and is broadcast.
    A hot key's rows go to several salts and its group row is repeated once per salt.
    """
    piece = max(1, math.ceil(total / parts))
    salts = F.ceil(F.col(size) / piece).cast("int")
    hot = groups.filter(F.col(size) > piece).select(F.col(key), salts.alias("_salts"))
    spread = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("uid"), F.col("_salts")).cast("int"))).drop("_salts")
    copies = groups.withColumn("_salt", F.explode(F.when(F.col(size) > piece, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return spread.join(copies, [key, "_salt"], how).drop("_salt")


def is_small(df: DataFrame, rows: int = 1_000_000) -> bool:
    """Whether ``df`` has up to ``rows`` rows, so that a few numbers of each can be broadcast (100 MB at most)."""
    return df.limit(rows + 1).count() <= rows


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it differ from all columns of ``docs``; letters' case makes no difference."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Most rows of a ``bit_set``, each with 64 of its bits: what is broadcast has this bound.
WORDS = 1 << 20


def bit_set(keys: DataFrame, g: Column, words: int = WORDS) -> DataFrame:
    """(word, bits): a set of 64 * ``words`` bits with that of each hash ``g`` set, written to the shared folder."""
    word, bit = _slot(g, words)
    return saved(keys.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")), "bits")


def _slot(g: Column, words: int) -> tuple[Column, Column]:
    return F.pmod(F.shiftright(g, 6), F.lit(words)), F.pmod(g, F.lit(64)).cast("int")


def with_asked(docs: DataFrame, bits: DataFrame, g: Column, name: str, words: int = WORDS) -> DataFrame:
    """``docs`` with ``name``: whether the bit of ``g`` is set.  It is for all hashes of the set, and for others more often the fuller the set is."""
    word, bit = _slot(g, words)
    own_word, own_bits = fresh(docs, "bit_word"), fresh(docs, "bit_bits")
    side = F.broadcast(bits.withColumnsRenamed({"word": own_word, "bits": own_bits}))
    return docs.join(side, word == F.col(own_word), "left").withColumn(name, F.coalesce(F.getbit(F.col(own_bits), bit) == 1, F.lit(False))).drop(own_word, own_bits)


def by_row(docs: DataFrame, picked: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``picked`` (doc_id, uid = row_hash, more) by row; ``how``: inner, left_semi or left_anti.

    ``picked`` is broadcast while it is small.  Beyond that only rows of ``docs`` whose bit in a ``bit_set`` is set are shuffled,
    which are those picked and a part of the others.  ``docs`` may have columns of any names, but for those that ``picked`` adds.
    """
    own_id, own_uid = fresh(docs, "picked_id"), fresh(docs, "picked_uid")
    side = picked.withColumnsRenamed({"doc_id": own_id, "uid": own_uid})
    on = (row_hash() == F.col(own_uid)) & F.col("doc_id").eqNullSafe(F.col(own_id))
    if is_small(picked):
        return docs.join(F.broadcast(side), on, how).drop(own_id, own_uid)
    asked = fresh(docs, "bit_asked")
    marked = with_asked(docs, bit_set(picked, F.col("uid")), row_hash(), asked)
    joined = marked.filter(asked).join(side, on, how).drop(own_id, own_uid, asked)
    return joined.unionByName(marked.filter(~F.col(asked)).drop(asked)) if how == "left_anti" else joined


def one_of_equals(docs: DataFrame) -> DataFrame:
    """``docs`` with one of each run of rows that share id and text."""
    row = fresh(docs, "row")
    return docs.withColumn(row, row_hash()).dropDuplicates([row, "doc_id"]).drop(row)


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` as ``decided`` says (doc_id, uid = row_hash, kept, once): rows that are not kept go, and of equal rows with ``once`` one stays.

    The rows that go, and those that repeat, are broadcast up to a million; beyond that ``docs`` is shuffled with its texts.
    """
    decided = saved(decided.select("doc_id", "uid", "kept", "once"), "decided")
    gone = decided.filter("not kept").select("doc_id", "uid").distinct()
    left = by_row(docs, gone, "left_anti")
    again = decided.filter("kept and once").groupBy("doc_id", "uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "uid")
    if again.isEmpty():
        return left
    return by_row(left, again, "left_anti").unionByName(one_of_equals(by_row(left, again, "left_semi")))
