"""Readers and writers of JSON lines, bibliographic tables, citation metrics, releases and reports."""

from __future__ import annotations

import glob
import os
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave import schemas

#: Tokens that stand for null in the citation metrics.
NULL_TOKENS = ("", "NA", "None")
#: Blocks of files that a broadcast may hold, some 200 bytes each.
BLOCKS = 500_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_idx, value: every line with its ordinal over all files in order of name; blank lines have one too.

    A line's ordinal is its place within its block of a file plus the lines of all blocks before it.  Lines of a block are read in a
    row, so their places are differences of running numbers, and no line is shuffled: lines meet the table of blocks by broadcast
    up to ``BLOCKS`` of these.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"))
    blocks = lines.groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("f", "b", (before - F.col("low")).alias("start"))  # a row for each block of a file
    starts = F.broadcast(starts) if blocks.limit(BLOCKS + 1).count() <= BLOCKS else starts
    return lines.join(starts, ["f", "b"]).select((F.col("start") + F.col("m")).cast("bigint").alias("line_idx"), "value")


def parsed(lines: DataFrame, schema: str, on_error: str = "drop", keep_raw: bool = False) -> DataFrame:
    """Non-blank lines as rows; a line that is no JSON object is dropped, or fails the job with ``on_error="raise"``."""
    full = lines.filter(F.trim("value") != "")
    options = {"mode": "FAILFAST"} if on_error == "raise" else {"mode": "PERMISSIVE"}
    rows = full.withColumn("r", F.from_json("value", schema, options))
    if on_error == "drop":
        rows = rows.filter(F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{"))
    return rows.select("line_idx", *(["value"] if keep_raw else []), "r.*")


def read_json_lines(spark: SparkSession, path: str, schema: str, on_error: str = "raise", keep_raw: bool = False) -> DataFrame:
    return parsed(read_lines(spark, path), schema, on_error, keep_raw)


def optional_table(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A JSON-lines table, or an empty one, with a warning, where there is no such file."""
    jvm = spark.sparkContext._jvm
    if path:
        place = jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return spark.read.schema(schema).json(path)
        warnings.warn(f"{path} is not there: an empty table is used", stacklevel=2)
    return spark.createDataFrame([], schema)


def _typed(c: Column, kind: str) -> Column:
    c = F.when(~c.isin(*NULL_TOKENS), c)
    if kind == "boolean":
        return F.when(F.lower(c).isin("true", "1"), True).when(F.lower(c).isin("false", "0"), False)
    return c if kind == "string" else c.try_cast(kind)


def read_citation_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The kept columns of a CSV of citation metrics; everything is read as text first, so a bad value is null and loses no row."""
    first = spark.read.text(path).first()
    names = [n.strip().strip('"') for n in first[0].lstrip("﻿").split(",")] if first else list(schemas.ICITE)
    raw = spark.read.schema(", ".join(f"`{n}` string" for n in names)).csv(path, header=True, quote='"', escape='"', enforceSchema=True, nullValue="\0", emptyValue="")
    absent = [n for n in schemas.ICITE if n not in names]
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    return raw.select(*[_typed(F.col(f"`{n}`"), kind).alias(n) for n, kind in schemas.ICITE.items()])


def read_pubmed(spark: SparkSession, *folders: str) -> DataFrame:
    """All shards of the folders, baseline first, with where each row came from, for last-wins precedence."""
    parts = [spark.read.schema(schemas.PUBMED_SOURCE).parquet(f).select("*", F.lit(k).alias("src_rank"), F.col("_metadata.file_name").alias("src_file"), F.col("_metadata.row_index").alias("src_row")) for k, f in enumerate(folders)]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def row_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()  # answered from footers: no column is read


def read_release(spark: SparkSession, root: str, config: str = "permissive", splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Release files of a configuration, with the split that their names begin with."""
    return spark.read.option("pathGlobFilter", "{%s}-*.parquet" % ",".join(splits)).parquet(f"{root}/{config}").withColumn("split", F.regexp_extract(F.col("_metadata.file_name"), r"^([a-z]+)-", 1))


def read_prompt(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


# Sinks.  Spark's committers make them atomic: a folder without _SUCCESS isn't finished.


def write_json_lines(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists", keep_nulls: bool = True) -> None:
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).option("compression", compression).json(path)


def write_lookup(df: DataFrame, path: str, level: int = 3, mode: str = "overwrite", partition_by: str | None = None, rows_per_file: int = 0, row_group_mb: int = 0) -> None:
    """Parquet with zstd; with ``partition_by`` only the partitions at hand are overwritten."""
    out = df.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)
    out = out.option("maxRecordsPerFile", rows_per_file) if rows_per_file else out
    out = out.option("parquet.block.size", row_group_mb << 20) if row_group_mb else out
    if partition_by:
        out = out.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    out.parquet(path)


def write_raw_lines(df: DataFrame, path: str, order: str = "line_idx", value: str = "value") -> None:
    """Source lines as they were, without white space at their ends, in source order over the files' names."""
    df.orderBy(order).select(F.regexp_replace(value, r"\s+$", "").alias("value")).write.text(path)


def write_tsv(df: DataFrame, path: str, columns: list[str] = schemas.SPLIT_COLUMNS, mode: str = "overwrite") -> None:
    df.select(*columns).write.mode(mode).option("sep", "\t").option("quote", "\u0000").option("emptyValue", "").option("header", True).csv(path)


def missing_outputs(paths: list[str], out: str, suffix: str) -> list[str]:
    """Inputs whose output is absent or empty."""
    name = lambda p: os.path.join(out, os.path.basename(p) + suffix)
    return [p for p in paths if not (os.path.exists(name(p)) and (os.path.getsize(name(p)) > 0 if os.path.isfile(name(p)) else bool(glob.glob(f"{name(p)}/part-*"))))]
