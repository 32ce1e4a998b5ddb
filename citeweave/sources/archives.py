"""Article archives: a data source with one input partition for each .tar.gz, and the choice of archives to read."""

from __future__ import annotations

import io
import os
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Subsets of the archive.
SUBSETS = ("oa_comm", "oa_noncomm", "oa_other")
MEMBERS = "subset string, archive string, member string, data binary"


class _Archive(InputPartition):
    def __init__(self, subset: str, path: str):
        self.subset, self.path = subset, path


class _Reader(DataSourceReader):
    def __init__(self, archives: list[tuple[str, str]], suffix: str):
        self.archives, self.suffix = archives, suffix

    def partitions(self) -> list[InputPartition]:
        return [_Archive(*a) for a in self.archives]

    def read(self, partition: _Archive) -> Iterator[tuple]:
        with tarfile.open(partition.path, "r|gz") as tar:  # a stream: one member in memory at a time
            for member in tar:
                if member.isfile() and member.name.endswith(self.suffix):
                    yield partition.subset, os.path.basename(partition.path), member.name, tar.extractfile(member).read()


class TarArchives(DataSource):
    """``spark.read.format("tar_archives").option("path", root).load()``; options: subsets (comma-joined), suffix, limit.

    ``root`` holds a folder for each subset, on a file system that executors share.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_archives"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        subsets = self.options.get("subsets", "all")
        found = archives(self.options["path"], SUBSETS if subsets == "all" else tuple(subsets.split(",")))
        limit = self.options.get("limit")
        return _Reader(found[: int(limit)] if limit else found, self.options.get("suffix", ".xml"))


def archives(root: str, subsets: tuple[str, ...] = SUBSETS) -> list[tuple[str, str]]:
    """(subset, path) of every archive below ``root``, in order of name within a subset."""
    unknown = set(subsets) - set(SUBSETS)
    if unknown:
        raise ValueError(f"no such subset: {', '.join(sorted(unknown))}; there are {', '.join(SUBSETS)} and all")
    return [(s, os.path.join(root, s, n)) for s in subsets if os.path.isdir(os.path.join(root, s)) for n in sorted(os.listdir(os.path.join(root, s))) if n.endswith(".tar.gz")]


def read_archives(spark: SparkSession, root: str, subsets: str = "all", limit: int | None = None) -> DataFrame:
    spark.dataSource.register(TarArchives)
    reader = spark.read.format("tar_archives").option("path", root).option("subsets", subsets)
    return (reader.option("limit", limit) if limit else reader).load()


def read_stored_archives(spark: SparkSession, glob: str, suffix: str = ".xml") -> DataFrame:
    """The same rows from any store that Spark reads: archives come as binary files, one is in memory at a time."""

    def members(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                subset, name = path.rstrip("/").split("/")[-2:]
                rows = []
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                    for m in tar:
                        if m.isfile() and m.name.endswith(suffix):
                            rows.append((subset, name, m.name, tar.extractfile(m).read()))
                import pandas as pd

                yield pd.DataFrame(rows, columns=["subset", "archive", "member", "data"])

    return spark.read.format("binaryFile").load(glob).select("path", "content").mapInPandas(members, MEMBERS)


def manifest(spark: SparkSession, glob: str) -> DataFrame:
    """name, size of the files of any store that Spark lists: no file's content is read."""
    return spark.read.format("binaryFile").load(glob).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))


def undone(found: DataFrame, done: DataFrame, key: str = "archive") -> DataFrame:
    """Rows whose key the manifest ``done`` (key, size) doesn't list with a size above 0."""
    return found.join(done.filter("size > 0").select(key), key, "left_anti")


def links(pages: DataFrame, column: str = "html", pattern: str = r'href="([^"]*(?:\.tar\.gz|\.filelist\.csv|\.filelist\.txt))"') -> DataFrame:
    """Distinct link targets of listing pages that match, in order."""
    found = pages.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(1))).alias("name"))
    return found.distinct().orderBy("name")


def sync_plan(remote: DataFrame, local: DataFrame) -> DataFrame:
    """name, remote_size, local_size, status: a file is skipped if both sizes are the same and above 0, else to be fetched."""
    both = remote.select("name", F.coalesce("size", F.lit(0)).alias("remote_size")).join(local.select("name", F.col("size").alias("local_size")), "name", "left")
    same = (F.col("remote_size") > 0) & (F.col("local_size") == F.col("remote_size"))
    return both.select("name", "remote_size", F.coalesce("local_size", F.lit(0)).alias("local_size"), F.when(same, "skipped").otherwise("fetch").alias("status"))


def fetched(plan: DataFrame, after: DataFrame) -> DataFrame:
    """The plan with the outcome: downloaded if the file now has the remote size (or the remote one is unknown), failed otherwise."""
    got = after.select("name", F.col("size").alias("got"))
    good = F.col("got").isNotNull() & ((F.col("remote_size") == 0) | (F.col("got") == F.col("remote_size")))
    status = F.when(F.col("status") == "skipped", "skipped").when(good, "downloaded").otherwise("failed")
    return plan.join(got, "name", "left").withColumn("status", status).drop("got")


def status_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
