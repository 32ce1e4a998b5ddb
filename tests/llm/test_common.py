"""Scratch tables, hot keys, and rows kept by hash."""

from pyspark.sql import functions as F

from citeweave.llm import common
from citeweave.llm.components import components


def test_scratch_is_in_the_session_folder(spark):
    df = common.saved(spark.range(5), "five")
    assert df.scratch.startswith(spark.conf.get("spark.checkpoint.dir")) and df.count() == 5
    common.forget(df)
    assert not spark.sparkContext._jvm.java.io.File(df.scratch).exists()


def test_hot_keys_join_whole(spark):
    rows = spark.range(4000).select(F.col("id").alias("uid"), F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = common.attach_groups(rows, groups, "k", "n", 4000, parts=50)
    assert out.count() == 4000 and out.filter("k = -1 and n = 2666").count() == 2666 and out.filter("n is null").count() == 0


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = {r["v"]: r["c"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 150)} == {100} and {found[i] for i in (200, 201, 202)} == {200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_small_sides(spark, docs_of, monkeypatch):
    docs = docs_of([(1, "a"), (2, "b"), (None, "c"), (None, None), (2, "b")])
    decided = docs.select("doc_id", common.row_hash().alias("uid"), (F.col("text") != "a").alias("kept"), F.lit(True).alias("once")).filter("kept is not null")
    for small in (True, False):
        monkeypatch.setattr(common, "is_small", lambda df, rows=0, s=small: s)
        left = common.keep_rows(docs, decided).collect()
        assert sorted(str(r["text"]) for r in left) == ["None", "b", "c"]
        picked = decided.filter("kept").select("doc_id", "uid").distinct()
        assert sorted(str(r["text"]) for r in common.by_row(docs, picked, "left_semi").collect()) == ["b", "b", "c"]
        assert sorted(str(r["text"]) for r in common.by_row(docs, picked, "left_anti").collect()) == ["None", "a"]


def test_a_full_set_of_bits_loses_nothing(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("g"))
    for words in (1, 8, 4096):
        marked = common.with_asked(spark.range(2000).select("id", F.lit(1).alias("bit_word")), common.bit_set(keys, F.col("g"), words), F.xxhash64("id"), "asked", words)
        assert marked.filter("asked and id < 500").count() == 500
        others = marked.filter("asked and id >= 500").count()
        assert others == 1500 if words == 1 else others < 200 if words == 4096 else True
