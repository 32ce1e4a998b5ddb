"""Exact deduplication, mixing, and the whole pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citeweave.llm import decontamination, exact_dedup, jaccard_join, mixing, queries

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (1, "unique"), (2, None), (4, ""), (7, " "), (8, "\n\n"), (None, "a b"), (1, "unique"), (6, "x" * 5000), (10, "x" * 5000), (11, "x" * 4999 + "y"), (12, "é😀\v b"), (13, "é😀 b")]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(docs_of, spark, tmp_path):
    docs_of(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.queries()["op2_exact_dedup"](spark, str(tmp_path)).collect()
    groups = defaultdict(list)
    for d, t in ROWS:
        groups[norm(t)].append(d)
    expected = Counter()
    for d, t in ROWS:
        g = groups[norm(t)]
        keep = min(x for x in g if x is not None)
        expected[d, keep, len(g), hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    assert sum(r["kept"] for r in rows) == len(groups)


def test_exact_dedup_by_either_way(docs_of):
    docs = docs_of(ROWS)
    ways = [exact_dedup.exact_dedup(docs), exact_dedup.exact_dedup(docs, words=1), exact_dedup.exact_dedup(docs, words=4), exact_dedup.exact_dedup(docs, digests=True)]
    assert len({tuple(sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in w.collect()), key=str)) for w in ways}) == 1
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns and Counter(norm(r["text"]) for r in left.collect()) == Counter({norm(t): 1 for _, t in ROWS})
    empty = docs.filter("n_chars < 0")
    assert exact_dedup.exact_dedup(empty).count() == 0 == exact_dedup.deduplicated(empty).count()


def test_hot_copies(docs_of):
    rows = [(i, "hot copy" if i % 3 else f"text {i}") for i in range(3000)]
    got = exact_dedup.exact_dedup(docs_of(rows))
    assert got.filter("kept").count() == 1001 and got.filter("keep_id = 1 and group_size = 2000").count() == 2000


def targets(size, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(size.values()), set(names)
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total >= most * size[s]}
        if not full:
            return out | {s: left * w[s] / total for s in open_}
        for s in full:
            out[s] = most * size[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("options", [{}, {"block": 16, "fan": 2}])
def test_mixing(docs_of, options):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 40, 200]))) for i in range(1500)] + [(1501, None), (1502, ""), (None, "a b c"), (3, "d")]
    source = {i: rng.choice(["b", "a", "B", "é", "zz", None, "a", "a", "a"]) for i, _ in rows if i is not None}
    docs = docs_of(rows, source)
    got = mixing.mix(docs, **options).collect()
    assert len(got) == len(rows)
    size = Counter()
    for i, t in rows:
        size[source.get(i, "src0")] += len((t or "").split())
    want = targets(size)
    taken = Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 200 for s in size)
    again = mixing.mix(docs.repartition(7), **options).collect()
    key = lambda rs: Counter((r["doc_id"], r["size"], r["taken"]) for r in rs)
    assert key(got) == key(again)
    mixed = mixing.mixture(docs, **options)
    assert mixed.columns == [*docs.columns, "copy_"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({d: n for d, n in sum((Counter({r["doc_id"]: r["copies"]}) for r in got), Counter()).items() if n})


def test_mixing_of_nothing(docs_of):
    empty = docs_of([]).filter("doc_id < 0")
    assert mixing.mix(empty).count() == 0 == mixing.mixture(empty).count()
    assert [r["taken"] for r in mixing.mix(docs_of([(1, None), (2, "")])).collect()] == [0, 0]


def test_equal_rows_share_copies(docs_of, spark):
    rows = [(None, "same three words")] * 7 + [(1, "a b c d"), (2, "e f")] + [(3, "x y z")] * 2
    docs = docs_of(rows)
    for seed in range(4):
        got = Counter()
        for r in mixing.mix(docs, seed=seed).collect():
            got[r["doc_id"]] += r["copies"]
        mixed = Counter(r["doc_id"] for r in mixing.mixture(docs, seed=seed).collect())
        assert mixed == +got and abs(sum(r["taken"] for r in mixing.mix(docs, seed=seed).collect()) - 1.5 * 33) <= 4


def test_blocks_of_many_null_ids(spark):
    """Null ids of one size and one text are dealt out by place: no block has more than its share."""
    docs = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("s").alias("source"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "source", F.xxhash64("text").alias("draw"))
    at = mixing.numbered(rows)
    assert at.agg(F.min("at"), F.max("at"), F.count_distinct("at")).first()[:] == (0, 49_999, 50_000)
    assert abs(mixing.mix(docs).agg(F.sum("taken")).first()[0] - 150_000) <= 2


def test_stages_keep_columns_and_odd_rows(docs_of, spark):
    rows = [(1, None), (2, ""), (3, None), (4, "one two three four five six"), (5, "One two  three four five six"), (None, "one two three four five six"), (4, "one two three four five six"), (6, "alone here")]
    docs = docs_of(rows)
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4, 6]
    bench = spark.createDataFrame([(1, "two three four five")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(docs, bench).collect()) == [1, 2, 3, 6]


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in now.collect()}
        now = spark.createDataFrame(stage(spark, now, folder).toPandas())
        seen[name] = (before, now.collect())
    before, after = seen["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    known = [d for d in before if d in labels]
    assert sum((d in kept) == bool(labels[d]) for d in known) / len(known) > 0.9

    before, after = seen["exact_dedup"]
    groups = defaultdict(list)
    for d, r in before.items():
        groups[norm(r["text"])].append(d)
    assert {r["doc_id"] for r in after} == {min(g) for g in groups.values()}

    before, after = seen["near_dedup"]
    sets = {}
    for d, r in before.items():
        w = re.findall(r"\S+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {r["doc_id"] for r in after} == {find(d) for d in sets}

    before, after = seen["decontamination"]
    word = lambda t: " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    items = [word(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {d for d, r in before.items() if any(i in word(r["text"]) for i in items)}
    assert {r["doc_id"] for r in after} == set(before) - leaks

    before, after = seen["mixing"]
    size = Counter()
    for r in before.values():
        size[r["source"]] += len(r["text"].split())
    taken = Counter()
    for r in after:
        taken[r["source"]] += len(r["text"].split())
    want = targets(size)
    longest = max(len(r["text"].split()) for r in before.values())
    assert all(abs(taken[s] - want[s]) <= longest for s in size)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    assert corpus_pipeline.run(spark, folder).count() == len(after)


def test_pipeline_in_odd_cases(spark, docs_of, tmp_path):
    """Null ids, null, empty, repeated and long texts, and names that clash; then nothing at all."""
    rng = random.Random(2)
    body = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) + "." for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(body)] + [(None, body[0]), (None, None), (50, None), (51, ""), (3, body[3]), (None, "own text of a row without id " * 3), (52, "long " + " ".join(f"x{k}" for k in range(30_000)))]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, body[5]), (None, None)], "item_id long, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*docs.columns, "copy_"]
    texts = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert set(texts) <= set(rows) and max(texts.values()) <= 2 and (5, body[5]) not in texts and (None, body[0]) not in texts

    for name, table in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        table.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_counterparts(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    got = queries.queries()[name](spark, folder)
    expected = con.execute(f"select {', '.join(got.columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(expected)
