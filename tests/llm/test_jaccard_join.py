"""The n-gram Jaccard join against brute force."""

import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from citeweave.llm import jaccard_join


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = set()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and both:
                parent[find(i)] = find(j)
                links.add((i, j))
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str), links, sets


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    common = [rng.choice(vocab) for _ in range(40)]
    texts = [None, "", " \t", "one two", "One  two", "a b c d", "é É " * 6]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([8, 30, 80, 200]))] for _ in range(6)]
    for _ in range(n):
        kind = rng.random()
        words = list(rng.choice(bases)) if kind < 0.7 else [rng.choice(vocab) for _ in range(rng.choice([5, 20, 60]))]
        if kind > 0.6:
            words = words[: len(words) // 3] + common + words[len(words) // 3 :]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], [rng.choice(vocab)], [words[k].upper()]])
        texts.append(" ".join(words))
    return list(enumerate(texts))


def test_components(docs_of):
    for seed in (1, 2):
        rows = corpus(seed)
        rows += [(None, rows[20][1]), (20, rows[20][1]), (None, "quite alone in here it is")]
        rng = random.Random(seed)
        ids = [r[0] for r in rows[:-3]]
        rng.shuffle(ids)
        rows = [(ids[i] if i < len(ids) else r[0], r[1]) for i, r in enumerate(rows)]
        got = jaccard_join.jaccard_join(docs_of(rows))
        assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows)[0]


def test_all_links(docs_of):
    rows = corpus(5, 90)
    _, links, sets = brute(rows)
    docs = docs_of(rows)
    ids = {r["doc_id"]: r["class_id"] for r in jaccard_join.jaccard_join(docs).collect()}
    expected = {tuple(sorted((ids[i], ids[j]))) for i, j in links if sets[i] != sets[j]}
    assert {tuple(sorted(r)) for r in jaccard_join.jaccard_join(docs, links=True).collect()} == expected


def test_boilerplate_in_many_documents(docs_of, spark):
    """A passage that many documents share links none of those that differ, and pairs don't grow with their square."""
    n = 20_000
    passage = " ".join(f"b{k}" for k in range(12))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit(passage + " "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("_"), k.cast("string"))), " ")).alias("text"))
    near = docs.filter("doc_id % 1000 = 0").select((F.col("doc_id") + n).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"))
    got = jaccard_join.jaccard_join(docs.unionByName(near))
    assert got.count() == n + 20 and got.filter(f"component_id = doc_id - {n}").count() == 20 and got.filter("component_id = doc_id").count() == n


def test_meeting_with_salts(spark):
    """All pairs of near enough sizes meet once, however hot the token is."""
    rows = spark.range(3000).select(F.col("id").alias("sig"), (F.col("id") % 40 + 10).alias("n"), F.when(F.col("id") % 10 > 0, 1).otherwise(2).cast("long").alias("token"))
    met = jaccard_join._meeting(rows, rows, 4, 5, parts=2).select("x.sig", "x.n", "x.token", F.col("y.sig").alias("other"), F.col("y.n").alias("m"))
    near = "least(n, m) * 5 >= greatest(n, m) * 4"
    wanted = rows.join(rows.select(F.col("sig").alias("other"), F.col("n").alias("m"), "token"), "token").filter(near).count()
    assert met.filter(near).count() == wanted == met.filter(near).distinct().count()


def test_other_threshold_and_nothing(docs_of):
    assert jaccard_join.jaccard_join(docs_of([]).filter("doc_id < 0")).count() == 0
    rows = [(0, "a b c d e f"), (1, "a b c d e g"), (2, "x y")]
    got = jaccard_join.jaccard_join(docs_of(rows), threshold=Fraction(1, 3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 0, 2: 2}
