"""Trained operators: held-out accuracy, exact counts, and defined results in odd cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import lm_scoring, quality, toxicity

ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "x" * 70000), (904, "w " * 40000), (None, "null id here"), (3, "again")]


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(150)], ["nastyone", "foulbit", "vilething"]
    docs, labels = [], []
    for d in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(10, 120))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        if not good:
            words = [w + rng.choice(["!!", "%%%", "$$"]) for w in words]
        docs.append((d, " ".join(words)))
        if d % 5:
            labels.append((d, good, toxic, "en"))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    docs, labels = corpus()
    rows = [(i, t, "en", "s", 0, 1.0) for i, t in docs + ODD]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").write.parquet(f"{folder}/documents.parquet")
    odd = [(None, 1, 1, "en"), (900, None, None, "en"), (7, 1 - labels[5][1], 1 - labels[5][2], "en")]
    spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int, lang string").write.parquet(f"{folder}/labels.parquet")
    return folder, docs + ODD, {d: (q, t) for d, q, t, _ in labels}


@pytest.mark.parametrize(("query", "place", "cut"), [(quality.op1_quality_classifier, 0, 0.7), (toxicity.op9_toxicity, 1, 0.3)])
def test_classifiers(spark, data, query, place, cut):
    folder, docs, labels = data
    rows = query(spark, folder).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in docs)
    right = wrong = 0
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if r["held_out"] and r["doc_id"] in labels:
            right += r["predicted"] == labels[r["doc_id"]][place]
            wrong += r["predicted"] != labels[r["doc_id"]][place]
    assert right / (right + wrong) > 0.95


def test_accepted_rows_keep_columns(spark, data):
    docs = spark.read.parquet(f"{data[0]}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{data[0]}/labels.parquet"))
    good = quality.accepted(docs, model)
    assert good.columns == docs.columns
    assert good.count() == quality.score(docs, model).filter(f"score >= {model.cut}").count()


def test_classifiers_without_one_label(spark, data, docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, none)
    assert [round(r["score"], 6) for r in quality.score(docs, model).collect()] == [0.7, 0.7]
    assert max(r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()) < 0.01
    empty = docs.filter("doc_id < 0")
    assert quality.score(empty, model).count() == 0 == toxicity.score(empty, toxicity.train(docs, none)).count()


def test_quantile_of_all_labelled_documents(spark):
    """The part of training documents below the cut is the share of label 0, whatever the sample."""
    docs, labels = corpus(900, seed=6)
    docs = spark.createDataFrame(docs + [(5000, "no label")], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, lang string")
    training = {d: q for d, q, *_ in labels if zlib.crc32(str(d).encode()) % 4 != 2}
    for per_class in (40, 3000):
        model = quality.train(docs, known, per_class=per_class)
        below = sum(r["score"] < model.cut for r in quality.score(docs, model).collect() if r["doc_id"] in training)
        assert abs(below - sum(q == 0 for q in training.values())) <= 2


def test_sample_bounded_in_words(spark):
    docs, labels = corpus(400, seed=7)
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("en"))
    model = toxicity.train(rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, lang string"), fit_words=6000)
    toxic = {d: t for d, _, t, _ in labels if zlib.crc32(str(d).encode()) % 4 == 2}
    found = {r["doc_id"]: r["score"] >= 0.3 for r in toxicity.score(rows, model).collect()}
    assert sum(found[d] == bool(t) for d, t in toxic.items()) / len(toxic) > 0.8


def test_thresholds_of_a_rare_language(spark):
    docs, labels = corpus(900, seed=4)
    ids = [d for d, *_ in labels if zlib.crc32(str(d).encode()) % 4 != 2]
    toxic = {d: t for d, _, t, _ in labels}
    rare = set([d for d in ids if toxic[d]][:40] + [d for d in ids if not toxic[d]][:40])
    rows = spark.createDataFrame([(d, t, "xx" if d in rare else "en") for d, t in docs], "doc_id long, text string, lang string")
    model = toxicity.train(rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, lang string"), per_class=30)
    assert {None, "en", "xx"} == set(model.thresholds)


def test_cut_at_true_shares(spark):
    # Ids 0 to 9 were fitted on: 10 clean ones.  With them counted, clean rows weigh 1.5 each.
    scores = [(d, "en", 0.1) for d in range(10)] + [(d, "en", 0.4) for d in range(10, 30)] + [(d, "en", 0.6) for d in range(30, 50)]
    known = [(d, int(d >= 30 or d in (10, 11))) for d in range(50)]
    cuts = toxicity.calibrated(spark.createDataFrame(scores, "doc_id long, lang string, score double"), spark.createDataFrame(known, "doc_id long, label int"), list(range(10)), least=10)
    assert set(cuts) == {None, "en"} and all(0.4 < c < 0.6 for c in cuts.values())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


@pytest.mark.parametrize("known", [400_000, 20])
def test_language_model(spark, data, known):
    folder, docs, _ = data
    trains = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 != 0
    c = Counter(w for d, t in docs if trains(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    base = lambda t: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
    expected = sorted((str(d), not trains(d), len(words(t)), sum(c[w] > 0 for w in words(t)), round(base(t), 4)) for d, t in docs)
    rows = lm_scoring.score(spark.read.parquet(f"{folder}/documents.parquet"), known=known).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == expected
    assert {r["train_tokens"] for r in rows} == {n} and all(r["score"] < 0 for r in rows)
    if known > 20:
        held = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def small_model(n=0, seed=3):
    shape = lm_scoring.shape_for(n)
    rng = np.random.default_rng(seed)
    return shape, lm_scoring.Weights(shape, *(rng.normal(0, 0.3, x.shape).astype(np.float32) for x in shape.empty())), rng


@pytest.mark.parametrize("n", [0, 1 << 27])
def test_gradient_has_every_place(spark, n):
    shape, w, rng = small_model(n)
    texts = [rng.integers(0, shape.start, k).astype(np.uint16) for k in [*range(1, 9), 700, 20]]
    texts += [np.arange(30, 40, dtype=np.uint16)] * 3
    rows = spark.createDataFrame([(t.tobytes(), True) for t in texts] + [(texts[8].tobytes(), False)], "symbols binary, trains boolean").repartition(4)
    wanted, outcomes = shape.empty(float), shape.empty(float)
    for symbols in texts:
        one, two = lm_scoring.contexts(symbols, np.array([0, len(symbols)]), shape.start)
        cls, word = lm_scoring.split_symbols(shape, symbols)
        head = symbols < shape.head
        of_word = lm_scoring.word_features(shape, one[head], two[head], cls[head])
        for table, seen, weights, features, outcome in ((wanted[0], outcomes[0], w.classes, lm_scoring.class_features(shape, one, two), cls), (wanted[1], outcomes[1], w.words, of_word, word[head])):
            if len(features[1]):
                p = w.soft(weights, features)
                for f in features:
                    np.add.at(table, np.broadcast_to(f, len(p)), p)
                    np.add.at(seen, (np.broadcast_to(f, len(p)), outcome), 1)
    got, seen = lm_scoring.expected(lm_scoring.context_counts(rows, shape), w), lm_scoring.observed(rows, shape, 1000)
    assert all(np.allclose(g, e, atol=1e-3) for g, e in zip(got, wanted, strict=True))
    assert all(np.array_equal(g, e) for g, e in zip(seen, outcomes, strict=True))
    assert seen[0].sum() == 4 * sum(map(len, texts))


@pytest.mark.parametrize("n", [0, 1 << 27])
def test_probabilities_sum_to_one(n):
    """Over all symbols, after some histories."""
    shape, w, rng = small_model(n)
    symbols = np.arange(shape.start).astype(np.uint16)
    cls, word = lm_scoring.split_symbols(shape, symbols)
    head = symbols < shape.head
    for a, b in ((3, 5), (shape.head + 1, shape.start), (shape.start, shape.start)):
        one, two = np.full(len(symbols), a, np.uint16), np.full(len(symbols), b, np.uint16)
        logs = w.log(w.classes, lm_scoring.class_features(shape, one, two), cls)
        logs[head] += w.log(w.words, lm_scoring.word_features(shape, one[head], two[head], cls[head]), word[head])
        assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_model_grows_with_the_corpus():
    shapes = [lm_scoring.shape_for(n) for n in (0, 1 << 24, 1 << 25, 1 << 26, 1 << 28, 1 << 32, 1 << 50)]
    assert [s.head for s in shapes] == [1024, 1024, 2048, 2048, 4096, 8192, 8192]
    assert [s.bits for s in shapes] == [15, 15, 15, 15, 16, 16, 16]
    assert [lm_scoring._tasks(n, shapes[0], 6, 256) for n in (0, 10**6, 10**8, 10**9)] == [1, 1, 6, 15]


def test_language_model_of_nothing(docs_of):
    assert lm_scoring.score(docs_of([]).filter("doc_id < 0")).count() == 0
    assert lm_scoring.score(docs_of([(10, "held out only")]).filter("doc_id > 0")).count() == 1
