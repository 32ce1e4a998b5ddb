"""Spaced-seed decontamination against planted passages and brute force."""

import itertools
import random
import re

import pytest

from citeweave.llm import decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, item, window=13, same=0.8):
    d, w = words(doc), words(item)
    size, best = min(window, len(w)), 0
    for shift in range(-len(w), len(d)):
        hit = [0 <= shift + k < len(d) and d[shift + k] == w[k] for k in range(len(w))]
        best = max([best, *(sum(hit[k : k + size]) for k in range(len(w) - size + 1))])
    return best, size


@pytest.fixture()
def bench(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "z") for i, t in rows], "item_id long, text string, doc_id string")

    return make


def test_planted(docs_of, bench):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(400)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(some(n))) for i, n in enumerate([20, 30, 40, 15, 13, 59])] + [(6, "Very short one"), (7, ""), (8, None), (None, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11")]
    docs = [(0, None), (1, ""), (2, " ".join(some(300)))]
    for d in range(3, 40):
        item = words(items[rng.choice([0, 1, 2, 3, 4, 5])][1])
        for k in rng.sample(range(len(item)), rng.choice([0, 0, 1, 2, len(item) // 3])):
            item[k] = "sub"
        if rng.random() < 0.3:
            item = item[: len(item) // 2]
        body = some(60)
        body[30:30] = item
        docs.append((d, ", ".join(w.upper() if rng.random() < 0.2 else w for w in body)))
    docs += [(40, "so (very, SHORT) one it is"), (41, "very short two"), (None, items[9][1]), (3, docs[3][1])]
    got = {}
    for r in decontamination.contaminated(docs_of(docs), bench(items)).collect():
        got.setdefault((r["doc_id"], r["item_id"]), []).append((r["n_same"], r["n_words"]))
    assert (40, 6) in got and (41, 6) not in got and (None, None) in got and len(got.get((3, 0), [1, 2])) in (1, 2)
    found = missed = 0
    for d, text in docs:
        for i, item in items[:6]:
            n, size = brute(text, item)
            if (d, i) in got:
                assert n >= 0.8 * size
                found += 1
            elif n >= 0.8 * size:
                missed += 1
            if n == size:
                assert (d, i) in got
    assert found > 15 and missed == 0


def test_every_pattern_in_short_items(docs_of, bench):
    items, docs, expected = [], [], set()
    for n in range(1, 14):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for gone in range(n):
            for k, places in enumerate(itertools.combinations(range(n), gone)) if gone < 4 else ():
                text = " ".join(["before", *("sub" if p in places else w for p, w in enumerate(item)), "after"])
                d = n * 10_000 + gone * 1_000 + k
                docs.append((d, text))
                if n - gone >= 0.8 * n:
                    expected.add((d, n, n - gone))
    got = {(r["doc_id"], r["item_id"], r["n_same"]) for r in decontamination.contaminated(docs_of(docs), bench(items)).collect()}
    assert got - expected == set()
    assert expected - got == set()


def test_repetitive_texts(docs_of, bench):
    """Many shifts of one item: what is kept of them is in proportion to the text."""
    items = [(i, " ".join(["again"] * (20 + i))) for i in range(20)] + [(20, " ".join(f"x{k % 7}" for k in range(40)))]
    docs = [(1, "again " * 100_000), (2, " ".join(f"x{k % 7}" for k in range(5000))), (3, "other " * 5000), (None, "again " * 50), (None, "x0 x1 x2 " * 50)]
    got = {(r["doc_id"], r["item_id"], r["start"], r["n_same"]) for r in decontamination.contaminated(docs_of(docs), bench(items)).collect()}
    assert {(d, i) for d, i, _, n in got if n == 13} == {(1, i) for i in range(20)} | {(None, i) for i in range(20)} | {(2, 20)}


def test_null_ids_do_not_meet(docs_of, bench):
    item = " ".join(f"b{k}" for k in range(14))
    docs = [(None, f"text {i} of its own") for i in range(300)] + [(None, f"{item} end {i}") for i in range(5)] + [(None, f"{item} end 0")]
    got = decontamination.contaminated(docs_of(docs), bench([(1, item)])).collect()
    assert [(r["doc_id"], r["item_id"], r["n_same"]) for r in got] == [(None, 1, 13)] * 6


def test_many_rows_and_ids_beyond_doubles(docs_of, bench, monkeypatch):
    """Every way of meeting, broadcast or not, finds the same, and ids keep all their digits beside nulls."""
    big = 2**60 + 1
    items = [(big, " ".join(f"b{k}" for k in range(14))), (None, " ".join(f"c{k}" for k in range(20))), (3, "q1 q2 q3")]
    docs = [(big + d, f"start {items[d % 3][1]} end {d}") for d in range(30)] + [(None, items[0][1]), (None, items[1][1]), (7, "clean text")]
    expected = sorted(((big + d, items[d % 3][0]) for d in range(30)), key=str) + [(None, big), (None, None)]
    for small in (True, False):
        if not small:
            monkeypatch.setattr(decontamination, "is_small", lambda *_: False)
            monkeypatch.setattr(decontamination, "_WORDS_MOST", 0)
        got = [(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs_of(docs), bench(items)).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)


def test_nothing(docs_of, bench):
    none = docs_of([]).filter("doc_id < 0")
    assert decontamination.contaminated(none, bench([(0, "a b c d")])).count() == 0
    assert decontamination.contaminated(docs_of([(0, "a b c d")]), bench([]).filter("item_id < 0")).count() == 0
