"""Keys, buckets, deduplication, allocation, samples and splits."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave import schemas
from citeweave.functions import text as X
from citeweave.functions import values as V
from citeweave.operators import curate, reports


def result(i, pmcid="PMC1", pmid=2, sentence="S.", ok=True, attempts=1, relevance="match", strength="strong", design="rct", mesh=None):
    citing = (pmcid, 1, None, None, None, None, None, None, None, None)
    cited = ("r", pmid, None, None, "abstract", None, None, mesh, None, None)
    extracted = (relevance, "", "", "other", "other", strength, design, "", "", [], "", None) if ok else None
    return (i, (citing, (None, "other", 3, False, False, sentence, 1, []), cited), ok, "", 0, 0, 0.0, attempts, ("m", "v", 0.0), None, None, extracted)


def results(spark, rows):
    return spark.createDataFrame(rows, f"line_idx bigint, {schemas.RESULT}").repartition(3)


def one(spark, column, kind, value):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("name", "bucket"), [("Methods", "other"), ("Results", "other"), ("Conclusions", "other"), ("Materials and methods", "methods"), ("Study design", "methods"), ("Results and Discussion", "discussion"), ("Background", "introduction"), (None, "other"), ("", "other")])
def test_sections(spark, name, bucket):
    assert one(spark, X.section_bucket, "string", name) == bucket


def test_buckets_and_values(spark):
    assert one(spark, X.specialty_bucket, "array<string>", ["Humans", "Breast Neoplasms"]) == "Neoplasms"
    assert one(spark, X.specialty_bucket, "array<string>", None) == "Other" == one(spark, X.specialty_bucket, "array<string>", [])
    assert one(spark, X.design_bucket, "string", "meta-analysis") == "review" and one(spark, X.design_bucket, "string", None) == "other" == one(spark, X.design_bucket, "string", "new")
    for text, n in ((" 12 ", 12), ("+5", 5), ("12\n", 12), ("12.7", None), ("", None), ("-3", -3), ("99999999999999999999", None), (None, None)):
        assert one(spark, V.try_int, "string", text) == n
    assert one(spark, V.squeeze, "string", " a  b\x1c\n c ") == "a b c"
    assert one(spark, X.inline_pmid, "string", "x PMID: : 1234567890") == 123456789
    assert one(spark, X.inline_doi, "string", "none") is None
    assert one(spark, lambda c: V.first_truthy(c, F.lit(None).cast("string"), F.lit("z")), "string", "") == "z"
    key = spark.range(1).select(X.record_key(F.lit(None).cast("string"), F.lit(222), F.lit(3), F.lit("Short.")).alias("k")).withColumn("i", X.record_id(F.col("k"))).first()
    assert key["k"] == "None|222|3|Short." and key["i"] == "f54c47873397d11d"


def test_grounding(spark):
    rows = spark.createDataFrame([("five-fold   Risk", "a ﬁve‐fold risk b"), (None, "x"), ("", "x"), ("no", "x")], "q string, a string")
    assert [r[0] for r in rows.select(X.grounded(F.col("q"), F.col("a"))).collect()] == [True, None, None, False]


def test_dedupe(spark):
    rows = [
        result(0, sentence="A", attempts=2), result(1, sentence="A", attempts=1), result(2, sentence="A", attempts=1), result(3, sentence="B", ok=False, attempts=4),
        result(4, sentence="B", attempts=0), result(5, sentence="C", ok=False, attempts=4), result(6, sentence="D", attempts=4), result(7, sentence="D", attempts=None),
        result(8, pmcid=None), result(9, sentence="x" * 80 + "1"), result(10, sentence="x" * 80 + "2"),
    ]
    df = results(spark, rows)
    kept = curate.deduplicated(df)
    assert sorted(r["line_idx"] for r in kept.collect()) == [1, 4, 5, 6, 8, 9]
    assert sorted(r["line_idx"] for r in curate.deduplicated(kept.drop("record_key")).collect()) == [1, 4, 5, 6, 8, 9]
    counts = curate.drop_counts(curate.with_key(df)).first()
    assert (counts["total"], counts["n_unique"], counts["dropped"]) == (11, 6, 5)


@pytest.mark.parametrize(("pops", "target", "seats"), [([7, 2, 1], 5, [4, 1, 0]), ([3, 1], 10, [3, 1]), ([1] * 5, 2, [1, 1, 0, 0, 0]), ([], 3, [])])
def test_allocation(spark, pops, target, seats):
    plan = spark.createDataFrame([("s", p, i) for i, p in enumerate(pops)], "stratum string, pop long, first_seen long")
    assert [r["n"] for r in curate.allocated(plan, "stratum", target).orderBy("first_seen").collect()] == seats


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(1, 60), min_size=1, max_size=6), min_size=1, max_size=4), st.integers(1, 80))
def test_allocation_sums(spark, groups, target):
    rows = [(f"s{g}", p, 100 * g + i) for g, pops in enumerate(groups) for i, p in enumerate(pops)]
    plan = spark.createDataFrame(rows, "stratum string, pop long, first_seen long").repartition(3)
    got = curate.allocated(plan, "stratum", target).collect()
    assert all(0 <= r["n"] <= r["pop"] for r in got)
    for g, pops in enumerate(groups):
        assert sum(r["n"] for r in got if r["stratum"] == f"s{g}") == min(target, sum(pops))


def test_gold_sample(spark):
    rows = [result(i, pmid=i, relevance=("match", "mismatch", "ambiguous", None)[i % 4], strength=("strong", "weak", "insufficient-context")[i % 3], design=("rct", "guideline")[i % 2], mesh=["Heart"] if i % 5 else None) for i in range(120)]
    df = results(spark, rows)
    gold = curate.gold(df, per_stratum=6, seed=3).collect()
    # The same draw, by hand: cells in order of stratum, then of first line.
    cells: dict = {}
    for r in rows:
        s = X_stratum(r[-1][0], r[-1][5])
        if s:
            cells.setdefault(s, {}).setdefault((r[-1][6], "Cardiovascular" if r[1][2][7] else "Other"), []).append(r[0])
    rng, expected = random.Random(3), set()
    for s in curate.STRATA:
        part = cells.get(s, {})
        total = sum(map(len, part.values()))
        share = {k: (len(v) if total <= 6 else 6 * len(v) / total) for k, v in part.items()}
        seats = {k: int(v) for k, v in share.items()}
        for k in sorted(share, key=lambda k: -(share[k] - seats[k]))[: min(6, total) - sum(seats.values())]:
            seats[k] += 1
        for k, lines in part.items():
            if seats[k]:
                expected |= set(rng.sample(lines, seats[k]))
    assert {r["line_idx"] for r in gold} == expected
    order = [(curate.STRATA.index(r["gold_meta"]["stratum"]), r["gold_meta"]["record_id"]) for r in gold]
    assert order == sorted(order)
    hashed = curate.gold(df, per_stratum=6, seed=3, exact=False)
    assert hashed.count() == len(gold)
    assert curate.unbucketed(curate.strata_of(df)).first()[0] == 30


def X_stratum(relevance, strength):
    if relevance in ("mismatch", "ambiguous"):
        return relevance
    return None if relevance is None else f"match_{strength}" if strength in ("strong", "moderate", "weak") else "ambiguous"


def test_splits(spark):
    keys = {"PMC398": "val", "PMC325": "val", "PMC53": "test", "PMC1175": "test", "PMC725": "train", None: "train"}
    rows = [result(i, pmcid=k, pmid=i) for i, k in enumerate(keys)] + [result(10, pmcid="PMC1", pmid=0, ok=False), result(11, pmcid="PMC398", pmid=77), result(12, pmcid="PMC398", pmid=77, ok=False)]
    df = results(spark, rows)
    gold = curate.gold_keys(df.filter("line_idx = 11"))
    index = curate.split_index(df, gold, "seed")
    assert index.columns == schemas.SPLIT_COLUMNS
    got = {(r["citing_pmcid"], r["cited_pmid"], r["split"]) for r in index.collect()}
    for i, (k, split) in enumerate(keys.items()):
        assert (k or "", str(i) if i else "", split) in got
    assert ("PMC1", "", "fail") in got and ("PMC398", "77", "gold") in got and ("PMC398", "77", "fail") in got
    assert {r["relevance_check"] for r in index.filter("split = 'fail'").collect()} == {"FAIL"}
    assert curate.torn_articles(index).isEmpty()
    curate.require_whole_articles(index)
    torn = index.union(index.filter("split = 'val'").withColumn("split", F.lit("test")))
    with pytest.raises(ValueError, match="more than one split"):
        curate.require_whole_articles(torn)
    sizes = {r["split"]: (r["n"], r["pct_of_hashed"]) for r in curate.split_sizes(index).collect()}
    assert sizes["fail"] == (2, None) and sizes["train"][0] == 2 and abs(sizes["val"][1] - 100 / 3) < 1e-3
    assert curate.materialised(df.filter("line_idx < 6"), index).count() == 6


def test_reports(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("c", 2), ("c", 3)], "x string, i int")
    assert [tuple(r) for r in reports.most_common(df, "x", "i").collect()] == [("c", 2), ("b", 1), ("a", 1)]
    seen, counts = reports.watched(df, "rows of x", total=F.sum("i"))
    seen.collect()
    assert counts.get == {"rows": 4, "total": 6}
    assert reports.seed_mark("seed") == "19b25856e1c150ca"
    got = {(r["dimension"], r["value"], r["n"]) for r in curate.marginals(df, ("x", "i")).collect()}
    assert ("x", "c", 2) in got and ("i", "3", 1) in got and len(got) == 7
