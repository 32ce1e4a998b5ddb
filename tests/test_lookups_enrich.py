"""Lookup tables, last-wins precedence, and enrichment over nested rows."""

from citeweave import schemas
from citeweave.operators import enrich, lookups
from citeweave.sources import tables


def source(spark, rows):
    return spark.createDataFrame(rows, schemas.PUBMED_SOURCE)


def row(pmid, ids=None, title="t", abstract=None, journal=(None, None, None), year=None, kinds=None, mesh=None, refs=None):
    return (pmid, ids, title, abstract, journal, (year,) if year is not None else None, kinds, mesh, refs)


def test_publications(spark):
    rows = [
        row("1", [("pubmed", "1"), ("DOI", "10.1/x"), ("doi", "10.1/y")], abstract=[("BACKGROUND", "X:"), (None, "Y: "), ("L", "")], journal=("J", "j", "2003"), mesh=[None, ("",), ("Heart",)], refs=[("12", "d1"), ("x", None), None, ("1_0", "")]),
        row("2", [], abstract=[], journal=("J", "j", "Winter")),
        row(" 3 ", None, abstract=[(None, "")], journal=None, year="1999", kinds=["Review"]),
        row("abc"),
        row(None),
    ]
    got = {r["pmid"]: r for r in lookups.publications(source(spark, rows)).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["doi"] == "10.1/x" and got[1]["abstract"] == "BACKGROUND: X\n\nY: " and got[1]["pub_year"] == 2003
    assert got[1]["mesh_descriptors"] == ["Heart"] and got[1]["reference_pmids"] == [12] and got[1]["reference_dois"] == ["d1"]
    assert got[2]["abstract"] is None and got[2]["pub_year"] is None and got[2]["pub_types"] == [] and got[2]["reference_pmids"] == []
    assert got[3]["pub_year"] == 1999 and got[3]["journal_title"] is None and got[3]["pub_types"] == ["Review"]


def test_precedence_buckets_and_sorted_files(spark, tmp_path):
    base, update = str(tmp_path / "base"), str(tmp_path / "update")
    source(spark, [row("41234567", title="old"), row("999999"), row("1000000")]).coalesce(1).write.parquet(base)
    source(spark, [row("41234567", title="new")]).coalesce(1).write.parquet(update)
    both = tables.read_pubmed(spark, base, update)
    assert tables.row_count(spark, base) == 3
    latest = lookups.latest_publications(both)
    assert {r["pmid"]: r["title"] for r in latest.collect()} == {41234567: "new", 999999: "t", 1000000: "t"}
    keyed = latest.withColumn("pmid_bucket", lookups.bucket(latest["pmid"]))
    assert {r["pmid"]: r["pmid_bucket"] for r in keyed.collect()} == {41234567: 41, 999999: 0, 1000000: 1}
    out = str(tmp_path / "lookup")
    tables.write_lookup(keyed, out, level=5, partition_by="pmid_bucket", rows_per_file=2)
    part = lookups.pruned(spark.read.parquet(out), 41_000_000, 41_999_999)
    assert part.count() == 1
    assert "PartitionFilters: [isnotnull(pmid_bucket" in part._jdf.queryExecution().toString()
    assert [r["pmid"] for r in lookups.sorted_lookup(latest, 2).collect()] == [999999, 1000000, 41234567]


def test_citation_metrics(spark, tmp_path):
    names = ["extra", *schemas.ICITE]
    lines = [",".join(names)]
    for pmid, clinical, journal, count in (("3", "True", '"J, ""x"""', "7"), ("1", "0", "NA", "None"), ("2", "FALSE", "", "bad"), ("", "1", "None", "1")):
        values = {"pmid": pmid, "is_clinical": clinical, "journal": journal, "citation_count": count, "apt": "0.5"}
        lines.append(",".join(values.get(n, "e") if n in values or n == "extra" else "" for n in names))
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    got = lookups.sorted_lookup(tables.read_citation_metrics(spark, str(tmp_path / "m.csv"))).collect()
    assert [(r["pmid"], r["is_clinical"], r["journal"], r["citation_count"], r["apt"]) for r in got] == [(1, False, None, None, 0.5), (2, False, None, None, 0.5), (3, True, 'J, "x"', 7, 0.5), (None, True, None, 1, 0.5)]


def test_enrich(spark):
    ref = lambda i, p, title=None, doi=None, year=None: (i, p, doi, title, None, year, "")
    event = lambda ids, s="Methods": (ids, "S.", s, 3, False, True)
    refs = [ref("a", 10, "ref title", "ref doi", 0), ref("b", 11), ref("c", 12), ref("d", 13), ref("e", 0), ref("a2", 99), ref("a2", 10)]
    arts = spark.createDataFrame(
        [
            ("PMC1", 1, None, "", "", 0, "cc", 2, 2, refs, [event(["a", "a", "zz", "b", "c", "d", "e"]), event(["a2"], "Materials and methods")], "oa_comm", "x"),
            ("PMC2", 2, None, "t", "j", 1, "cc", 1, 1, refs, [event(["a"])], "oa_comm", "x"),
            ("PMC3", None, None, "t", "j", 1, "cc", 1, 1, refs, [event(["a"])], "oa_comm", "x"),
        ],
        schemas.ARTICLE,
    )
    pub = lambda p, abstract, title="pub": (p, "pub doi", title, abstract, "PJ", "pj", 2010, ["T"], ["M"], [], [])
    pubs = spark.createDataFrame([pub(1, None), pub(10, "text"), pub(11, "   "), pub(12, "text")], schemas.PUBMED_LOOKUP)
    metric = lambda p, c: (p, None, 2000, "j", 5, 0.5, None, True, c, None, None, None, None, None, None, None)
    metrics = spark.createDataFrame([metric(1, True), metric(10, True), metric(11, True), metric(12, False), metric(13, True), metric(2, None), metric(99, True)], schemas.ICITE_LOOKUP)
    rows = enrich.enrich(arts, pubs, metrics).collect()
    assert sorted(r["cited"]["ref_id"] for r in rows) == ["a", "a", "a2"]
    r = next(r for r in rows if r["cited"]["ref_id"] == "a")
    assert (r["citing"]["title"], r["citing"]["journal"], r["citing"]["year"], r["citing"]["mesh"]) == ("pub", "PJ", 2010, ["M"])
    assert (r["cited"]["doi"], r["cited"]["title"], r["cited"]["year"], r["cited"]["icite"]["citation_count"]) == ("ref doi", "pub", 2010, 5)
    assert (r["context"]["section_bucket"], r["context"]["n_co_cited_refs"], r["context"]["co_cited_ref_ids"][2]) == ("other", 7, "zz")
    assert {r["context"]["section_bucket"] for r in rows} == {"other", "methods"}
    counts = enrich.edge_counts(enrich.enrich(arts, pubs, metrics, keep_rejected=True)).first()
    assert (counts["n_emitted"], counts["n_no_abstract"]) == (3, 2)
    assert [f.dataType.simpleString() for f in enrich.enrich(arts, pubs, metrics).schema] == [f.dataType.simpleString() for f in spark.createDataFrame([], schemas.ENRICHED).schema]
