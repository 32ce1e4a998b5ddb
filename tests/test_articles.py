"""Article XML to citation events, and the archive source."""

import io
import tarfile

from citeweave.operators import articles
from citeweave.sources import archives

ARTICLE = """<article><front>
 <journal-meta><journal-title-group><journal-title>J Test</journal-title></journal-title-group></journal-meta>
 <article-meta><article-id pub-id-type="pmc">1001</article-id><article-id pub-id-type="pmid">x9</article-id><article-id pub-id-type="pmid">900</article-id>
  <title-group><article-title>A <italic>b</italic> c</article-title></title-group>
  <pub-date pub-type="ppub"><year>2001</year></pub-date><pub-date pub-type="epub"><year>2002</year></pub-date>
  <permissions><license license-type="open-access"><license-p>Text</license-p></license></permissions></article-meta></front>
<body><sec><title>Methods</title>
 <p>No cites here.</p>
 <p>Alpha works <xref ref-type="bibr" rid="r1">1</xref>. Beta fails. Gamma <xref ref-type="bibr" rid="r1 r2">1,2</xref> is fine.</p>
 <sec><p>Tail after dot.<xref ref-type="bibr" rid="r2">2</xref> Next sentence.</p></sec>
 <table-wrap><p>Cell <xref ref-type="bibr" rid="r9">9</xref>.</p></table-wrap></sec>
<sec><title>Discussion</title>
 <p>Outer start. <list><list-item><p>Inner <xref ref-type="bibr" rid="r1">1</xref>.</p></list-item></list> Outer end.</p></sec>
<fig><p>Shown <xref ref-type="bibr">1</xref> and <xref ref-type="fig" rid="r1">Fig 1</xref> (<xref ref-type="bibr" rid="r2">2</xref>).</p></fig></body>
<back><ref-list>
 <ref id="r1"><element-citation><article-title>T1</article-title><source>S1</source><year>1999</year><pub-id pub-id-type="pmid">111</pub-id><pub-id pub-id-type="doi"> </pub-id></element-citation></ref>
 <ref id="r2"><mixed-citation>Some raw text. PMID: 222333. doi 10.1000/xyz.1).</mixed-citation></ref>
 <ref><mixed-citation>no id</mixed-citation></ref></ref-list></back></article>"""


def members(spark, texts):
    return spark.createDataFrame([("oa_comm", f"{i}.xml", bytearray(t.encode())) for i, t in enumerate(texts)], "subset string, member string, data binary")


def test_article(spark):
    (a,) = articles.parse_articles(members(spark, [ARTICLE])).collect()
    assert (a["pmcid"], a["pmid"], a["doi"], a["title"], a["journal"], a["year"], a["license"], a["n_refs"], a["source_xml"]) == ("PMC1001", 900, None, "A b c", "J Test", 2002, "open-access", 2, "0.xml")
    one, two = a["references"]
    assert (one["pmid"], one["doi"], one["title"], one["journal"], one["year"]) == (111, None, "T1", "S1", 1999)
    assert (two["pmid"], two["doi"], two["title"]) == (222333, "10.1000/xyz.1", None)
    found = [(e["paragraph_idx"], e["section"], e["ref_ids"], e["sentence"], e["in_table"], e["in_fig"]) for e in a["citations"]]
    assert found == [
        (1, "Methods", ["r1"], "Alpha works .", False, False),
        (1, "Methods", ["r1", "r2"], "Gamma is fine.", False, False),
        (2, "Methods", ["r2"], "Tail after dot. Next sentence.", False, False),
        (4, "Discussion", ["r1"], "Inner .", False, False),
        (5, "Discussion", ["r1"], "Inner .", False, False),
        (6, None, ["r2"], "Shown and Fig 1 ().", False, True),
    ]
    assert a["n_citations"] == 6


def test_odd_documents(spark):
    texts = ["<article><unclosed></article>", "<other/>", "<set><article><front/></article></set>", "<article><front><article-meta><title-group><article-title> </article-title></title-group><article-id pub-id-type='pmcid'>PMC7</article-id></article-meta></front><body><sec><p>Early <xref ref-type='bibr' rid='a'>1</xref>.</p><title>Late</title></sec></body><back><ref id='a'><mixed-citation/></ref></back></article>"]
    rows = sorted(articles.parse_articles(members(spark, texts)).collect(), key=lambda r: r["source_xml"])
    # The first isn't well-formed and is mended; the second has no article.
    assert [r["source_xml"] for r in rows] == ["0.xml", "2.xml", "3.xml"] and rows.pop(0)["n_refs"] == 0
    assert {r["outcome"]: r["n"] for r in articles.readings(members(spark, texts)).collect()} == {"whole": 2, "mended": 1, "no article": 1}
    assert rows[0]["pmcid"] is None and rows[0]["n_citations"] == 0
    assert rows[1]["pmcid"] == "PMC7" and rows[1]["title"] is None and rows[1]["citations"][0]["section"] == "Late"
    total = articles.totals(articles.parse_articles(members(spark, texts))).first()
    assert (total["n_articles"], total["n_citations"], total["n_refs"]) == (3, 1, 1)


def test_mended_documents(spark):
    """Entities without a definition, bare ampersands, bad bytes, crossed and missing end tags lose no event."""
    whole = ARTICLE.encode()
    broken = [whole.replace(b"Alpha works", b"Alpha &nbsp; R&D \xff works"), whole.replace(b"</back></article>", b""), whole.replace(b"A <italic>b</italic> c", b"A <italic>b <bold></italic>x</bold> c")]
    want = articles.parse_articles(members(spark, [ARTICLE])).first()
    for data in broken:
        row = articles.parse_articles(spark.createDataFrame([("oa_comm", "0.xml", data)], "subset string, member string, data binary")).first()
        assert (row["pmcid"], row["n_citations"], row["n_refs"]) == (want["pmcid"], want["n_citations"], want["n_refs"])
        assert articles.read_article(data)[1] == "mended"


def test_archives(spark, tmp_path):
    for subset, names in (("oa_comm", ["b.tar.gz", "a.tar.gz"]), ("oa_other", ["c.tar.gz"])):
        (tmp_path / subset).mkdir()
        for name in names:
            with tarfile.open(tmp_path / subset / name, "w:gz") as tar:
                for member, text in (("x/1.xml", ARTICLE), ("x/readme.txt", "no")):
                    data = text.encode()
                    info = tarfile.TarInfo(member)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
    rows = archives.read_archives(spark, str(tmp_path))
    assert sorted((r["subset"], r["archive"]) for r in rows.select("subset", "archive").collect()) == [("oa_comm", "a.tar.gz"), ("oa_comm", "b.tar.gz"), ("oa_other", "c.tar.gz")]
    assert articles.parse_articles(rows).count() == 3
    assert archives.read_archives(spark, str(tmp_path), "oa_comm", limit=1).collect()[0]["archive"] == "a.tar.gz"
    stored = archives.read_stored_archives(spark, f"{tmp_path}/*/*.tar.gz")
    assert stored.count() == 3 and set(stored.columns) == set(rows.columns)
    listed = archives.manifest(spark, f"{tmp_path}/*/*.tar.gz").collect()
    assert {r["name"]: r["size"] for r in listed} == {n: (tmp_path / s / n).stat().st_size for s, n in (("oa_comm", "a.tar.gz"), ("oa_comm", "b.tar.gz"), ("oa_other", "c.tar.gz"))}
    done = spark.createDataFrame([("a.tar.gz", 10), ("b.tar.gz", 0)], "archive string, size long")
    assert sorted(r["archive"] for r in archives.undone(rows, done).collect()) == ["b.tar.gz", "c.tar.gz"]


def test_links_and_sync(spark):
    pages = spark.createDataFrame([('<a href="b.tar.gz">b</a> <a href="a.filelist.csv">a</a> <a href="b.tar.gz">', ), ("<p>", )], "html string")
    assert [r["name"] for r in archives.links(pages).collect()] == ["a.filelist.csv", "b.tar.gz"]
    remote = spark.createDataFrame([("a", 5), ("b", 5), ("c", None), ("d", 0)], "name string, size long")
    local = spark.createDataFrame([("a", 5), ("b", 4), ("d", 0)], "name string, size long")
    plan = archives.sync_plan(remote, local)
    assert {r["name"]: r["status"] for r in plan.collect()} == {"a": "skipped", "b": "fetch", "c": "fetch", "d": "fetch"}
    after = spark.createDataFrame([("a", 5), ("b", 5), ("d", 9)], "name string, size long")
    assert {r["name"]: r["status"] for r in archives.fetched(plan, after).collect()} == {"a": "skipped", "b": "downloaded", "c": "failed", "d": "downloaded"}
