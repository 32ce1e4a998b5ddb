"""The stages in a row, from archives to splits."""

import io
import json
import tarfile

from citeweave import cli, schemas

from .test_articles import ARTICLE


def test_stages(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    run = lambda *words: cli.run(spark, cli.parser().parse_args([str(w) for w in words]))
    (tmp_path / "in/oa_comm").mkdir(parents=True)
    with tarfile.open(tmp_path / "in/oa_comm/a.tar.gz", "w:gz") as tar:
        info = tarfile.TarInfo("a.xml")
        info.size = len(ARTICLE.encode())
        tar.addfile(info, io.BytesIO(ARTICLE.encode()))
    run("parse", p("in"), p("articles"))
    rows = [(str(i), None, f"title {i}", [(None, "An abstract.")], ("J", "j", "2001"), None, None, [("Heart",)], None) for i in (900, 111, 222333)]
    for name in ("base", "update"):
        spark.createDataFrame(rows, schemas.PUBMED_SOURCE).write.parquet(p(name))
    run("publications", p("base"), p("update"), p("pubs"))
    names = list(schemas.ICITE)
    (tmp_path / "m.csv").write_text("\n".join([",".join(names), *(",".join(str(i) if n == "pmid" else "True" if n == "is_clinical" else "" for n in names) for i in (900, 111, 222333))]) + "\n")
    run("metrics", p("m.csv"), p("metrics"), "--partitions", 2)
    run("enrich", p("articles"), p("pubs"), p("metrics"), p("enriched"))
    assert spark.read.schema(schemas.ENRICHED).json(p("enriched")).count() == 7
    run("extract", p("enriched"), p("results"), "--cache", p("cache"))
    run("extract", p("enriched"), p("results"), "--cache", p("cache"), "--done", p("results"), "--resume")
    results = spark.read.schema(schemas.RESULT).json(p("results"))
    assert results.count() == 7 and results.filter("ok").count() == 7
    run("dedupe", p("results"), p("unique"))
    lines = [json.loads(r["value"]) for r in spark.read.text(p("unique")).collect()]
    assert 0 < len(lines) <= 7 and all("input" in line for line in lines)
    run("gold", p("unique"), p("gold"), "--per-stratum", 1)
    run("split", p("unique"), p("split"), "--gold", p("gold"))
    index = spark.read.option("sep", "\t").csv(p("split"), header=True)
    assert index.columns == schemas.SPLIT_COLUMNS and index.count() == len(lines) and index.filter("split = 'gold'").count() > 0
