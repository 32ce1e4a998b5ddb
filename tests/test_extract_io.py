"""Extraction with its cache and retries, JSON lines, sinks, releases, streams, and the driver's contract."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from citeweave import schemas, streaming
from citeweave.functions import extraction as E
from citeweave.operators import extract
from citeweave.sources import tables

GOOD = {"relevance_check": "match", "attributed_claim": "c", "citation_purpose": "background", "evidence_type": "statistic", "support_strength": "weak", "cited_study_design": "rct", "question": "q", "answer": "a"}


def check(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    return [(r["j"], r["p"]) for r in rows.select(E.recovered(F.col("t")).alias("j"), E.problems(F.coalesce(E.recovered(F.col("t")), F.lit("{}"))).alias("p")).collect()]


def test_recovery(spark):
    got = check(spark, "```json\n{\"a\": 1}\n```", 'Sure: {"a":{"b":2}} ok', "{a} {b}", "none", "", "  ", '```\n{"a": [1]}```')
    assert [None if j is None else json.loads(j) for j, _ in got] == [{"a": 1}, {"a": {"b": 2}}, None, None, None, None, {"a": [1]}]


def test_rules_agree(spark):
    cases = [
        GOOD, GOOD | {"extra": 1}, {k: v for k, v in GOOD.items() if k != "answer"}, GOOD | {"evidence_type": "contrast"}, GOOD | {"answer": "x" * 1500}, GOOD | {"answer": "x" * 1501},
        GOOD | {"mismatch_reason": None}, GOOD | {"answer_grounded_in": ["both"]}, GOOD | {"answer_grounded_in": ["none"]}, GOOD | {"answer_grounded_in": None}, GOOD | {"question": 3},
        GOOD | {"statistic_extraction": None}, GOOD | {"statistic_extraction": {"metric": "m", "value": "v", "n_subjects": "7"}}, GOOD | {"statistic_extraction": {"metric": "m"}},
        GOOD | {"statistic_extraction": {"metric": "m", "value": "v", "n_subjects": None}}, GOOD | {"statistic_extraction": {"metric": "m", "value": "v", "n_subjects": "x"}}, GOOD | {"evidence_quote_from_cited": "y" * 1501},
    ]
    native = [not p for _, p in check(spark, *map(json.dumps, cases))]
    assert native == [extract.broken_field(c) is None for c in cases]
    assert native == [True, True, False, False, True, False, False, True, False, False, False, True, True, False, True, False, False]


def records(spark, n=6):
    citing = ("PMC1", 1, None, "t", None, None, None, None, None, None)
    rows = [((citing, (None, "other", 1, False, False, f"Sentence {i % (n - 1)}.", 1, []), ("r", 5, None, "T", "abstract", "J", 2000, ["h"] * 20, ["k"], (3, 0.5, None, True, None))),) for i in range(n)]
    return spark.createDataFrame(rows, f"input struct<citing:{schemas.CITING},context:{schemas.CONTEXT},cited:{schemas.CITED}>")


def test_extraction(spark, tmp_path):
    def save(df):
        df.write.parquet(str(tmp_path / "answers"))
        return spark.read.parquet(str(tmp_path / "answers"))

    empty = spark.createDataFrame([], extract.CACHE)
    results, new = extract.extract(records(spark), empty, extract.Stub(), save=save)
    rows = results.collect()
    assert len(rows) == 6 and all(r["ok"] and r["attempts"] == 1 for r in rows) and new.count() == 5
    cache = extract.merged_cache(empty, new)
    again, more = extract.extract(records(spark), cache, extract.Stub())
    assert {r["attempts"] for r in again.collect()} == {0} and more.count() == 0
    assert again.first()["extracted"]["support_strength"] in E.CHOICES["support_strength"]
    assert {"quote_in_abstract", "statistic_missing"} <= set(extract.quality_flags(again).columns)
    prompt = records(spark).select(E.user_prompt(F.col("input.citing"), F.col("input.context"), F.col("input.cited"))).first()[0]
    assert "impact = cited 3, ratio 0.5, clinical true" in prompt and prompt.count("h; ") == 14 and "doi" not in prompt


def test_failures(spark):
    class Failing:
        async def complete(self, endpoint, system, user, temperature, max_tokens, json_mode):
            if json_mode:
                raise ValueError("response_format is not known")
            return extract.Reply("{} {}" if temperature < 0.5 else '{"relevance_check": 1}', 2, 1)

    empty = spark.createDataFrame([], extract.CACHE)
    results, new = extract.extract(records(spark, 3), empty, Failing())
    rows = results.collect()
    assert {(r["ok"], r["attempts"], r["error_kind"]) for r in rows} == {(False, 4, "schema_invalid")} and new.count() == 0
    assert extract.call_counts(results).first()["outcome"] == "schema_invalid"
    done = results.limit(1)
    numbered = records(spark, 3).select(F.monotonically_increasing_id().alias("line_idx"), "input.*")
    assert extract.undone(numbered, done).count() <= 2
    retried, _ = extract.extract(records(spark, 3), empty, extract.Stub(1.0))
    assert {r["attempts"] for r in retried.collect()} == {2}


def test_chat(spark):
    record = {n: F.lit("") for n in E.SCALARS}
    turns = spark.range(1).select(E.chat("sys", F.lit("é"), F.lit(None).cast("string"), record, F.lit(None).cast("string"), F.lit("")).alias("m")).first()["m"]
    assert [t["role"] for t in turns] == ["system", "user", "assistant"]
    assert json.loads(turns[1]["content"]) == {"citing_sentence": "é", "cited_abstract": None}
    answer = json.loads(turns[2]["content"])
    assert answer["answer_grounded_in"] == [] and answer["statistic_extraction"] is None and len(answer) == 12


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{bad\n{"a": 2, "b": "é"}  \n')
    lines = tables.read_lines(spark, path)
    assert [r["line_idx"] for r in lines.orderBy("line_idx").collect()] == [0, 1, 2, 3]
    got = tables.read_json_lines(spark, path, "a int, b string", on_error="drop", keep_raw=True)
    assert [(r["line_idx"], r["a"], r["b"]) for r in got.orderBy("line_idx").collect()] == [(0, 1, None), (3, 2, "é")]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        tables.read_json_lines(spark, path, "a int, b string").collect()
    tables.write_raw_lines(got, str(tmp_path / "raw"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "raw")).collect()) == ['{"a": 1}', '{"a": 2, "b": "é"}']
    tables.write_json_lines(got.drop("value"), str(tmp_path / "j"))
    assert '{"line_idx":0,"a":1,"b":null}' in {r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()}
    assert tables.optional_table(spark, str(tmp_path / "absent"), "a int").count() == 0
    assert tables.missing_outputs([path], str(tmp_path / "none"), ".gz") == [path]


def test_many_files_in_line_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("".join(f"{k}-{i}\n" for i in range(50)))
    lines = tables.read_lines(spark, str(tmp_path))
    assert [r["value"] for r in lines.orderBy("line_idx").collect()] == [f"{k}-{i}" for k in range(3) for i in range(50)]


def test_tsv_and_release(spark, tmp_path):
    row = spark.createDataFrame([('k "q"', "", "", "val", "match", "", "FAIL")], ", ".join(f"{c} string" for c in schemas.SPLIT_COLUMNS))
    tables.write_tsv(row.coalesce(1), str(tmp_path / "t"))
    text = next((tmp_path / "t").glob("part-*")).read_text().splitlines()
    assert text == ["\t".join(schemas.SPLIT_COLUMNS), 'k "q"\t\t\tval\tmatch\t\tFAIL']
    (tmp_path / "permissive").mkdir()
    for name in ("train-0", "val-0", "other-0"):
        spark.range(2).toPandas().to_parquet(tmp_path / "permissive" / f"{name}.parquet")
    assert sorted(r["split"] for r in tables.read_release(spark, str(tmp_path)).collect()) == ["train", "train", "val", "val"]


def test_incremental_runs(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"a": 1}\n{"a": -1}\n')
    run = lambda: streaming.run_available(spark, source, "a int", lambda df: df.filter("a > 0"), sink, checkpoint)
    run()
    (tmp_path / "in/2.json").write_text('{"a": 5}\n')
    run()
    run()
    assert sorted(r["a"] for r in spark.read.parquet(sink).collect()) == [1, 5]
    seen = []
    streaming.run_batches(spark, source, "a int", lambda df, k: seen.append(df.count()), str(tmp_path / "check2"))
    assert sum(seen) == 3


ODD_REPLIES = ['{"a": NaN}', '{"a": 1, "a": 2}', '[{"a": 1}]', 'Sure: [1] {"a": {"b": -Infinity}} ok', "[note] {\"a\": 1}", "```json\n{\"a\": 1}\n```", "{a} {b}", "", "7", "} {", '{"é": "ü"}', None]


def test_recovered_as_loads(spark):
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(ODD_REPLIES)], "i int, t string").orderBy("i").select(E.recovered(F.col("t"))).collect()]
    for text, found in zip(ODD_REPLIES, got, strict=True):
        try:
            wanted = E.loads(text or "")
        except ValueError:
            wanted = None
        assert (json.loads(found) if found is not None else None) == (json.loads(E.dumps(wanted)) if isinstance(wanted, dict) else None)


class _Server(http.server.BaseHTTPRequestHandler):
    """Refuses JSON mode, then answers with the user's text as a record with a repeated key and NaN."""

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if "response_format" in body:
            return self._say(400, {"error": "response_format is not supported"})
        record = {**GOOD, "question": body["messages"][1]["content"][:20]}
        text = json.dumps(record)[:-1] + ', "answer": "last", "other": NaN}'
        return self._say(200, {"choices": [{"message": {"content": text}}], "usage": {"prompt_tokens": 5, "completion_tokens": 7}})

    def _say(self, status, body):
        data = json.dumps(body).encode()
        self.send_response(status)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *args):
        pass


def test_calls_over_http(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}"
        settings = extract.Settings(model="m", endpoints=(url, f"{url}/"))
        prompts = spark.createDataFrame([(f"k{i}", f"prompt {i}") for i in range(5)], "cache_key string, user string").coalesce(1)
        rows = extract.calls(prompts, extract.ChatEndpoint("m"), settings, "system").collect()
        assert all(r["ok"] and json.loads(r["data"])["answer"] == "last" and json.loads(r["data"])["other"] is None and r["usage_out"] == 7 for r in rows)
        assert max(r["attempts"] for r in rows) == 2 and {json.loads(r["data"])["question"] for r in rows} == {f"prompt {i}" for i in range(5)}
    finally:
        server.shutdown()
    refused = extract.calls(prompts.limit(1), extract.ChatEndpoint("m", timeout=2), extract.Settings(endpoints=(url,), max_retry=1), "system").first()
    assert not refused["ok"] and refused["error_kind"] == "api_error" and refused["attempts"] == 2
