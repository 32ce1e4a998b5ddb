"""Registered queries of the engine's operators over the supplied tables, each with its SQL counterpart where SQL can say it.

Citing paper: orders.  Citation edge: lineitem.  Cited paper: part.  Article text: documents.  Extraction result: documents with
labels.  Chat turns: conversations.  JSON payload: events.props.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave import schemas
from citeweave.functions import extraction as E
from citeweave.functions import text as X
from citeweave.functions import values as V
from citeweave.operators import articles, curate, enrich, extract, lookups, reports
from citeweave.sources import archives, tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


c, lit = F.col, F.lit


def _folder(spark: SparkSession) -> str:
    """A new folder for files that a query writes to read them: below spark.checkpoint.dir, which only a local session may lack."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="citeweave-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/citeweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


# Joins.


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')")
def q_semi_clinical(spark, d):
    ids = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("o_custkey")).distinct()
    return t(spark, d, "orders").select("o_orderkey", "o_custkey").join(enrich.small(ids), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '1-URGENT') AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 20)""")
def q_double_semi(spark, d):
    o = t(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(c("o_orderkey").alias("l_orderkey"))
    p = t(spark, d, "part").filter("p_size <= 20").select(c("p_partkey").alias("l_partkey"))
    edges = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return edges.join(enrich.small(o), "l_orderkey", "left_semi").join(enrich.small(p), "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def q_build_reduce(spark, d):
    ids = t(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(c("l_partkey").alias("p_partkey")).distinct()
    return t(spark, d, "part").select("p_partkey", "p_name").join(enrich.small(ids), "p_partkey", "left_semi")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus ELSE c_mktsegment END AS shown
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""")
def q_lookup_left(spark, d):
    known = t(spark, d, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(c("o_orderstatus") != "O", c("o_orderstatus")).otherwise("").alias("own")).join(known, "o_custkey", "left")
    return rows.select("o_orderkey", V.first_truthy(c("own"), c("c_mktsegment")).alias("shown"))


@query("""SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE trim(CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_type END) <> ''""")
def q_lookup_inner_nonblank(spark, d):
    p = t(spark, d, "part").withColumn("abstract", F.when(c("p_size") % 3 == 0, "  ").otherwise(c("p_type"))).filter(F.trim("abstract") != "")
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", c("l_partkey").alias("p_partkey")).join(p.select("p_partkey", "p_name"), "p_partkey").select("l_orderkey", "l_linenumber", "p_name")


_SHIFT = 1_000_000_000  # cited ids lie beyond citing ids
_SECTION = {"A": "Background", "N": "Materials and methods", "R": "Results and Discussion"}


def _articles(spark, d):
    section = F.element_at(F.create_map(*[lit(x) for kv in _SECTION.items() for x in kv]), c("l_returnflag"))
    rid = F.concat(lit("r"), c("l_linenumber").cast("string"), lit("-"), c("l_partkey").cast("string"))
    line = t(spark, d, "lineitem").select(c("l_orderkey").alias("pmid"), "l_linenumber", (c("l_partkey") + _SHIFT).alias("cited"), rid.alias("rid"), section.alias("section"))
    ref = F.struct(c("rid").alias("ref_id"), c("cited").alias("pmid"), lit(None).cast("string").alias("doi"), lit(None).cast("string").alias("title"), lit(None).cast("string").alias("journal"), lit(None).cast("int").alias("year"), lit("").alias("raw"))
    event = F.struct(F.array("rid").alias("ref_ids"), F.concat(lit("Line "), c("rid"), lit(".")).alias("sentence"), "section", c("l_linenumber").cast("int").alias("paragraph_idx"), lit(False).alias("in_table"), lit(False).alias("in_fig"))
    lists = line.groupBy("pmid").agg(F.collect_list(ref).alias("references"), F.collect_list(event).alias("citations"))
    head = t(spark, d, "orders").select(c("o_orderkey").alias("pmid"), F.concat(lit("PMC"), c("o_orderkey").cast("string")).alias("pmcid"), lit(None).cast("string").alias("doi"), lit("").alias("title"), c("o_orderstatus").alias("journal"), F.year("o_orderdate").alias("year"), lit(None).cast("string").alias("license"), lit("oa_comm").alias("subset"))
    return head.join(lists, "pmid")


def _publications(spark, d):
    empty = lit(None).cast("array<string>")
    p = t(spark, d, "part").select((c("p_partkey") + _SHIFT).alias("pmid"), lit(None).cast("string").alias("doi"), c("p_name").alias("title"), F.when(c("p_size") % 5 == 0, "  ").otherwise(c("p_type")).alias("abstract"), c("p_brand").alias("journal_title"), c("p_size").cast("int").alias("pub_year"), F.split("p_type", " ").alias("mesh_descriptors"), empty.alias("pub_types"))
    o = t(spark, d, "orders").select(c("o_orderkey").alias("pmid"), lit(None).cast("string").alias("doi"), c("o_orderpriority").alias("title"), lit(None).cast("string").alias("abstract"), lit("J").alias("journal_title"), lit(1).alias("pub_year"), empty.alias("mesh_descriptors"), empty.alias("pub_types"))
    return p.unionByName(o)


def _metrics(spark, d):
    extra = [lit(1).alias("citation_count"), lit(0.5).cast("float").alias("relative_citation_ratio"), lit(None).cast("float").alias("nih_percentile"), lit(True).alias("is_research_article")]
    p = t(spark, d, "part").select((c("p_partkey") + _SHIFT).alias("pmid"), (c("p_size") <= 25).alias("is_clinical"), *extra)
    o = t(spark, d, "orders").select(c("o_orderkey").alias("pmid"), c("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_clinical"), *extra)
    return p.unionByName(o)


_EDGES = """SELECT CASE l_returnflag WHEN 'A' THEN 'introduction' WHEN 'N' THEN 'methods' ELSE 'discussion' END AS section_bucket, o_orderpriority, o_orderkey, p_partkey, p_name, p_brand, p_size, l_linenumber, p_type
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND p_size <= 25"""


@query(f"""SELECT section_bucket, p_brand AS cited_journal, o_orderpriority AS citing_title, count(*) AS n_edges, count(DISTINCT o_orderkey) AS n_citing, count(DISTINCT p_partkey) AS n_cited,
CAST(sum(p_size) AS BIGINT) AS sum_year FROM ({_EDGES}) WHERE p_size % 5 <> 0 GROUP BY ALL""")
def q_enrich_full(spark, d):
    rows = enrich.enrich(_articles(spark, d), _publications(spark, d), _metrics(spark, d))
    flat = rows.select(c("context.section_bucket").alias("section_bucket"), c("cited.journal").alias("cited_journal"), c("citing.title").alias("citing_title"), c("citing.pmid").alias("a"), c("cited.pmid").alias("b"), c("cited.year").alias("y"))
    return flat.groupBy("section_bucket", "cited_journal", "citing_title").agg(F.count(lit(1)).alias("n_edges"), F.count_distinct("a").alias("n_citing"), F.count_distinct("b").alias("n_cited"), F.sum("y").alias("sum_year"))


@query(f"SELECT count(*) FILTER (WHERE p_size % 5 <> 0) AS n_emitted, count(*) FILTER (WHERE p_size % 5 = 0) AS n_no_abstract FROM ({_EDGES})")
def q_enrich_counts(spark, d):
    return enrich.edge_counts(enrich.enrich(_articles(spark, d), _publications(spark, d), _metrics(spark, d), keep_rejected=True))


@query("""SELECT a.l_orderkey, a.l_linenumber, b.l_partkey FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) a
JOIN (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL) b USING (l_orderkey, l_linenumber) WHERE l_partkey <> 0""")
def q_intra_row_map(spark, d):
    ref = F.struct(c("l_linenumber").cast("string").alias("ref_id"), c("l_partkey").alias("pmid"))
    rows = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(ref)).alias("refs"), F.collect_set("l_linenumber").alias("asked"))
    rows = rows.withColumn("refs", enrich.usable(c("refs"))).withColumn("keys", c("refs.ref_id"))
    led = F.transform("asked", lambda i: F.struct(i.alias("l_linenumber"), enrich.found(c("refs"), c("keys"), i.cast("string"))["pmid"].alias("l_partkey")))
    return rows.select("l_orderkey", F.inline(led)).filter("l_partkey is not null")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def q_last_wins(spark, d):
    return lookups.last_wins(t(spark, d, "events").select("user_id", "ts", "event_id", "event_type", c("event_id").alias("e")), "user_id", ["ts", "event_id"]).select("user_id", c("e").alias("event_id"), "event_type")


@query("""WITH k AS (SELECT doc_id, 'None|' || doc_id || '|None|' || substring(text, 1, 80) AS k FROM documents) SELECT doc_id FROM k
WHERE doc_id < 700 AND k NOT IN (SELECT k FROM k JOIN labels USING (doc_id))""")
def q_anti_resume(spark, d):
    records = _records(spark, d).select("doc_id", c("doc_id").alias("line_idx"), "input.citing", "input.context", "input.cited")
    records = records.withColumn("cited", c("cited").withField("pmid", c("doc_id")))
    done = records.join(t(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select(F.struct("citing", "context", "cited").alias("input"))
    return extract.undone(records, done, 700).select(c("line_idx").alias("doc_id"))


@query("""WITH p AS (SELECT conv_id, turn, sha256('m' || chr(0) || 's' || chr(0) || text) AS k FROM conversations), s AS (SELECT DISTINCT k FROM p WHERE turn = 0)
SELECT p.conv_id, p.turn, p.k AS cache_key, s.k IS NOT NULL AS hit FROM p LEFT JOIN s USING (k)""")
def q_cache_lookup(spark, d):
    p = t(spark, d, "conversations").select("conv_id", "turn", E.cache_key("m", "s", c("text")).alias("cache_key"))
    stored = p.filter("turn = 0").select("cache_key", lit(True).alias("h")).distinct()
    return p.join(stored, "cache_key", "left").select("conv_id", "turn", "cache_key", F.coalesce("h", lit(False)).alias("hit"))


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS name, d.n_chars AS remote_size, coalesce(l.size, 0) AS local_size,
CASE WHEN d.n_chars > 0 AND l.size = d.n_chars THEN 'skipped' ELSE 'fetch' END AS status
FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN n_chars ELSE n_chars - 1 END AS size FROM labels JOIN documents USING (doc_id)) l USING (doc_id)""")
def q_manifest_diff(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "n_chars")
    local = docs.join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id").select(c("doc_id").cast("string").alias("name"), F.when(c("quality") == 1, c("n_chars")).otherwise(c("n_chars") - 1).alias("size"))
    return archives.sync_plan(docs.select(c("doc_id").cast("string").alias("name"), c("n_chars").alias("size")), local)


@query("""WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS name, n_chars, doc_id % 3 AS k FROM documents)
SELECT CASE k WHEN 0 THEN 'skipped' WHEN 1 THEN 'downloaded' ELSE 'failed' END AS status, count(*) AS n FROM p GROUP BY ALL""")
def q_fetch_status(spark, d):
    base = t(spark, d, "documents").select(c("doc_id").cast("string").alias("name"), (c("n_chars") + 1).alias("size"), (c("doc_id") % 3).alias("k"))
    plan = archives.sync_plan(base.select("name", "size"), base.filter("k = 0").select("name", "size"))
    after = base.select("name", F.when(c("k") == 2, c("size") - 1).otherwise(c("size")).alias("size"))
    return archives.status_counts(archives.fetched(plan, after))


@query("""SELECT DISTINCT name FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS name FROM pages)""")
def q_link_extract(spark, d):
    return archives.links(t(spark, d, "pages"), "html", 'href="([^"]*)"')


# Text.

_SENT = r"string_split(regexp_replace(text, '([.!?])\s+([A-Z0-9(\[])', '\1' || chr(30) || '\2', 'g'), chr(30))"


@query(f"SELECT doc_id, CAST(len({_SENT}) AS INTEGER) AS n_sentences FROM documents")
def q_sentences(spark, d):
    return t(spark, d, "documents").select("doc_id", F.size(X.sentences(c("text"))).alias("n_sentences"))


@query(f"""WITH s AS (SELECT doc_id, generate_subscripts({_SENT}, 1) - 1 AS i, unnest({_SENT}) AS s FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS sentence_idx, trim(regexp_replace(regexp_replace(s, '[0-9]+', '', 'g'), '\\s+', ' ', 'g')) AS sentence FROM s WHERE regexp_matches(s, '[0-9]')""")
def q_sentence_events(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.posexplode(X.sentences(c("text"))).alias("sentence_idx", "s")).filter(c("s").rlike("[0-9]"))
    return rows.select("doc_id", "sentence_idx", V.squeeze(F.regexp_replace("s", "[0-9]+", "")).alias("sentence"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '[\x09-\x0D\x1c-\x20]+', ' ', 'g'))) AS digest FROM documents")
def q_norm_ws(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(V.squeeze(c("text")).cast("binary")).alias("digest"))


_DOI_TEXT = "'see 10.' || CAST(1000 + doc_id AS VARCHAR) || '/abc' || CAST(doc_id AS VARCHAR) || repeat('.;)', CAST(doc_id % 3 AS INTEGER)) || ' PMID: ' || CAST(1000 + doc_id AS VARCHAR)"


@query(rf"""SELECT doc_id, rtrim(regexp_extract(s, '\b10\.\d{{4,9}}/[^\s"<>]+'), '.,;)') AS doi, CAST(regexp_extract(s, '(?i)pmid[:\s]*([0-9]{{4,9}})', 1) AS BIGINT) AS pmid FROM (SELECT doc_id, {_DOI_TEXT} AS s FROM documents)""")
def q_doi_regex(spark, d):
    s = F.concat(lit("see 10."), (c("doc_id") + 1000).cast("string"), lit("/abc"), c("doc_id").cast("string"), F.repeat(lit(".;)"), (c("doc_id") % 3).cast("int")), lit(" PMID: "), (c("doc_id") + 1000).cast("string"))
    return t(spark, d, "documents").select("doc_id", s.alias("s")).select("doc_id", X.inline_doi(c("s")).alias("doi"), X.inline_pmid(c("s")).alias("pmid"))


_SQUEEZED = r"trim(regexp_replace(text, '[\x09-\x0D\x1c-\x20]+', ' ', 'g'))"


@query(f"SELECT doc_id, md5(substring({_SQUEEZED}, 1, 1200)) AS digest, CAST(length(substring({_SQUEEZED}, 1, 1200)) AS INTEGER) AS n FROM documents")
def q_raw_cap(spark, d):
    none = lit(None).cast("string")
    raw = F.struct(lit("r").alias("ref_id"), F.array().cast("array<string>").alias("pmids"), F.array().cast("array<string>").alias("dois"), none.alias("title"), none.alias("chapter"), none.alias("journal"), none.alias("year"), c("text").alias("raw"))
    return t(spark, d, "documents").select("doc_id", articles.reference(raw)["raw"].alias("x")).select("doc_id", F.md5(c("x").cast("binary")).alias("digest"), F.length("x").alias("n"))


_INT_TEXT = "CASE page_id % 4 WHEN 0 THEN ' +' || page_id || ' ' WHEN 1 THEN page_id || '.7' WHEN 2 THEN 'x' || page_id ELSE '-' || page_id END"


@query(rf"SELECT page_id, CASE WHEN regexp_matches(trim(s), '^[+-]?[0-9]+$') THEN CAST(replace(trim(s), '+', '') AS BIGINT) END AS n FROM (SELECT page_id, {_INT_TEXT} AS s FROM pages)")
def q_try_int(spark, d):
    k, n = c("page_id") % 4, c("page_id").cast("string")
    s = F.when(k == 0, F.concat(lit(" +"), n, lit(" "))).when(k == 1, F.concat(n, lit(".7"))).when(k == 2, F.concat(lit("x"), n)).otherwise(F.concat(lit("-"), n))
    return t(spark, d, "pages").select("page_id", V.try_int(s).alias("n"))


_HEADINGS = ["Introduction", "Background", "Methods", "Materials and methods", "Study design", "Results", "Main finding", "Results and Discussion", "Conclusion", "Conclusions", "Overview of protocol", ""]
_HEADING_SQL = f"list_extract({_HEADINGS!r}, CAST(doc_id % {len(_HEADINGS)} AS INTEGER) + 1)"


def _case(expr: str, patterns: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, '(?i){p}') THEN '{n}'" for n, p in patterns.items()) + f" ELSE '{default}' END"


@query(f"SELECT doc_id, {_case(_HEADING_SQL, X.SECTIONS, 'other')} AS section_bucket FROM documents")
def q_section_bucket(spark, d):
    name = F.element_at(F.array(*map(lit, _HEADINGS)), (c("doc_id") % len(_HEADINGS)).cast("int") + 1)
    return t(spark, d, "documents").select("doc_id", X.section_bucket(name).alias("section_bucket"))


_WORDS = {"Green": r"\b(green|lime)", "Ring": r"\b(ring|gizmo)", "Metal": r"\b(steel|brass|tin)"}


@query(f"SELECT p_partkey, {_case('p_name', _WORDS, 'Other')} AS bucket, {_case('p_name', X.SPECIALTIES, 'Other')} AS specialty FROM part")
def q_specialty_bucket(spark, d):
    words = F.split("p_name", " ")
    return t(spark, d, "part").select("p_partkey", X.specialty_bucket(words, _WORDS).alias("bucket"), X.specialty_bucket(words).alias("specialty"))


_DESIGN_SQL = "CASE design " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.DESIGNS.items()) + " ELSE 'other' END"
_DESIGN_NAMES = [*X.DESIGNS, "unheard-of"]


@query(f"SELECT p_partkey, {_DESIGN_SQL} AS design_bucket FROM (SELECT p_partkey, list_extract({_DESIGN_NAMES!r}, CAST(p_partkey % {len(_DESIGN_NAMES)} AS INTEGER) + 1) AS design FROM part)")
def q_design_bucket(spark, d):
    design = F.element_at(F.array(*map(lit, _DESIGN_NAMES)), (c("p_partkey") % len(_DESIGN_NAMES)).cast("int") + 1)
    return t(spark, d, "part").select("p_partkey", X.design_bucket(design).alias("design_bucket"))


_KEY_SQL = "coalesce(CASE WHEN doc_id % 5 <> 0 THEN lang END, 'None') || '|' || CAST(doc_id AS VARCHAR) || '|None|' || substring(text, 1, 80)"


@query(f"SELECT doc_id, {_KEY_SQL} AS record_key, substring(sha256({_KEY_SQL}), 1, 16) AS record_id FROM documents")
def q_record_key(spark, d):
    key = X.record_key(F.when(c("doc_id") % 5 != 0, c("lang")), c("doc_id"), lit(None).cast("int"), c("text"))
    return t(spark, d, "documents").select("doc_id", key.alias("record_key")).withColumn("record_id", X.record_id(c("record_key")))


# Results: a document is a record, ok if labelled.  Ids stand for line ordinals and article ids.

_RESULTS_SQL = """(SELECT doc_id, substring(text, 1, 80) AS record_key, lang, source, l.doc_id IS NOT NULL AS ok, CAST(d.doc_id % 5 AS INTEGER) AS attempts,
CASE WHEN toxic = 1 THEN 'mismatch' WHEN quality = 1 THEN 'match' WHEN quality = 0 THEN 'ambiguous' END AS relevance, CASE CAST(d.doc_id % 4 AS INTEGER) WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' WHEN 2 THEN 'weak' ELSE 'insufficient-context' END AS strength
FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _results(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.substring("text", 1, 80).alias("record_key"), "lang", "source")
    labels = t(spark, d, "labels").select("doc_id", "quality", "toxic", lit(True).alias("ok"))
    rows = docs.join(labels, "doc_id", "left")
    relevance = F.when(c("toxic") == 1, "mismatch").when(c("quality") == 1, "match").when(c("quality") == 0, "ambiguous")
    strength = F.element_at(F.array(*map(lit, ("strong", "moderate", "weak", "insufficient-context"))), (c("doc_id") % 4).cast("int") + 1)
    return rows.select("doc_id", "record_key", "lang", "source", F.coalesce("ok", lit(False)).alias("ok"), (c("doc_id") % 5).cast("int").alias("attempts"), relevance.alias("relevance"), strength.alias("strength"))


_TIER_SQL = "CASE WHEN NOT ok THEN 4 WHEN attempts IN (1, 2, 3) THEN attempts - 1 ELSE 3 END"
_BEST_SQL = f"SELECT record_key, doc_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY tier, CASE WHEN attempts = 0 THEN 99 ELSE attempts END, doc_id) AS n FROM (SELECT *, {_TIER_SQL} AS tier FROM {_RESULTS_SQL})) WHERE n = 1"


def _graded(spark, d):
    rows = _results(spark, d)
    return rows.select("record_key", "doc_id", curate.tier(c("ok"), c("attempts")).alias("tier"), curate.tried(c("attempts")).alias("tried"))


@query(_BEST_SQL)
def q_dedupe_best(spark, d):
    return curate.ranked_best(_graded(spark, d), order=("tier", "tried", "doc_id")).select("record_key", "doc_id", "tier")


@query(_BEST_SQL)
def q_dedupe_minby(spark, d):
    return curate.best_per_key(_graded(spark, d), order=("tier", "tried", "doc_id")).select("record_key", "doc_id", "tier")


@query(f"SELECT count(*) AS total, count(DISTINCT record_key) AS n_unique, count(*) - count(DISTINCT record_key) AS dropped, round(100.0::DOUBLE * (count(*) - count(DISTINCT record_key)) / count(*), 6) AS dropped_pct FROM {_RESULTS_SQL}")
def q_dedupe_stats(spark, d):
    return curate.drop_counts(_results(spark, d))


@query(f"SELECT attempts, coalesce(relevance, 'none') AS relevance, count(*) AS n FROM {_RESULTS_SQL} GROUP BY ALL")
def q_value_counts(spark, d):
    return reports.value_counts(_results(spark, d), "attempts", "relevance")


_STRATUM = "CASE WHEN relevance IN ('mismatch', 'ambiguous') THEN relevance WHEN relevance = 'match' THEN CASE WHEN strength IN ('strong', 'moderate', 'weak') THEN 'match_' || strength ELSE '{}' END {} END"
_STRATUM_SQL = _STRATUM.format("ambiguous", "")


@query(f"SELECT doc_id, {_STRATUM_SQL} AS stratum, {_STRATUM.format('other', chr(32) + 'ELSE ' + repr('other'))} AS report_stratum FROM {_RESULTS_SQL} WHERE ok")
def q_stratum(spark, d):
    return _results(spark, d).filter("ok").select("doc_id", X.stratum(c("relevance"), c("strength")).alias("stratum"), X.report_stratum(c("relevance"), c("strength")).alias("report_stratum"))


@query("SELECT lang, source, count(*) AS pop, min(doc_id) AS first_seen FROM documents GROUP BY ALL")
def q_cells(spark, d):
    return curate.cells(t(spark, d, "documents").select("lang", "source", "doc_id"), ("lang", "source"), "doc_id")


@query("""SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY ALL
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL""")
def q_marginals(spark, d):
    return curate.marginals(t(spark, d, "documents").select("lang", "source"), ("lang", "source"))


def _allocation_sql(target: int) -> str:
    return f"""(SELECT lang, source, pop, first_seen, CASE WHEN total <= {target} THEN pop ELSE CAST(fl AS BIGINT) + CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY raw - fl DESC, first_seen) <= {target} - sum(fl) OVER (PARTITION BY lang) THEN 1 ELSE 0 END END AS n
FROM (SELECT *, floor(raw) AS fl FROM (SELECT *, CAST({target} AS DOUBLE) * pop / total AS raw FROM (SELECT *, sum(pop) OVER (PARTITION BY lang) AS total FROM (SELECT lang, source, count(*) AS pop, min(doc_id) AS first_seen FROM documents GROUP BY ALL)))))"""


@query(f"SELECT lang, source, pop, first_seen, CAST(n AS BIGINT) AS n FROM {_allocation_sql(40)}")
def q_allocate(spark, d):
    return curate.allocated(q_cells(spark, d), "lang", 40)


@query(f"""SELECT doc_id, lang, source FROM (SELECT d.doc_id, d.lang, d.source, a.n, row_number() OVER (PARTITION BY d.lang, d.source ORDER BY sha256('42|' || CAST(d.doc_id AS VARCHAR)), d.doc_id) AS r
FROM documents d JOIN {_allocation_sql(40)} a USING (lang, source)) WHERE r <= n""")
def q_sample_hash(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang", "source")
    return curate.sampled_by_hash(docs, ("lang", "source"), 40, "42", key="doc_id", position="doc_id").select("doc_id", "lang", "source")


@query()
def q_sample_exact(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang", "source")
    return curate.sampled_exactly(docs, ("lang", "source"), 40, 42, position="doc_id", strata=("de", "en", "es", "fr")).select("doc_id", "lang", "source")


_ORDER_KEY = "CAST(o_custkey AS VARCHAR) || '|' || o_orderkey || '|None|' || o_orderpriority"
_SPLIT_SQL = f"""(SELECT o_orderkey, o_custkey, {_ORDER_KEY} AS record_key, CAST(o_custkey AS VARCHAR) AS citing_pmcid, CASE WHEN o_orderkey <> 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS cited_pmid,
CASE WHEN NOT ok THEN 'fail' WHEN o_orderkey % 17 = 0 THEN 'gold' WHEN x < 50 THEN 'val' WHEN x < 150 THEN 'test' ELSE 'train' END AS split,
CASE WHEN NOT ok THEN 'FAIL' WHEN o_orderstatus = 'F' THEN 'mismatch' ELSE 'match' END AS relevance_check, CASE WHEN ok THEN o_orderpriority ELSE 'FAIL' END AS cited_study_design, CASE WHEN NOT ok THEN 'FAIL' WHEN o_orderkey % 2 = 0 THEN 'weak' ELSE '' END AS support_strength
FROM (SELECT *, o_orderkey % 5 <> 1 AS ok, ('0x' || substring(sha256('seed|' || CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT % 1000 AS x FROM orders))"""


def _split(spark, d):
    """The split table of extraction results: an order is a result, its customer the citing article; every fifth one failed."""
    good = c("o_orderkey") % 5 != 1
    text = lambda x: x.cast("string")
    source = F.struct(F.struct(text(c("o_custkey")).alias("pmcid")).alias("citing"), F.struct(lit(None).cast("int").alias("paragraph_idx"), c("o_orderpriority").alias("evidence_sentence")).alias("context"), F.struct(c("o_orderkey").alias("pmid")).alias("cited"))
    said = F.struct(F.when(c("o_orderstatus") == "F", "mismatch").otherwise("match").alias("relevance_check"), c("o_orderpriority").alias("cited_study_design"), F.when(c("o_orderkey") % 2 == 0, "weak").alias("support_strength"))
    rows = t(spark, d, "orders").select("o_orderkey", source.alias("input"), good.alias("ok"), F.when(good, said).alias("extracted"))
    return curate.split_index(rows, curate.gold_keys(rows.filter("o_orderkey % 17 = 0")), "seed")


@query(f"SELECT record_key, citing_pmcid, cited_pmid, split, relevance_check, cited_study_design, support_strength FROM {_SPLIT_SQL}")
def q_split(spark, d):
    return _split(spark, d).select(*schemas.SPLIT_COLUMNS)


@query(f"""SELECT split, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS pct,
CASE WHEN split NOT IN ('fail', 'gold') THEN round(100.0::DOUBLE * count(*) / sum(CASE WHEN split NOT IN ('fail', 'gold') THEN count(*) END) OVER (), 6) END AS pct_of_hashed FROM {_SPLIT_SQL} GROUP BY split""")
def q_split_sizes(spark, d):
    return curate.split_sizes(_split(spark, d))


@query(f"SELECT split, count(*) FILTER (WHERE relevance_check = 'match') AS \"match\", count(*) FILTER (WHERE relevance_check = 'mismatch') AS mismatch, count(*) FILTER (WHERE relevance_check = 'FAIL') AS \"FAIL\" FROM {_SPLIT_SQL} GROUP BY split")
def q_split_xtab(spark, d):
    return curate.crosstab(_split(spark, d), "split", "relevance_check", ("match", "mismatch", "FAIL"))


@query(f"SELECT split, cited_study_design, count(*) AS n FROM {_SPLIT_SQL} WHERE split <> 'fail' GROUP BY ALL")
def q_split_designs(spark, d):
    return curate.split_designs(_split(spark, d))


@query(f"SELECT split, CASE WHEN relevance_check = 'mismatch' THEN 'mismatch' WHEN support_strength = 'weak' THEN 'match_weak' ELSE 'other' END AS stratum, count(*) AS n FROM {_SPLIT_SQL} WHERE split <> 'fail' GROUP BY ALL")
def q_split_strata(spark, d):
    return curate.split_strata(_split(spark, d))


@query(f"SELECT split, count(*) FILTER (WHERE relevance_check = 'mismatch') AS n_mismatch, count(DISTINCT citing_pmcid) AS n_articles FROM {_SPLIT_SQL} GROUP BY split")
def q_split_pools(spark, d):
    return curate.pools(_split(spark, d))


@query(f"SELECT count(DISTINCT citing_pmcid) AS n_articles FROM {_SPLIT_SQL} WHERE split NOT IN ('gold', 'fail')")
def q_pool_total(spark, d):
    return curate.pool_total(_split(spark, d))


@query(f"SELECT record_key, split FROM {_SPLIT_SQL} WHERE relevance_check = 'mismatch'")
def q_mismatches(spark, d):
    return reports.mismatches(_split(spark, d)).select("record_key", "split")


@query(f"SELECT citing_pmcid, min(split) AS one, max(split) AS other FROM {_SPLIT_SQL} WHERE split NOT IN ('fail', 'gold') GROUP BY citing_pmcid HAVING count(DISTINCT split) > 1")
def q_split_invariant(spark, d):
    return curate.torn_articles(_split(spark, d))


@query("""SELECT c, min(split) AS one, max(split) AS other FROM (SELECT CAST(o_custkey AS VARCHAR) AS c, CASE WHEN x < 50 THEN 'val' WHEN x < 150 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, ('0x' || substring(sha256('seed|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 1000 AS x FROM orders)) GROUP BY c HAVING count(DISTINCT split) > 1""")
def q_torn_articles(spark, d):
    """Splits by record instead of by article tear articles apart; all of those are found."""
    rows = t(spark, d, "orders").select(c("o_custkey").cast("string").alias("c"), curate.split_of(c("o_orderkey").cast("string"), "seed").alias("split"))
    return curate.torn_articles(rows, "c")


@query(f"SELECT record_key, doc_id, i.split FROM (SELECT o_orderkey AS doc_id, {_ORDER_KEY} AS record_key FROM orders) JOIN {_SPLIT_SQL} i USING (record_key)")
def q_materialised(spark, d):
    text = lambda x: x.cast("string")
    source = F.struct(F.struct(text(c("o_custkey")).alias("pmcid")).alias("citing"), F.struct(lit(None).cast("int").alias("paragraph_idx"), c("o_orderpriority").alias("evidence_sentence")).alias("context"), F.struct(c("o_orderkey").alias("pmid")).alias("cited"))
    rows = t(spark, d, "orders").select(c("o_orderkey").alias("doc_id"), source.alias("input"))
    return curate.materialised(rows, _split(spark, d)).select("record_key", "doc_id", "split")


# Lookups.


@query("SELECT o_orderkey, CAST(o_orderkey * 1000 // 1000000 AS INTEGER) AS pmid_bucket FROM orders")
def q_pmid_bucket(spark, d):
    return t(spark, d, "orders").select("o_orderkey", lookups.bucket(c("o_orderkey") * 1000).alias("pmid_bucket"))


@query("""SELECT l_orderkey, list_extract(list_filter(ids, lambda x: lower(x.k) = 'r'), 1).v AS value FROM
(SELECT l_orderkey, list({'n': l_linenumber, 'p': l_partkey, 'k': l_returnflag, 'v': CAST(l_partkey AS VARCHAR)} ORDER BY l_linenumber, l_partkey, l_returnflag) AS ids FROM lineitem GROUP BY l_orderkey)""")
def q_first_match(spark, d):
    x = F.struct("l_linenumber", "l_partkey", c("l_returnflag").alias("id_type"), c("l_partkey").cast("string").alias("value"))
    rows = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(x)).alias("ids"))
    return rows.select("l_orderkey", lookups.first_by_type(c("ids"), "r").alias("value"))


@query("""SELECT conv_id, CAST(count(*) FILTER (WHERE text <> '') AS INTEGER) AS n, md5(string_agg(CASE WHEN role = 'system' THEN text ELSE btrim(role || ': ' || text, ': ') END, chr(10) || chr(10) ORDER BY turn, role, text) FILTER (WHERE text <> '')) AS digest
FROM (SELECT conv_id, turn, role, text FROM conversations) GROUP BY conv_id""".replace("btrim(", "trim("))
def q_abs_join(spark, d):
    x = F.struct("turn", "role", "text")
    rows = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(x)).alias("s"))
    sections = F.transform("s", lambda y: F.struct(F.when(y["role"] != "system", y["role"]).alias("label"), y["text"].alias("text")))
    return rows.select("conv_id", F.size(F.filter("s", lambda y: y["text"] != "")).alias("n"), F.md5(lookups.joined_sections(sections).cast("binary")).alias("digest"))


@query("""SELECT l_orderkey, CAST(len(list_filter(x, lambda v: v IS NOT NULL)) AS INTEGER) AS n_ids, CAST(list_sum(list_filter(x, lambda v: v IS NOT NULL)) AS BIGINT) AS sum_ids
FROM (SELECT l_orderkey, list(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS x FROM lineitem GROUP BY l_orderkey)""")
def q_array_clean(spark, d):
    raw = F.when(c("l_returnflag") == "R", c("l_partkey").cast("string")).otherwise("x")
    refs = F.collect_list(F.struct(raw.alias("pmid"), lit(None).cast("string").alias("doi"))).alias("references")
    none = lambda name: lit(None).cast(dict(x.split(" ", 1) for x in _PUBMED_FIELDS)[name]).alias(name)
    rows = t(spark, d, "lineitem").groupBy(c("l_orderkey").cast("string").alias("pmid")).agg(refs)
    rows = rows.select("pmid", "references", *[none(x.split(" ", 1)[0]) for x in _PUBMED_FIELDS if not x.startswith(("pmid ", "references "))])
    ids = c("reference_pmids")
    total = F.aggregate(ids, lit(None).cast("bigint"), lambda a, v: F.coalesce(a, lit(0).cast("bigint")) + v)
    return lookups.publications(rows).select(c("pmid").alias("l_orderkey"), F.size(ids).alias("n_ids"), total.alias("sum_ids"))


@query("SELECT o_orderkey AS pmid, o_totalprice FROM orders ORDER BY o_orderkey")
def q_sorted_index(spark, d):
    return lookups.sorted_lookup(t(spark, d, "orders").select(c("o_orderkey").alias("pmid"), "o_totalprice"))


_PUBMED_FIELDS = ("pmid string", "article_ids array<struct<id_type:string,value:string>>", "title string", "abstract array<struct<label:string,text:string>>", "journal struct<title:string,iso_abbrev:string,pub_year:string>", "article_date struct<year:string>", "publication_types array<string>", "mesh_headings array<struct<descriptor_name:string>>", "references array<struct<pmid:string,doi:string>>")


def _pubmed(spark, d, update: bool):
    """Source rows of parts, those of the update with another title."""
    pair = lambda a, b, x, y: F.struct(x.cast("string").alias(a), y.cast("string").alias(b))
    key, none = c("p_partkey").cast("string"), lit(None)
    p = t(spark, d, "part").filter("p_partkey % 3 = 0" if update else "true")
    return p.select(
        F.when(c("p_size") % 11 == 0, F.concat(lit("x"), key)).otherwise(key).alias("pmid"),
        F.array(pair("id_type", "value", lit("pubmed"), key), pair("id_type", "value", lit("DOI"), F.concat(lit("10.1/"), key)), pair("id_type", "value", lit("doi"), lit("second"))).alias("article_ids"),
        (F.concat(lit("new "), "p_name") if update else c("p_name")).alias("title"),
        F.when(c("p_size") % 7 > 0, F.array(pair("label", "text", lit("BACKGROUND"), c("p_type")), pair("label", "text", none, c("p_brand")), pair("label", "text", lit("L"), lit("")))).otherwise(F.array(pair("label", "text", lit("L"), none))).alias("abstract"),
        F.struct(c("p_brand").alias("title"), lit("iso").alias("iso_abbrev"), F.when(c("p_size") % 4 == 0, "Winter").otherwise(c("p_size").cast("string")).alias("pub_year")).alias("journal"),
        F.struct(F.when(c("p_size") % 2 == 0, (c("p_size") + 1900).cast("string")).alias("year")).alias("article_date"),
        F.when(c("p_size") % 3 == 0, F.array(lit("Review"))).alias("publication_types"),
        F.array(F.struct(c("p_type").alias("descriptor_name")), F.struct(none.cast("string").alias("descriptor_name")), F.struct(lit("").alias("descriptor_name"))).alias("mesh_headings"),
        F.array(pair("pmid", "doi", lit("12"), lit("d1")), pair("pmid", "doi", lit("x"), none), F.when(lit(False), pair("pmid", "doi", none, none)), pair("pmid", "doi", key, lit(""))).alias("references"),
    )


@query("""SELECT p_partkey AS pmid, '10.1/' || p_partkey AS doi, CASE WHEN p_partkey % 3 = 0 THEN 'new ' || p_name ELSE p_name END AS title, CASE WHEN p_size % 7 > 0 THEN 'BACKGROUND: ' || p_type || chr(10) || chr(10) || p_brand END AS abstract, p_brand AS journal_title, 'iso' AS journal_iso,
CAST(CASE WHEN p_size % 2 = 0 THEN p_size + 1900 ELSE p_size END AS INTEGER) AS pub_year, CASE WHEN p_size % 3 = 0 THEN 'Review' ELSE '' END AS pub_types, p_type AS mesh, '12,' || p_partkey AS refs, 'd1' AS dois, CAST(p_partkey // 1000000 AS INTEGER) AS pmid_bucket FROM part WHERE p_size % 11 <> 0""")
def q_publications(spark, d):
    """Baseline and updates written as shards, read with their precedence, and the last row of each id kept."""
    folders = [f"{_folder(spark)}/{name}" for name in ("baseline", "updates")]
    for folder, update in zip(folders, (False, True), strict=True):
        _pubmed(spark, d, update).write.parquet(folder)
    rows = lookups.latest_publications(tables.read_pubmed(spark, *folders))
    joined = lambda name, alias: F.array_join(name, ",").alias(alias)
    return rows.select("pmid", "doi", "title", "abstract", "journal_title", "journal_iso", "pub_year", joined("pub_types", "pub_types"), joined("mesh_descriptors", "mesh"), joined("reference_pmids", "refs"), joined("reference_dois", "dois"), lookups.bucket(c("pmid")).alias("pmid_bucket"))


@query("SELECT 'base' AS part, CAST(p_partkey AS BIGINT) AS id FROM part WHERE p_size % 11 <> 0 UNION ALL SELECT 'update', p_partkey FROM part WHERE p_partkey % 3 = 0 AND p_size % 11 <> 0")
def q_union_dirs(spark, d):
    folders = [f"{_folder(spark)}/{name}" for name in ("baseline", "updates")]
    for folder, update in zip(folders, (False, True), strict=True):
        _pubmed(spark, d, update).write.parquet(folder)
    rows = lookups.publications(tables.read_pubmed(spark, *folders))
    return rows.select(F.when(c("src_rank") == 0, "base").otherwise("update").alias("part"), c("pmid").alias("id"))


@query("""SELECT c_custkey AS pmid, CASE WHEN c_custkey % 7 IN (0, 1, 2) THEN NULL ELSE c_name END AS journal, CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS is_clinical,
CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS citation_count FROM customer""")
def q_csv_nulls(spark, d):
    pick = lambda k, *values: F.element_at(F.array(*[lit(v) for v in values]), (c("c_custkey") % k).cast("int") + 1)
    raw = t(spark, d, "customer").select(c("c_custkey").alias("pmid"), F.when(c("c_custkey") % 7 > 2, c("c_name")).otherwise(pick(7, "", "NA", "None", "", "", "", "")).alias("journal"), pick(5, "True", "1", "FALSE", "0", "maybe").alias("is_clinical"), F.when(c("c_custkey") % 4 == 0, "n/a").otherwise(c("c_nationkey").cast("string")).alias("citation_count"), lit('a "quoted", one').alias("extra"))
    known = {"pmid", "journal", "is_clinical", "citation_count"}
    path = _folder(spark)
    raw.select("extra", *[c(n) if n in known else lit("").alias(n) for n in schemas.ICITE]).write.csv(path, header=True, escape='"', emptyValue="")
    return tables.read_citation_metrics(spark, path).select("pmid", "journal", "is_clinical", "citation_count")


@query("SELECT line_idx, value FROM (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS line_idx, n_name AS value FROM nation)")
def q_lines(spark, d):
    """Lines of a written file with their ordinals."""
    path = _folder(spark)
    t(spark, d, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return tables.read_lines(spark, path)


# Extraction and use.

_REPLY = """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN 2 THEN 'Sure: ' || props || ' ok' ELSE 'nothing here' END"""


@query(f"""SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, event_id % 4 < 3 AS found FROM events""")
def q_json_recover(spark, d):
    k, p = c("event_id") % 4, c("props")
    reply = F.when(k == 0, p).when(k == 1, F.concat(lit("```json\n"), p, lit("\n```"))).when(k == 2, F.concat(lit("Sure: "), p, lit(" ok"))).otherwise("nothing here")
    return t(spark, d, "events").select("event_id", E.recovered(reply).alias("j")).select("event_id", F.try_variant_get(F.try_parse_json("j"), "$.k", "bigint").alias("k"), c("j").isNotNull().alias("found"))


_PURPOSE = ["background", "method", "contrast", "statistic", "unknown"]


@query(f"""SELECT event_id, ok AS valid FROM (SELECT event_id, list_extract({_PURPOSE!r}, CAST(event_id % 5 AS INTEGER) + 1) IN ('background', 'method', 'contrast') AND event_id % 3 <> 0 AND event_id % 11 <> 0 AS ok FROM events)""")
def q_validate_enum(spark, d):
    purpose = F.element_at(F.array(*map(lit, _PURPOSE)), (c("event_id") % 5).cast("int") + 1)
    answer = F.when(c("event_id") % 11 == 0, F.repeat(lit("x"), 1501)).otherwise(F.repeat(lit("x"), 1500))
    fields = {"relevance_check": lit("match"), "attributed_claim": lit("a"), "citation_purpose": purpose, "evidence_type": lit("other"), "support_strength": lit("weak"), "cited_study_design": F.when(c("event_id") % 3 != 0, "rct"), "question": lit("q"), "answer": answer, "extra": lit(1)}
    return t(spark, d, "events").select("event_id", F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("j")).select("event_id", (F.size(E.problems(c("j"))) == 0).alias("valid"))


_GOOD = {"relevance_check": "match", "attributed_claim": "a", "citation_purpose": "method", "evidence_type": "other", "support_strength": "weak", "cited_study_design": "rct", "question": "q", "answer": "x"}
_FAULTS: list[tuple[str, dict]] = [
    ("", {}),
    *[(name, {name: None}) for name in E.REQUIRED],
    *[(name, {name: 7}) for name in E.REQUIRED],
    *[(name, {name: "no such value"}) for name in E.CHOICES if name != "answer_grounded_in"],
    *[(name, {name: "x" * (E.CAP + 1)}) for name in E.CAPPED],
    ("", {name: "é" * E.CAP for name in E.CAPPED}),
    ("mismatch_reason", {"mismatch_reason": []}),
    ("answer_grounded_in", {"answer_grounded_in": ["both", "neither"]}),
    ("answer_grounded_in", {"answer_grounded_in": "both"}),
    ("", {"answer_grounded_in": ["both", "cited_abstract"], "more": [1]}),
    ("statistic_extraction", {"statistic_extraction": {"metric": "m"}}),
    ("statistic_extraction", {"statistic_extraction": {"metric": "m", "value": 1}}),
    ("statistic_extraction", {"statistic_extraction": {"metric": "m", "value": "v", "p_value": 0.1}}),
    ("statistic_extraction", {"statistic_extraction": {"metric": "m", "value": "v", "n_subjects": 1.5}}),
    ("", {"statistic_extraction": {"metric": "m", "value": "v", "n_subjects": 12, "ci_or_range": "r"}}),
    ("", {"statistic_extraction": None}),
]


@query(f"SELECT event_id, list_extract({[name for name, _ in _FAULTS]!r}, CAST(event_id % {len(_FAULTS)} AS INTEGER) + 1) AS broken FROM events")
def q_validate_rules(spark, d):
    """Each rule of a record broken in turn."""
    records = [json.dumps({k: v for k, v in (_GOOD | change).items() if not (v is None and k in E.REQUIRED)}, ensure_ascii=False) for _, change in _FAULTS]
    cases = spark.createDataFrame(list(enumerate(records)), "k long, j string").select("k", F.array_join(E.problems(c("j")), ",").alias("broken"))
    return t(spark, d, "events").select("event_id", (c("event_id") % len(_FAULTS)).alias("k")).join(F.broadcast(cases), "k").select("event_id", "broken")


_LIMITED = "coalesce(nullif(substring(text, 1, 3500), ''), '(not given)')"
_PROMPT_SQL = f"""'[CITED ABSTRACT]' || chr(10) || 'text = ' || {_LIMITED} || chr(10) || chr(10) || '[CITED WORK]' || chr(10) || 'title = ' || lang || chr(10) || 'published = 1999' || chr(10) || 'subjects = a; b' || chr(10) || chr(10)
|| '[SENTENCE WITH THE CITATION]' || chr(10) || CASE WHEN text <> '' THEN 'text = ' || text || chr(10) ELSE '' END || 'part = other' || chr(10) || 'works cited here = 1' || chr(10) || chr(10)
|| '[CITING WORK]' || chr(10) || 'venue = ' || source || chr(10) || 'pubmed = ' || doc_id || chr(10) || chr(10) || '{E.ASK}'"""


def _records(spark, d):
    none = lambda kind: lit(None).cast(kind)
    citing = F.struct(none("string").alias("pmcid"), c("doc_id").alias("pmid"), none("string").alias("doi"), lit("").alias("title"), c("source").alias("journal"), none("int").alias("year"), none("string").alias("license"), none("string").alias("subset"), none("array<string>").alias("mesh"), none("array<string>").alias("pub_types"))
    context = F.struct(none("string").alias("section"), lit("other").alias("section_bucket"), none("int").alias("paragraph_idx"), lit(False).alias("in_table"), lit(False).alias("in_fig"), c("text").alias("evidence_sentence"), lit(1).alias("n_co_cited_refs"), F.array(lit("r")).alias("co_cited_ref_ids"))
    cited = F.struct(lit("r").alias("ref_id"), none("bigint").alias("pmid"), none("string").alias("doi"), c("lang").alias("title"), c("text").alias("abstract"), none("string").alias("journal"), lit(1999).alias("year"), F.array(lit("a"), lit("b")).alias("mesh"), none("array<string>").alias("pub_types"), none(schemas.IMPACT).alias("icite"))
    return t(spark, d, "documents").select("doc_id", F.struct(citing.alias("citing"), context.alias("context"), cited.alias("cited")).alias("input"))


@query(f"SELECT doc_id, md5({_PROMPT_SQL}) AS digest FROM documents")
def q_prompt(spark, d):
    return _records(spark, d).select("doc_id", F.md5(E.user_prompt(c("input.citing"), c("input.context"), c("input.cited")).cast("binary")).alias("digest"))


@query("""SELECT conv_id, turn, 3 AS n_turns, 'system,user,assistant' AS roles, md5(text) AS sentence_digest, role AS answer_question, 0 AS n_grounds FROM conversations""")
def q_chat(spark, d):
    record = {name: lit("") for name in E.SCALARS} | {"question": c("role")}
    turns = E.chat("You are careful.", c("text"), c("role"), record, lit(None).cast("string"), lit(None).cast("string"))
    rows = t(spark, d, "conversations").select("conv_id", "turn", turns.alias("m"))
    user, answer = F.from_json(c("m")[1]["content"], "citing_sentence string, cited_abstract string"), F.from_json(c("m")[2]["content"], schemas.EXTRACTED)
    return rows.select("conv_id", "turn", F.size("m").alias("n_turns"), F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"), F.md5(user["citing_sentence"].cast("binary")).alias("sentence_digest"), answer["question"].alias("answer_question"), F.size(answer["answer_grounded_in"]).alias("n_grounds"))


_LOOSE = "trim(regexp_replace(lower({}), '[\\x09-\\x0D\\x1c-\\x20\\x85\\xa0]+', ' ', 'g'))"


@query(f"""SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN contains({_LOOSE.format('text')}, {_LOOSE.format("CASE WHEN doc_id % 3 = 0 THEN 'no such quote' ELSE '  ' || substring(text, 5, 30) || ' ' END")}) END AS quote_found FROM documents""")
def q_grounded(spark, d):
    quote = F.when(c("doc_id") % 5 == 0, "").when(c("doc_id") % 3 == 0, "no such quote").otherwise(F.concat(lit("  "), F.substring("text", 5, 30), lit(" ")))
    return t(spark, d, "documents").select("doc_id", X.grounded(quote, c("text")).alias("quote_found"))


@query("SELECT 'PMC' || CAST(doc_id AS VARCHAR) AS pmcid, doc_id AS pmid, 1 AS n_refs, 1 AS n_citations, 'Methods' AS section, 0 AS paragraph_idx, 'Start here .' AS sentence, 'r1' AS ref_id FROM documents")
def q_parse_jats(spark, d):
    body = F.regexp_replace("text", "[^A-Za-z. ]+", " ")
    xml = F.concat(lit('<article><front><article-meta><article-id pub-id-type="pmc">'), c("doc_id").cast("string"), lit('</article-id><article-id pub-id-type="pmid"> '), c("doc_id").cast("string"), lit(' </article-id></article-meta></front><body><sec><title>Methods</title><p>Start here <xref ref-type="bibr" rid="r1 rx">1</xref>. Next. '), body, lit('</p></sec></body><back><ref-list><ref id="r1"><mixed-citation>Some text</mixed-citation></ref></ref-list></back></article>'))
    members = t(spark, d, "documents").select(lit("oa_comm").alias("subset"), F.concat(c("doc_id").cast("string"), lit(".xml")).alias("member"), xml.cast("binary").alias("data"))
    rows = articles.parse_articles(members)
    return rows.select("pmcid", "pmid", "n_refs", "n_citations", F.explode("citations").alias("e")).select("pmcid", "pmid", "n_refs", "n_citations", c("e.section").alias("section"), c("e.paragraph_idx").alias("paragraph_idx"), c("e.sentence").alias("sentence"), c("e.ref_ids")[0].alias("ref_id"))


def _article(spark, d):
    """Articles with sections within sections, tables, nested paragraphs and both kinds of reference; years, licences and form vary, every fifth lacks its last tags."""
    k = c("doc_id").cast("string")
    when = lambda test, x, other="": F.when(F.expr(test), lit(x)).otherwise(other)
    parts = [
        lit('<article><front><journal-meta><journal-title-group><journal-title>J Test</journal-title></journal-title-group></journal-meta><article-meta><article-id pub-id-type="pmc">'), k,
        lit('</article-id><article-id pub-id-type="pmid">'), when("doc_id % 4 = 0", "n/a"), when("doc_id % 4 > 0", " 77 "), lit('</article-id><title-group><article-title>A <italic>b</italic> c</article-title></title-group><pub-date pub-type="ppub"><year>2001</year></pub-date>'),
        when("doc_id % 2 = 0", '<pub-date pub-type="epub"><year>2002</year></pub-date>'), when("doc_id % 3 = 0", '<permissions><license license-type="open-access"><license-p>Text</license-p></license></permissions>', '<permissions><license><license-p>Free  text</license-p></license></permissions>'),
        lit("""</article-meta></front><body><sec><title>Methods</title><p>No cites here.</p><p>Alpha works <xref ref-type="bibr" rid="r1">1</xref>. Beta fails. Gamma <xref ref-type="bibr" rid="r1 r2">1,2</xref> is fine.</p>
<sec><p>Tail after dot.<xref ref-type="bibr" rid="r2">2</xref> Next sentence.</p></sec><table-wrap><p>Cell <xref ref-type="bibr" rid="r1">1</xref>.</p><p>Cell <xref ref-type="bibr" rid="r9">9</xref>.</p></table-wrap></sec>
<sec><title>Discussion</title><p>Outer start. <list><list-item><p>Inner <xref ref-type="bibr" rid="r1">1</xref>.</p></list-item></list> Outer end.</p><fig><p>Seen <xref ref-type="bibr" rid="r2">2</xref>.</p></fig></sec></body><back><ref-list><ref id="r1"><element-citation><article-title>T1</article-title><source>S1</source><year>1999</year><pub-id pub-id-type="pmid">"""), k,
        lit('</pub-id></element-citation></ref><ref id="r2"><mixed-citation>Some raw text. PMID: 222333. doi 10.1000/xyz.1).</mixed-citation></ref><ref><mixed-citation>no id</mixed-citation></ref>'), when("doc_id % 5 > 0", "</ref-list></back></article>"),
    ]
    return t(spark, d, "documents").select(lit("oa_comm").alias("subset"), F.concat(k, lit(".xml")).alias("member"), F.concat(*parts).cast("binary").alias("data"))


_ARTICLE_SQL = "'PMC' || doc_id AS pmcid, CASE WHEN doc_id % 4 > 0 THEN 77 END AS pmid, 'A b c' AS title, 'J Test' AS journal, CAST(CASE WHEN doc_id % 2 = 0 THEN 2002 ELSE 2001 END AS INTEGER) AS year, CASE WHEN doc_id % 3 = 0 THEN 'open-access' ELSE 'Free text' END AS license"


@query(f"""SELECT {_ARTICLE_SQL}, 2 AS n_refs, 7 AS n_citations, section, paragraph_idx, ref_ids, sentence, in_table, in_fig FROM documents CROSS JOIN (VALUES ('Methods', 1, 'r1', 'Alpha works .', false, false), ('Methods', 1, 'r1,r2', 'Gamma is fine.', false, false),
('Methods', 2, 'r2', 'Tail after dot. Next sentence.', false, false), ('Methods', 3, 'r1', 'Cell .', true, false), ('Discussion', 5, 'r1', 'Inner .', false, false), ('Discussion', 6, 'r1', 'Inner .', false, false), ('Discussion', 7, 'r2', 'Seen .', false, true)) v(section, paragraph_idx, ref_ids, sentence, in_table, in_fig)""")
def q_article_events(spark, d):
    rows = articles.parse_articles(_article(spark, d)).select("pmcid", "pmid", "title", "journal", "year", "license", "n_refs", "n_citations", F.explode("citations").alias("e"))
    return rows.select("pmcid", "pmid", "title", "journal", "year", "license", "n_refs", "n_citations", "e.section", "e.paragraph_idx", F.array_join("e.ref_ids", ",").alias("ref_ids"), "e.sentence", "e.in_table", "e.in_fig")


@query("""SELECT 'PMC' || doc_id AS pmcid, 'r1' AS ref_id, doc_id AS pmid, CAST(NULL AS VARCHAR) AS doi, 'T1' AS title, 'S1' AS journal, 1999 AS year, 'T1S11999' || doc_id AS raw FROM documents
UNION ALL SELECT 'PMC' || doc_id, 'r2', 222333, '10.1000/xyz.1', NULL, NULL, NULL, 'Some raw text. PMID: 222333. doi 10.1000/xyz.1).' FROM documents""")
def q_article_references(spark, d):
    return articles.parse_articles(_article(spark, d)).select("pmcid", F.inline("references"))


@query("SELECT CASE WHEN doc_id % 5 > 0 THEN 'whole' ELSE 'mended' END AS outcome, count(*) AS n FROM documents GROUP BY ALL")
def q_readings(spark, d):
    return articles.readings(_article(spark, d))


@query("SELECT count(*) AS n_articles, 7 * count(*) AS n_citations, 2 * count(*) AS n_refs FROM documents")
def q_article_totals(spark, d):
    return articles.totals(articles.parse_articles(_article(spark, d)))


def _stub_sql() -> str:
    """What the stub answers, from the first 32 bits n of the prompt's digest."""
    pick = lambda name, k: f"list_extract({list(E.CHOICES[name])!r}, CAST((n >> {k}) % {len(E.CHOICES[name])} AS INTEGER) + 1)"
    return f"""(SELECT doc_id, length(u) // 4 AS usage_in, n, {pick('relevance_check', 0)} AS relevance_check,
CASE WHEN {pick('relevance_check', 0)} = 'match' THEN {pick('support_strength', 9)} ELSE 'insufficient-context' END AS support_strength, (n >> 16) % 1000 AS bad
FROM (SELECT doc_id, u, ('0x' || substring(sha256(u), 1, 8))::BIGINT AS n FROM (SELECT doc_id, {_PROMPT_SQL} AS u FROM documents)))"""


@query(f"SELECT doc_id, true AS ok, CAST(CASE WHEN bad < 300 THEN 2 ELSE 1 END AS INTEGER) AS attempts, CAST(usage_in AS INTEGER) AS usage_in, relevance_check, support_strength FROM {_stub_sql()}")
def q_extract_stub(spark, d):
    empty = spark.createDataFrame([], extract.CACHE)
    results, _ = extract.extract(_records(spark, d).select("doc_id", "input"), empty, extract.Stub(0.3), extract.Settings())
    return results.select(c("input.citing.pmid").alias("doc_id"), "ok", "attempts", "usage_in", c("extracted.relevance_check").alias("relevance_check"), c("extracted.support_strength").alias("support_strength"))


@query(f"SELECT doc_id, true AS ok, CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS attempts, CASE WHEN doc_id % 3 = 0 THEN 'stored' ELSE relevance_check END AS relevance_check FROM {_stub_sql()}")
def q_extract_cached(spark, d):
    """Prompts of every third record have a stored answer, which is taken without a call."""
    records = _records(spark, d).select("doc_id", "input")
    user = E.user_prompt(c("input.citing"), c("input.context"), c("input.cited"))
    cache = records.filter("doc_id % 3 = 0").select(E.cache_key("offline-stub", E.system_prompt(), user).alias("key"), lit("raw").alias("raw"), lit('{"relevance_check": "stored"}').alias("data"))
    results, _ = extract.extract(records, cache, extract.Stub(), extract.Settings())
    return results.select(c("input.citing.pmid").alias("doc_id"), "ok", "attempts", c("extracted.relevance_check").alias("relevance_check"))


@query("SELECT 'ok' AS outcome, count(*) AS n FROM documents")
def q_call_counts(spark, d):
    empty = spark.createDataFrame([], extract.CACHE)
    results, _ = extract.extract(_records(spark, d).select("doc_id", "input"), empty, extract.Stub(0.3), extract.Settings())
    return extract.call_counts(results).select("outcome", "n")


@query("SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 1")
def q_first_record(spark, d):
    return reports.first_where(t(spark, d, "documents").select("doc_id", "lang"), c("lang") == "en", "doc_id").select("doc_id")


@query("SELECT count(*) AS n_seen, count(*) FILTER (WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)) AS n_hits FROM lineitem")
def q_hit_counts(spark, d):
    ids = t(spark, d, "part").filter("p_size <= 10").select(c("p_partkey").alias("l_partkey"))
    return reports.hit_counts(t(spark, d, "lineitem").select("l_partkey"), ids, "l_partkey")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def q_most_common(spark, d):
    return reports.most_common(t(spark, d, "documents").select("source", "doc_id"), "source", "doc_id")
