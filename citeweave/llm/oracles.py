"""What SQL can say of the operators: whole results of some, and for others queries of the columns it can express, with their SQL (DuckDB)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import licenses, lm_scoring, mixing, secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"

JACCARD = f"""
WITH RECURSIVE t AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS h FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (h) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
r AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT e.b AS v, r.c FROM r JOIN e ON e.a = r.v)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.v = d.doc_id GROUP BY d.doc_id
"""


def base_mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op3_mix_sources(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: A source is full if its limit a weight lies below the level that all sources with smaller such limits, full, would leave.
MIX_TARGETS = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([3.0::DOUBLE, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1) AS weight, 2.0::DOUBLE * source_size AS most FROM t),
q AS (SELECT *, most / weight AS ratio, row_number() OVER (ORDER BY most / weight, source) AS rn FROM w),
o AS (SELECT *, sum(most) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held, sum(weight) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM q),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM t) - coalesce(held, 0)) / open AS level FROM o),
c AS (SELECT arg_min(level, rn) AS level FROM l WHERE ratio > level)
SELECT doc_id, size, source_size, round(least(most, coalesce(weight * c.level, most)), 3) AS target
FROM d JOIN l ON l.source IS NOT DISTINCT FROM d.source CROSS JOIN c
"""


def base_license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op8_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


LICENSE_PHRASES = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a, unnest(list_concat(w[2:], [''])) AS b, unnest(list_concat(w[3:], ['', ''])[1:len(w)]) AS c FROM t),
f AS (SELECT doc_id, i - 1 AS i, CASE WHEN a = 'cc' AND b = 'by' THEN 'cc-by' WHEN a = 'general' AND b = 'public' AND c = 'license' THEN 'gpl' WHEN a = 'all' AND b = 'rights' AND c = 'reserved' THEN 'reserved' END AS label FROM p),
g AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM f WHERE label IS NOT NULL GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(labels, '') AS base_labels FROM t LEFT JOIN g USING (doc_id)
"""


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op10_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def _spans(kind: int, name: str, pattern: str, keep: str, group: int = 0) -> str:
    """Matches with their places: the text before a match is all gaps and matches up to it."""
    pattern = pattern.replace("'", "''")
    found = f"regexp_extract_all(text, '{pattern}')"
    rows = f"SELECT doc_id, unnest(range(1, len({found}) + 1)) AS k, unnest({found}) AS m, unnest(regexp_extract_all(text, '{pattern}', {group})) AS v, unnest(string_split_regex(text, '{pattern}')[1:len({found})]) AS gap FROM d"
    return f"SELECT doc_id, {kind} AS kind, '{name}' AS name, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS stop, length(m) AS n, {keep} AS ok FROM ({rows})"


SECRETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({_spans(0, "assign", r'''(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', "length(v) >= 6", 1)}
UNION ALL {_spans(1, "access", "AKIA[A-Z0-9]+", "length(m) >= 20")}
UNION ALL {_spans(2, "hex", "[0-9a-f]+", "length(m) >= 24")}),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS c,
  string_agg(name || ':' || CAST(stop - n AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY stop - n, kind) AS listed FROM s WHERE ok GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN g USING (doc_id)
"""


def base_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.op7_lm_scoring(spark, sf_dir)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


#: crc32 bit by bit over the digits of an id.
_CRC = "xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)), lambda a, b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b)), CAST(4294967295 AS BIGINT)))"
LM_SCORES = f"""
WITH t AS (SELECT doc_id, coalesce({_CRC} % 10 = 0, false) AS held_out, list_concat({_WORDS}, [' ']) AS w FROM documents),
u AS (SELECT doc_id, held_out, unnest(w) AS w FROM t),
c AS (SELECT w, count(*) AS c FROM u WHERE NOT held_out GROUP BY w),
a AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(any_value(a.n) AS BIGINT) AS train_tokens,
round(sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (a.n + 0.1::DOUBLE * (a.v + 1)))), 4) AS base_score
FROM u LEFT JOIN c USING (w) CROSS JOIN a GROUP BY doc_id, held_out
"""

QUERIES = {"base_mix_targets": base_mix_targets, "base_license_phrases": base_license_phrases, "base_secrets": base_secrets, "base_lm_scores": base_lm_scores}
SQL = {"op5_jaccard_join": JACCARD, "base_mix_targets": MIX_TARGETS, "base_license_phrases": LICENSE_PHRASES, "base_secrets": SECRETS, "base_lm_scores": LM_SCORES}
