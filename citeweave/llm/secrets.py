"""Secret scans with multipart credential linking.

Strong spans stand alone: assignments to a secret's name, access identifiers, long runs of hex digits.  Weak spans
say little by themselves: service endpoints, and 40-character keys.  Linking joins spans by interval: within a scope
(``reach`` code points between one span's end and the next one's start, inside one document) a weak candidate is reported if complementary parts
co-occur.  A key needs an access identifier in its scope.  An endpoint needs an access identifier, and a key, an
assignment or a run of hex digits, both in its scope.

Each kind is found by regular expressions over the whole text; a span's end is the running sum of the gaps and matches up to it.  The interval
join runs over span rows, not texts.  For each weak span only the nearest part of each kind to either side decides, so running maxima
and minima over position, forwards and backwards, stand in for pairs: work grows with the spans, not their square.  DataFrame functions only.

Cases.  A null or empty text has no spans; its digest is that of the empty string.  A very long text is one row of the scan with all its matches, and its spans are
sorted as rows, which may spill.  Spans with the same start are in the order of ``KINDS``; a kind has one span at a start.  Repeated rows get a result each, null ids
too.  Positions are code points, ends exclusive.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.common import documents, saved, with_uid

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Maximal runs of at least so many characters are what is left when shorter runs are dropped.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?|(?<![A-Za-z0-9.-])[a-z0-9-]+\.(?:amazonaws\.com|blob\.core\.windows\.net|googleapis\.com)"
#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "key", "endpoint")


_PIECES = "array<struct<kind:int,k:int,gap:int,len:int,ok:boolean>>"


def pieces_of(text: Column, pattern: str, kind: int, value_group: int | None = None, least: int = 0) -> Column:
    """The leftmost matches that do not overlap, in order, each as kind, number, gap before it, length, and whether it counts.

    With ``value_group``, a match whose group is shorter than ``least`` does not count, yet it takes its place.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if value_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    both = F.zip_with(found, values, lambda m, v: F.struct(F.length(m).alias("len"), (F.length(v) >= least).alias("ok")))
    pieces = F.zip_with(F.transform(both, lambda x, i: F.struct(i.alias("k"), x["len"].alias("len"), x["ok"].alias("ok"))), F.slice(gaps, 1, F.size(both)), lambda x, g: F.struct(F.lit(kind).alias("kind"), x["k"].alias("k"), F.length(g).alias("gap"), x["len"].alias("len"), x["ok"].alias("ok")))
    return F.when(F.regexp_like(text, F.lit(pattern)), pieces).otherwise(F.array().cast(_PIECES))


def scan(docs: DataFrame, reach: int = 200) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, spans array<struct<start, kind, stop>> by start, then kind: all base and all linked spans."""
    found = with_uid(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    text = F.col("text")
    pieces = F.concat(pieces_of(text, ASSIGN, 0, 1, 6), pieces_of(text, ACCESS, 1), pieces_of(text, HEX, 2), pieces_of(text, KEY, 3), pieces_of(text, ENDPOINT, 4))
    found = saved(found.select("uid", "doc_id", pieces.alias("pieces")), "secret-spans")

    rows = found.select("uid", F.inline("pieces"))
    stop = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("uid", "kind").orderBy("k")).cast("int")
    rows = rows.withColumn("stop", stop).filter("ok").select("uid", (F.col("stop") - F.col("len")).alias("start"), "kind", "stop")
    # A frame that grows with each row is updated; one that shrinks would be computed anew for each.
    before = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(is_part: Column) -> Column:
        left = F.max(F.when(is_part, F.col("stop"))).over(before)
        right = F.min(F.when(is_part, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - left <= reach, F.lit(False)) | F.coalesce(right - F.col("stop") <= reach, F.lit(False))

    kind = F.col("kind")
    seen = rows.select("*", near(kind == 1).alias("by_access"), near(kind.isin(0, 2, 3)).alias("by_secret"))
    kept = seen.filter((kind < 3) | ((kind == 3) & F.col("by_access")) | ((kind == 4) & F.col("by_access") & F.col("by_secret")))
    spans = kept.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("spans"))
    nothing = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    return found.select("uid", "doc_id").join(spans, "uid", "left").select("uid", "doc_id", F.coalesce("spans", nothing).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["kind"] < 3))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
