"""Licence scans by a positional index of rare words.

A file's licence words are kept with their positions.  How rare each is comes from all files (IDF).  Of a template's
mandatory words the one with the highest IDF is its anchor, and the index is looked up by anchors alone: a file that holds the template
holds that word, and it is the rarest mandatory one the two share, so none is missed while frequent words cost nothing.
A look-up gives an alignment: file position less template position.  At that alignment the
template's other words are intersected with the file's by relative position.  An alignment holds if enough of the template's IDF stands there and
every word of a mandatory key phrase does.  Base phrases are read from the same postings: their words at consecutive positions.

All of it is joins and aggregates over postings of licence words; texts are read once and never shuffled.  The template
table is a parameter; its index is broadcast, with up to ``MOST_POSTINGS`` rows.  DataFrame functions only.

Cases.  A null or empty text has no words, no labels and score 0.  A very long text is split into its words in one row; what is kept of it are its licence
words, whose postings are rows.  Words of one IDF: the anchor is the first of them in the template.  Repeated rows and null ids get a result each.  An empty
table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.common import documents, is_small, saved, with_uid
from citeweave.llm.license_texts import LICENCES

#: As the contract has them, with A-Z beside a-z: words of a text that is yet to be lower-cased.
LICENCE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
MOST_POSTINGS = 1_000_000
#: Words too common to tell licences apart are not indexed, unless a key phrase has them; nor are those of under four letters.
COMMON = frozenset("that this with from have been were will shall must also such into than then they their there these those which when where what other more some only each both your under upon above below following".split())


def _template_index(templates=LICENCES) -> list[tuple[int, str, str, int, bool]]:
    """(template, label, word, position, whether mandatory) of every indexed word of (label, text, key phrase)."""
    out = []
    for t, (label, text, key) in enumerate(templates):
        words, must = words_of(text), words_of(key)
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        inside = range(at, at + len(must))
        out += [(t, label, w, i, i in inside) for i, w in enumerate(words) if i in inside or (len(w) > 3 and w not in COMMON)]
    return out


def words_of(text: str) -> list[str]:
    return re.findall(LICENCE_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _vocabulary(postings: list[tuple]) -> list[str]:
    return sorted({p[2] for p in postings} | {w for phrase in BASE for w in phrase.split()})


def licence_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, n_words, hits array<struct<pos, word>> of the words in ``vocabulary`` in order."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LICENCE_WORD), F.lit(0))
    # Only ASCII words can be licence words, and for those lower() changes A-Z alone.
    asked = lambda w: (F.octet_length(w) == F.length(w)) & F.lower(w).isin(vocabulary)
    rows = with_uid(docs.select("doc_id", words.alias("words")))
    hits = F.filter(F.transform("words", lambda w, i: F.when(asked(w), F.struct(i.alias("pos"), F.lower(w).alias("word")))), lambda h: h.isNotNull())
    return rows.select("uid", "doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def _places(hits: Column, phrase: str, label: str) -> Column:
    """array<struct<start, stop, label>> where the phrase's words stand at consecutive positions."""
    words = phrase.split()

    def stands(h: Column, i: Column) -> Column:
        found = h["word"] == words[0]
        for k, word in enumerate(words[1:], 1):
            nxt = F.get(hits, i + k)
            found = found & F.coalesce((nxt["word"] == word) & (nxt["pos"] == h["pos"] + k), F.lit(False))
        return found

    return F.transform(F.filter(hits, stands), lambda h: F.struct(h["pos"].alias("start"), F.lit(label).alias("label")))


def scan(docs: DataFrame, templates=LICENCES, coverage: float = 0.6) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, n_words, places (base phrases), found array<struct<label, start, score>>.

    ``templates``: (label, text, key phrase within it) each.  ``coverage``: the part of a template's IDF that must stand at an alignment.
    """
    spark = docs.sparkSession
    postings = _template_index(templates)
    if len(postings) > MOST_POSTINGS:
        raise ValueError(f"the templates have more than {MOST_POSTINGS} indexed words")
    rows = saved(licence_words(docs, _vocabulary(postings)), "licence-words")
    table = spark.createDataFrame(postings, "template int, label string, word string, tpos int, must boolean")
    total = rows.count()
    # One row for each licence word at most.
    df = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.lit(float(total)) + 1.0) / (F.coalesce("df", F.lit(0)) + 0.5)) + 0.1
    by_template = Window.partitionBy("template")
    index = (
        table.join(F.broadcast(df), "word", "left")
        .withColumn("idf", F.greatest(idf, F.lit(0.1)))
        .withColumn("is_anchor", F.row_number().over(by_template.orderBy(F.desc("must"), F.desc("idf"), "tpos")) == 1)
        .withColumn("mass", F.sum("idf").over(by_template))
        .withColumn("n_must", F.count_if("must").over(by_template))
    )
    index = saved(index.drop("df").coalesce(1), "licence-index")

    hits = rows.select("uid", F.explode("hits").alias("h")).select("uid", F.col("h.pos").alias("pos"), F.col("h.word").alias("word"))
    anchors = index.filter("is_anchor").select("word", "template", F.col("tpos").alias("apos"))
    asked = saved(hits.join(F.broadcast(anchors), "word").select("uid", "template", (F.col("pos") - F.col("apos")).alias("start")), "licence-alignments")
    wanted = asked.join(F.broadcast(index), "template").select("uid", (F.col("start") + F.col("tpos")).alias("pos"), "word", "template", "label", "start", "must", "idf", "mass", "n_must")
    files = asked.select("uid").distinct()
    near = hits.join(F.broadcast(files) if is_small(files) else files, "uid", "left_semi")
    aligned = wanted.join(near, ["uid", "pos", "word"]).groupBy("uid", "template", "label", "start").agg(
        F.count_if("must").alias("musts"), F.sum("idf").alias("stands"), F.first("mass").alias("mass"), F.first("n_must").alias("n_must")
    )
    good = aligned.filter((F.col("musts") == F.col("n_must")) & (F.col("stands") >= coverage * F.col("mass") - 1e-9))
    found = good.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("label", "start", F.round(F.col("stands") / F.col("mass"), 6).alias("score")))).alias("found"))
    places = F.array_sort(F.concat(*[_places(F.col("hits"), p, label) for p, label in BASE.items()]))
    nothing = F.array().cast("array<struct<label:string,start:int,score:double>>")
    return rows.join(found, "uid", "left").select("uid", "doc_id", "n_words", places.alias("places"), F.coalesce("found", nothing).alias("found"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    labels = F.array_union(base, F.transform("found", lambda f: f["label"]))
    best = F.array_max(F.transform("found", lambda f: f["score"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).cast("double").alias("score"),
    )
