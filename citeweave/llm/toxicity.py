"""Toxicity scores by a convolutional text classifier in numpy.

A word is the sum of three hashed embeddings: the word, its first four bytes, and its last four.  Filters of several widths
slide over the words, each filter's maximum over the whole text is kept, and a logistic layer turns maxima into a score.
One dimension of each embedding starts as the log-odds of its bucket in the sample, the rest at random; then all are
trained with Adam.  Only the window that holds a filter's maximum gets a gradient, which keeps training cheap.

``thresholds`` are calibrated by language on all labelled training documents that fitting did not see, from counts of scores, each
label weighted to its share in the language: the cut with the best F1, or the common one where a language has under 20 of a label there.  The score itself knows no language.

The fit is on whole texts of a sample with two bounds, ``per_class`` documents of each label and ``fit_words`` words in all, 12 bytes each, which
alone reach the driver.

Cases.  A null or empty text has maxima of zero and a score.  A very long text is scored by overlapping parts; for the fit a text that would exceed ``fit_words`` is passed over,
and counts for the thresholds as others outside the fit do.  Of cuts with equally good F1 the highest is taken.  If the sample lacks one of the labels, all scores are the other's: 0
without toxic documents.  Repeated rows and null ids are scored each.  An empty table gives an empty result.  Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import wordhash
from citeweave.llm.common import bounded, documents, saved
from citeweave.llm.labelled import held_out, labelled_sample, near_labels, training_labels

BUCKETS = 1 << 14
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
_U64 = np.uint64


def word_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three buckets for each word (letters and digits), in tables of their own, and the offset of each document's first word."""
    found, places = [], []
    for at, window, starts, ends in wordhash.word_spans(raw, offsets, alnum=True):
        near = np.minimum(ends - starts, 4)
        cut = ((starts, ends), (starts, starts + near), (ends - near, ends))
        found.append(np.stack([(wordhash.hash_spans(window, a, b) % _U64(BUCKETS)).astype(np.int32) + k * BUCKETS for k, (a, b) in enumerate(cut)], 1))
        places.append(starts + at)
    if not found:
        return np.zeros((0, 3), np.int32), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(places), offsets)


@dataclass
class Network:
    embed: np.ndarray  # [3 * BUCKETS, DIM]
    filters: list  # of each width, [width * DIM, FILTERS]
    bias: np.ndarray  # [widths, FILTERS]
    out: np.ndarray  # [widths * FILTERS]
    base: float

    def pooled(self, buckets: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter in each document, 0 if none is above, and the word at which its window begins."""
        n = len(firsts) - 1
        top = np.zeros((n, len(WIDTHS), FILTERS), np.float32)
        at = np.full((n, len(WIDTHS), FILTERS), -1, np.int64)
        words = self.embed[buckets[:, 0]] + self.embed[buckets[:, 1]] + self.embed[buckets[:, 2]]
        for k, width in enumerate(WIDTHS):
            m = len(words) - width + 1
            full = np.flatnonzero(np.diff(firsts) >= width)
            if m <= 0 or not len(full):
                continue
            act = words[:m] @ self.filters[k][:DIM]
            for j in range(1, width):
                act += words[j : j + m] @ self.filters[k][j * DIM : (j + 1) * DIM]
            act += self.bias[k]
            # Windows of a document are a run; the pairs of bounds leave out those that cross into the next.
            bounds = np.column_stack([firsts[full], firsts[full + 1] - width + 1]).ravel()
            best = np.maximum.reduceat(np.vstack([act, np.full((1, FILTERS), -np.inf, np.float32)]), bounds, axis=0)[::2]
            top[full, k] = np.maximum(best, 0)
            if n == 1:
                where = act.argmax(0)
                at[0, k] = np.where(best[0] > 0, where, -1)
        return top, at

    def score(self, buckets: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        out = np.empty(len(firsts) - 1)
        step = 1 << 16  # words at a time, one document at least
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(firsts, firsts[i] + step, side="right")) - 1)
            top = self._long(buckets[firsts[i] : firsts[j]]) if j == i + 1 else self.pooled(buckets[firsts[i] : firsts[j]], firsts[i : j + 1] - firsts[i])[0]
            out[i:j] = top.reshape(j - i, -1) @ self.out + self.base
            i = j
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))

    def _long(self, buckets: np.ndarray) -> np.ndarray:
        """One document's maxima, by parts that overlap by a window."""
        step, top = 1 << 16, np.zeros((1, len(WIDTHS), FILTERS), np.float32)
        for at in range(0, max(1, len(buckets)), step):
            part = buckets[at : at + step + max(WIDTHS) - 1]
            top = np.maximum(top, self.pooled(part, np.array([0, len(part)]))[0])
        return top


class _Adam:
    def __init__(self, shape, rate):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, value, gradient, rows=...):
        self.t += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * gradient
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * gradient**2
        value[rows] -= self.rate * (self.m[rows] / (1 - 0.9**self.t)) / (np.sqrt(self.v[rows] / (1 - 0.99**self.t)) + 1e-6)


def fit(docs: list[np.ndarray], label: np.ndarray, prior: float, epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 11) -> Network:
    """``docs``: buckets of the words of each; ``prior``: share of label 1 among all labels, to which scores are shifted."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.05, (3 * BUCKETS, DIM)).astype(np.float32), [rng.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros((len(WIDTHS), FILTERS), np.float32), rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)
    pos, neg = int((label == 1).sum()), int((label == 0).sum())
    if not pos or not neg:
        net.out[:] = 0
        net.base = 30.0 if pos else -30.0
        return net
    seen = np.zeros((2, 3 * BUCKETS))
    for words, y in zip(docs, label, strict=True):
        seen[y, np.unique(words)] += 1
    odds = np.log((seen[1] + 0.5) / (pos + 1)) - np.log((seen[0] + 0.5) / (neg + 1))
    net.embed[:, 0] = np.where(seen.sum(0) >= 3, np.clip(odds, -3, 3), 0) / 3
    for k, w in enumerate(WIDTHS):
        net.filters[k][np.arange(w) * DIM, : FILTERS // 2] = 0.7
        net.bias[k, : FILTERS // 2] = -0.5
        net.out.reshape(len(WIDTHS), FILTERS)[k, : FILTERS // 2] = 0.5
    adam = {"embed": _Adam(net.embed.shape, rate), "bias": _Adam(net.bias.shape, rate), "out": _Adam(net.out.shape, rate), "base": _Adam((1,), rate)}
    adam |= {k: _Adam(f.shape, rate) for k, f in enumerate(net.filters)}
    base = np.zeros(1, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for begin in range(0, len(order), batch):
            some = order[begin : begin + batch]
            tops, ats = zip(*(net.pooled(docs[i], np.array([0, len(docs[i])])) for i in some), strict=True)
            top, at = np.concatenate(tops), np.concatenate(ats)
            flat = top.reshape(len(some), -1)
            p = 1.0 / (1.0 + np.exp(-np.clip(flat @ net.out + base[0], -30, 30)))
            g = ((p - label[some]) / len(some)).astype(np.float32)
            back = (g[:, None] * net.out).reshape(top.shape) * (at >= 0)
            rows, changes = [], []
            for k, width in enumerate(WIDTHS):
                d, f = np.nonzero(at[:, k] >= 0)
                if not len(d):
                    continue
                value = back[d, k, f]
                place = at[d, k, f]
                gf = np.zeros_like(net.filters[k])
                for j in range(width):
                    b = np.stack([docs[some[i]][q + j] for i, q in zip(d, place, strict=True)])
                    gw = value[:, None] * net.filters[k][j * DIM : (j + 1) * DIM, f].T
                    x = net.embed[b].sum(1)
                    np.add.at(gf[j * DIM : (j + 1) * DIM].T, f, value[:, None] * x)
                    rows.append(b.ravel())
                    changes.append(np.repeat(gw, 3, 0))
                gb = np.zeros(FILTERS, np.float32)
                np.add.at(gb, f, value)
                adam[k].step(net.filters[k], gf)
                adam["bias"].step(net.bias, gb, k)
            if rows:
                unique, inverse = np.unique(np.concatenate(rows), return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, inverse, np.concatenate(changes))
                adam["embed"].step(net.embed, total, unique)
            adam["out"].step(net.out, flat.T @ g + 1e-4 * net.out)
            adam["base"].step(base, g.sum(keepdims=True))
    # The sample has the labels in other shares than the table.
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    net.base = float(base[0] + np.log(prior / (1 - prior)) - np.log(pos / neg))
    return net


@dataclass(frozen=True)
class Model:
    network: Network
    thresholds: dict  # language to cut; None: common


def best_cut(score: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The cut with the best F1 of rows that count ``weight`` each; halfway to the next lower score."""
    weight = np.ones(len(score)) if weight is None else weight
    order = np.lexsort((label, -score))
    hit, all_, low = np.cumsum((weight * label)[order]), np.cumsum(weight[order]), score[order]
    last = np.append(low[1:] != low[:-1], True)  # rows of one score go over the cut together
    k = int(np.where(last, 2 * hit / (all_ + max(hit[-1], 1e-9)), -1).argmax())
    return float((low[k] + (low[k + 1] if k + 1 < len(low) else 0.0)) / 2)


#: Scores are counted by steps of so much in the log-odds.
_STEP = 1 / 64


def calibrated(scored: DataFrame, known: DataFrame, fitted: list[int], common: float = 0.3, least: int = 20) -> dict:
    """Cuts by language from ``scored`` (doc_id, lang, score) and ``known`` (doc_id, label), but for ids in ``fitted``, which count only for shares."""
    spark = scored.sparkSession
    used = spark.createDataFrame([(int(i), True) for i in fitted], "doc_id long, used boolean")
    rows = scored.join(known, "doc_id").dropDuplicates(["doc_id"]).join(F.broadcast(used), "doc_id", "left")
    grade = F.when(F.col("used").isNull(), F.floor(F.log(F.col("score") / (1 - F.col("score"))) / _STEP))
    table = rows.groupBy("lang", "label", grade.alias("g")).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("score")).toPandas()

    def cut(part) -> tuple[int, float]:
        free = part[part["g"].notna()]
        number = [int(free["n"][free["label"] == k].sum()) for k in (0, 1)]
        if not min(number):
            return 0, common
        weight = free["n"].to_numpy(float)
        for k in (0, 1):
            weight[free["label"] == k] *= part["n"][part["label"] == k].sum() / number[k]
        middle = 1 / (1 + np.exp(-(free["g"].to_numpy(float) + 0.5) * _STEP))
        return min(number), best_cut(middle, free["label"].to_numpy(int), weight)

    cuts = {None: cut(table)[1]}
    for name, part in table.groupby("lang"):
        number, value = cut(part)
        if number >= least:
            cuts[name] = value
    return cuts


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, raw, offsets in wordhash.text_slices(batch):
            own = batch.slice(begin, end - begin)
            buckets, firsts = word_buckets(raw, offsets)
            rows = [buckets[firsts[i] : firsts[i + 1]] for i in range(end - begin)]
            yield pa.RecordBatch.from_arrays([*map(own.column, ("doc_id", "label", "lang")), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "label", "lang", "words"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, calibrate: float = 0.25, fit_words: int = 4_000_000) -> Model:
    """Fits on up to ``per_class`` documents of each label and ``fit_words`` words; of these documents, the part ``calibrate`` sets thresholds only, as all other labelled ones do."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    sample = labelled_sample(bounded(docs).select("doc_id", "text", lang), labels, "toxic", per_class, ("lang",))
    sample = sample.mapInArrow(_bucket_rows, "doc_id long, label int, lang string, words binary").dropDuplicates(["doc_id"])
    sample = saved(sample, "toxic-sample")
    order = sample.select("doc_id", (F.octet_length("words") / 12).cast("long").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # 2 * per_class at most
    chosen, left = [], fit_words
    for r in order[int(len(order) * calibrate) :]:
        if r["n"] <= left:
            chosen.append((r["doc_id"],))
            left -= r["n"]
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long")
    rows = sample.join(F.broadcast(picked), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "label", "words").toPandas()
    known = training_labels(labels, "toxic")
    share = known.agg(F.avg("label")).first()[0]
    words = [np.frombuffer(w, np.int32).reshape(-1, 3) for w in rows["words"]]
    network = fit(words, rows["label"].to_numpy(int), float(share or 0.0))
    asked = near_labels(docs.select("doc_id", "text", lang), known)
    scored = score(asked, Model(network, {None: 0.3})).select("doc_id", "lang", "score")
    return Model(network, calibrated(scored, known, rows["doc_id"].tolist()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row of ``docs``; with a column lang also toxic, by the language's threshold."""
    network = docs.sparkSession.sparkContext.broadcast(model.network)
    with_lang = "lang" in docs.columns
    base = bounded(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *(["lang"] if with_lang else []))
    kept = ["doc_id", *(["lang"] if with_lang else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                own = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in kept), pa.array(network.value.score(*word_buckets(raw, offsets)))], [*kept, "score"])

    scored = base.mapInArrow(run, "doc_id long, " + "lang string, " * with_lang + "score double")
    if not with_lang:
        return scored
    cut = F.lit(model.thresholds[None])
    for name, value in model.thresholds.items():
        cut = F.when(F.col("lang") == name, F.lit(value)).otherwise(cut) if name is not None else cut
    return scored.withColumn("toxic", F.col("score") >= cut)


def op9_toxicity(spark: SparkSession, sf_dir: str, cut: float = 0.3) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), F.col("toxic").alias("over_language_threshold"))
