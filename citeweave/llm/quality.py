"""Quality scores from pairwise preferences (Bradley-Terry).

A document of label 1 is preferred to one of label 0.  The model gives each document a strength, linear in features of
its whole text, and a preference the probability sigmoid(strength - strength'); the weights minimise the logistic
loss of feature differences over pairs of a bounded sample of labelled documents.  The threshold is a quantile of the strengths of
all labelled training documents: the one that leaves the share of label 0 below it.  A score is the sigmoid of the scaled distance to
that quantile, shifted so that the quantile is at ``cut``.

Features come from the text alone: frequencies of character classes, lengths, and how often words and shingles repeat.

Cases.  A null or empty text has features of its own, all zero counts, and a score.  A very long text is counted by windows of its bytes.  Documents whose strength is the
quantile itself score ``cut`` and are accepted, all of them.  If the sample has no document of one label, all
strengths are equal and all scores are ``cut``.  Repeated rows and null ids are scored each.  An empty table gives an
empty result.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import wordhash
from citeweave.llm.common import bounded, documents, saved
from citeweave.llm.labelled import held_out, labelled_sample, near_labels, training_labels

#: Class of each byte: every ASCII punctuation mark for itself; lower, upper, digit, space, line end, other control, beyond ASCII.
_CLASS = np.zeros(256, np.int64)
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 0, 1, 2, 3, 4, 6
_CLASS[[b for b in [*range(32), 127] if b != 10]] = 5
_CLASS[_MARKS] = 7 + np.arange(len(_MARKS))
N_CLASSES = 7 + len(_MARKS)
N_FEATURES = N_CLASSES + 9


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``N_FEATURES`` for each document."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    counts = np.zeros((n, N_CLASSES))
    step = 1 << 18  # bytes at a time
    for at in range(0, len(raw), step):
        part = raw[at : at + step]
        doc = np.searchsorted(offsets, np.arange(at, at + len(part)), side="right") - 1
        lo, hi = doc[0], doc[-1] + 1
        counts[lo:hi] += np.bincount((doc - lo) * N_CLASSES + _CLASS[part], minlength=(hi - lo) * N_CLASSES).reshape(-1, N_CLASSES)
    words, firsts = wordhash.word_hashes(raw, offsets)
    made, to = wordhash.shingles(words, firsts)
    n_words = np.diff(firsts)
    again = np.zeros(len(words) + 1)
    np.cumsum(words[1:] == words[:-1], out=again[2:]) if len(words) > 1 else None
    lo = np.minimum(firsts[:-1] + 1, firsts[1:])
    adjacent = again[firsts[1:]] - again[lo]
    distinct = np.array([len(np.unique(words[firsts[i] : firsts[i + 1]])) for i in range(n)])
    shingle = np.array([len(np.unique(made[to[i] : to[i + 1]])) for i in range(n)])
    per = np.maximum(n_words, 1)
    out = np.empty((n, N_FEATURES))
    out[:, :N_CLASSES] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    rest = (np.log1p(n_words), np.log1p(sizes), sizes / per / 10.0, adjacent / per, distinct / per, np.log1p(distinct), shingle / np.maximum(np.diff(to), 1), counts[:, 7:].sum(1) / per, n_words == 0)
    for k, column in enumerate(rest):
        out[:, N_CLASSES + k] = column
    return out


@dataclass(frozen=True)
class Ranking:
    """Strength = features @ weights + offset; score = sigmoid(scale * (strength - quantile) + logit(cut))."""

    weights: np.ndarray
    quantile: float
    scale: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.scale * (x @ self.weights - self.quantile) + np.log(self.cut / (1 - self.cut))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def fit(x: np.ndarray, label: np.ndarray, share_bad: float, cut: float = 0.7, pairs: int = 60_000, penalty: float = 1e-3, steps: int = 25, seed: int = 5) -> Ranking:
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(x.shape[1]), 0.0, 1.0, cut)
    spread = x.std(0)
    spread[spread < 1e-9] = np.inf
    z = x / spread
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton's method on mean log(1 + exp(-d.w)) + penalty / 2 |w|^2
        p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(d * p[:, None]).mean(0) + penalty * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    s = z @ w
    # Until it is calibrated, the quantile is the sample's, where each label's part stands for its share of all labels.
    order = np.argsort(s, kind="stable")
    mass = np.cumsum(np.where(label == 1, (1 - share_bad) / len(good), share_bad / len(bad))[order])
    k = min(int(np.searchsorted(mass, share_bad)), len(s) - 2)
    quantile = float(s[order[k : k + 2]].mean())
    return Ranking(w / spread, quantile, float(2.0 / max(s.std(), 1e-9)), cut)


def calibrated(docs: DataFrame, known: DataFrame, model: Ranking, share_bad: float, accuracy: int = 10_000) -> Ranking:
    """``model`` with the quantile of the strengths of all documents in ``known`` (doc_id, label), by a mergeable summary of ``accuracy``."""
    asked = near_labels(docs.select("doc_id", "text"), known)
    rows = saved(strengths(asked, model).join(known.select("doc_id"), "doc_id", "left_semi"), "strengths")
    # Halfway between the two strengths that the share parts; equal ones stay together.
    low = rows.agg(F.percentile_approx("strength", share_bad, accuracy)).first()[0]
    if low is None:
        return model
    high = rows.filter(F.col("strength") > low).agg(F.min("strength")).first()[0]
    return replace(model, quantile=low if high is None else (low + high) / 2)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, raw, offsets in wordhash.text_slices(batch):
            own = batch.slice(begin, end - begin)
            x = features(raw, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("label"), lists], ["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, cut: float = 0.7) -> Ranking:
    """Fits on up to ``per_class`` documents of each label; the share of label 0 and the quantile are those of all labelled training documents."""
    sample = labelled_sample(bounded(docs), labels, "quality", per_class).mapInArrow(_feature_rows, "doc_id long, label int, x array<double>")
    rows = sample.dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    known = training_labels(labels, "quality")
    share = float(known.agg(F.avg(1.0 - F.col("label"))).first()[0] or 0.0)
    x = np.array(rows["x"].tolist(), float).reshape(-1, N_FEATURES)
    model = fit(x, rows["label"].to_numpy(int), share, cut)
    return calibrated(docs, known, model, share) if rows["label"].nunique() == 2 else model


def strengths(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, strength of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), pa.array(features(raw, offsets) @ model.weights)], ["doc_id", "strength"])

    return bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, strength double")


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, score of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), pa.array(model.score(features(raw, offsets)))], ["doc_id", "score"])

    return bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows of ``docs`` with a score of ``model.cut`` or more, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                yield batch.slice(begin, end - begin).filter(pa.array(model.score(features(raw, offsets)) >= model.cut))

    return bounded(docs).mapInArrow(run, docs.schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))
