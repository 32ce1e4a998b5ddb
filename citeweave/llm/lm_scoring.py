"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

Counts.  Every token of every training document is counted, exactly, by partial counts and a shuffle.  The most frequent
tokens (``known`` at most, a bound on what is broadcast) are looked up while texts are scanned; the other tokens of each document are
joined with the counts by key.

Model.  The most frequent tokens are dealt into classes, every other token belongs to a
tail class by its last two bytes.  P(token | history) = P(class | history) * P(token | class, history).  Both factors
are softmaxes whose scores sum weights of hashed features: a bias, the previous token, the one before it (a skip feature), and, in
P(class | history) alone, both as a bigram.  Inside a tail class tokens have their smoothed share of the class's counts.  So the model's
probabilities sum to one just as the base's do.

Size.  The vocabulary grows as the square root of the training tokens, 1,024 words up to 2^24 of these and twice as many for each factor of four, and so do
classes, words a class, and rows of weights: see ``shape_for``.  It ends at 8,192 words and 59 MB of weights, a bound on the memory of the driver
and of executors, to which weights are broadcast.

Training.  Weights start from counts of feature and outcome over all training tokens.  Then gradient updates: executors sum
expected counts over every place of every training text, the sums are added up, and the weights take a step along observed less
expected counts, scaled by both.  What is expected at a place depends on its two history symbols (and the class) alone, so
places are counted by these once, over all texts, and each round works on the distinct ones, weighted.  Scores are computed in numpy batches.

Tokens are 64-bit hashes of words, see ``wordhash``; texts are read twice, afterwards two bytes a token.

Cases.  A null or empty text has one token, the end.  A very long text is encoded by windows and scored by pieces, with its history across them.  Equally frequent
tokens are ordered by hash.  Null ids train and are not held out.  Repeated rows count, and are scored, each.  Without training
documents all counts are 0 and the base score is 0.  An empty table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import wordhash
from citeweave.llm.common import bounded, documents, forget, saved, training_row, with_uid

_U64 = np.uint64
END = int(wordhash.mix(np.array([7], _U64))[0].view(np.int64))
TAILS = 32
#: Training tokens up to which the vocabulary has its least size; most doublings of it.
LEAST_TOKENS, MOST_GROWTH = 1 << 24, 3
SMOOTH = 0.1
_LOG10E = float(np.log10(np.e))


@dataclass(frozen=True)
class Shape:
    """``heads`` classes of ``wide`` frequent words each, and 2^``bits`` rows of weights for either factor."""

    heads: int
    wide: int
    bits: int

    @property
    def head(self) -> int:
        return self.heads * self.wide

    @property
    def classes(self) -> int:
        return self.heads + TAILS

    @property
    def start(self) -> int:
        """The symbol before a text; below it are those of the frequent words, then of the tail classes."""
        return self.head + TAILS

    @property
    def with_class(self) -> int:
        """A context is a pair of history symbols; from this number on, a pair and a head class."""
        return (self.start + 1) ** 2

    def empty(self, kind=np.float32) -> list[np.ndarray]:
        """Tables of feature and outcome: of classes, and of words within a class."""
        return [np.zeros((1 << self.bits, self.classes), kind), np.zeros((1 << self.bits, self.wide), kind)]


def shape_for(n: int) -> Shape:
    """The shape for ``n`` training tokens."""
    k = min(MOST_GROWTH, max(0, math.ceil(math.log2(max(n, 1) / LEAST_TOKENS) / 2)))
    return Shape(32 << (k + 1) // 2, 32 << k // 2, 15 + k // 2)


def tokens_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, offsets): the words of each document and its end token; a token's low bits are its tail class."""
    n = len(offsets) - 1
    hashes, places = [np.zeros(0, _U64)], [np.zeros(0, np.int64)]
    for at, window, starts, ends in wordhash.word_spans(raw, offsets):
        suffix = wordhash.hash_spans(window, np.maximum(starts, ends - 2), ends)
        hashes.append((wordhash.hash_spans(window, starts, ends) & ~_U64(TAILS - 1)) | (suffix & _U64(TAILS - 1)))
        places.append(starts + at)
    firsts = np.searchsorted(np.concatenate(places), offsets)
    to = firsts + np.arange(n + 1)
    token = np.full(int(to[-1]), END, np.int64)
    word = np.ones(len(token), bool)
    word[to[1:] - 1] = False
    token[word] = np.concatenate(hashes).view(np.int64)
    return token, to


def tail_of(token: np.ndarray) -> np.ndarray:
    return (token & (TAILS - 1)).astype(np.uint32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> pa.RecordBatch:
        unique, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(unique), pa.array(count)], ["h", "c"])

    held, n = [], 0
    for batch in batches:
        for _, _, raw, offsets in wordhash.text_slices(batch):
            held.append(tokens_of(raw, offsets)[0])
            n += len(held[-1])
            if n >= 1 << 21:
                yield counted()
                held, n = [], 0
    if held:
        yield counted()


@dataclass
class Vocabulary:
    tokens: np.ndarray  # sorted
    counts: np.ndarray
    symbols: np.ndarray  # below shape.head: number of a head token; else shape.head + tail class
    n: int
    v: int
    tail_mass: np.ndarray  # of each tail class: counts + SMOOTH * (distinct + 1)
    shape: Shape


def vocabulary(counts: DataFrame, known: int) -> Vocabulary:
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # By eighths of a power of two: at most 512 rows; the cut leaves up to ``known`` tokens, and all beyond the head are optional.
    grade = F.floor(F.log2("c") * 8).cast("int")
    grades, taken, least = counts.groupBy(grade.alias("g")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("g")).collect(), 0, 1 << 30
    for row in grades:
        if taken + row["n"] > known:
            break
        taken, least = taken + row["n"], row["g"]
    top = counts.filter(grade >= least).select("h", "c").toArrow()
    h, c = (top.column(k).to_numpy() for k in ("h", "c"))
    tail, shape = tail_of(h), shape_for(int(n))
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((h, -c))] = np.arange(len(h))
    symbol = np.where(rank < shape.head, rank, shape.head + tail).astype(np.uint16)
    mass = np.full(TAILS, SMOOTH)
    for row in counts.groupBy(F.col("h").bitwiseAND(F.lit(TAILS - 1)).alias("tail")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        mass[row["tail"]] += row["c"] + SMOOTH * row["n"]
    head = rank < shape.head
    np.add.at(mass, tail[head], -(c[head] + SMOOTH))
    order = np.argsort(h)
    return Vocabulary(h[order], c[order], symbol[order], int(n), int(v), np.maximum(mass, SMOOTH), shape)


_ROWS = "uid long, doc_id long, trains boolean, n_tokens long, n_known long, base double, tail double, symbols binary, rest array<long>"


def _encode(vocab):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc: Vocabulary = vocab.value
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                token, to = tokens_of(raw, offsets)
                tail = tail_of(token)
                at = np.minimum(np.searchsorted(voc.tokens, token), max(len(voc.tokens) - 1, 0))
                hit = voc.tokens[at] == token if len(voc.tokens) else np.zeros(len(token), bool)
                symbol = (tail + voc.shape.head).astype(np.uint16)
                symbol[hit] = voc.symbols[at[hit]]
                count = np.zeros(len(token))
                count[hit] = voc.counts[at[hit]]
                # Of the rest, log10(count + SMOOTH) is added after the join.
                share = np.where(hit, np.log10(count + SMOOTH), 0.0)
                base = share - np.log10(voc.n + SMOOTH * (voc.v + 1))
                in_tail = np.where(symbol >= voc.shape.head, share - np.log10(voc.tail_mass)[tail], 0.0)
                rest = np.flatnonzero(~hit)
                ends = np.searchsorted(rest, to).astype(np.int32)
                own = batch.slice(begin, end - begin)
                columns = [own.column("uid"), own.column("doc_id"), own.column("trains"), pa.array(np.diff(to)), *(pa.array(np.add.reduceat(x, to[:-1])) for x in (hit.astype(np.int64), base, in_tail))]
                symbols = pa.array([symbol[to[i] : to[i + 1]].tobytes() for i in range(end - begin)], pa.binary())
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(token[rest]))
                yield pa.RecordBatch.from_arrays([*columns, symbols, lists], [c.split()[0] for c in _ROWS.split(", ")])

    return run


def _row_of(kind: int, a: np.ndarray, b, rows: int) -> np.ndarray:
    x = a.astype(_U64) * _U64(0x9E3779B97F4A7C15) + np.asarray(b).astype(_U64) * _U64(0xC2B2AE3D27D4EB4F) + _U64(kind * 0x165667B19E3779F9 % (1 << 64))
    return (wordhash.mix(x) & _U64(rows - 1)).astype(np.int64)


_BIAS = 0


def contexts(symbols: np.ndarray, to: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols one and two before each place, ``start`` before a text."""
    one, two = np.full(len(symbols), start, np.uint16), np.full(len(symbols), start, np.uint16)
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    one[to[:-1]] = start
    two[to[:-1]] = start
    second = to[:-1][np.diff(to) > 1] + 1
    two[second] = start
    return one, two


def class_features(shape: Shape, one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    """Rows of the features at each place; the bias has one row for all."""
    rows = 1 << shape.bits
    one, two = one.astype(_U64), two.astype(_U64)
    return [np.array([_BIAS]), _row_of(1, one, 0, rows), _row_of(2, two, 0, rows), _row_of(3, one, two, rows)]


def word_features(shape: Shape, one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
    rows = 1 << shape.bits
    one, two, cls = one.astype(_U64), two.astype(_U64), cls.astype(_U64)
    return [bias_rows(shape)[cls.astype(np.int64)], _row_of(5, one, cls, rows), _row_of(6, two, cls, rows)]


def bias_rows(shape: Shape) -> np.ndarray:
    """Rows of the classes' own features in the table of words."""
    return _row_of(4, np.zeros(shape.heads), np.arange(shape.heads), 1 << shape.bits)


def split_symbols(shape: Shape, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class, and place within a head class."""
    head = symbols < shape.head
    # Frequent words go to different classes, so that classes differ little in mass.
    return np.where(head, symbols % shape.heads, shape.heads + symbols.astype(np.int64) - shape.head).astype(np.int64), (symbols // shape.heads).astype(np.int64)


@dataclass
class Weights:
    shape: Shape
    classes: np.ndarray  # [2^bits, classes]
    words: np.ndarray  # [2^bits, wide]

    def __post_init__(self):
        # Sums that can't leave the range of exp in 32 bits need no shift.
        self.bounded = max(np.abs(self.classes).max(), np.abs(self.words).max()) * 4 < 80

    def __setstate__(self, state: dict) -> None:
        # An unpickled array has a copy of its type's object, with which numpy takes slow ways.
        self.__dict__.update(state, classes=state["classes"].view(np.float32), words=state["words"].view(np.float32))

    def sums(self, table: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
        z = table[features[1]]
        for f in features[2:]:
            z += table[f]
        z += table[features[0]]
        if not self.bounded:
            z -= z.max(1, keepdims=True)
        return z

    def soft(self, table: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
        z = self.sums(table, features)
        np.exp(z, out=z)
        z /= (z @ np.ones(z.shape[1], np.float32))[:, None]
        return z

    def log(self, table: np.ndarray, features: list[np.ndarray], outcome: np.ndarray) -> np.ndarray:
        z = self.sums(table, features)
        own = z[np.arange(len(z)), outcome].astype(float)
        np.exp(z, out=z)
        return own - np.log(z @ np.ones(z.shape[1], np.float32))


def _parts(batch: pa.RecordBatch, limit: int = 1 << 15) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, symbols, offsets) of runs of rows with up to ``limit`` symbols, one row at least."""
    column = batch.column("symbols")
    sizes = np.array([len(x) // 2 for x in (y.as_buffer() for y in column)], np.int64) if len(column) else np.zeros(0, np.int64)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        flat = np.concatenate([np.frombuffer(column[i].as_buffer(), np.uint16) for i in range(begin, end)])
        yield begin, end, flat, np.concatenate([[0], np.cumsum(sizes[begin:end])])
        begin = end


def _places(n: int) -> Iterator[slice]:
    """All places, by pieces."""
    step = 1 << 12
    for at in range(0, n, step):
        yield slice(at, min(n, at + step))


def _add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """total[rows] += values, with repeated rows; a single row gets all values."""
    if len(rows) == 1:
        total[rows[0]] += values.sum(0)
        return
    order = np.argsort(rows.astype(np.uint32))
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    total[sorted_rows[starts]] += np.add.reduceat(values[order], starts, axis=0)


def _observe(features: list[np.ndarray], outcome: np.ndarray, seen: np.ndarray) -> None:
    flat = seen.reshape(-1)
    for f in features:
        np.add.at(flat, f * seen.shape[1] + outcome, np.float32(1))


_PIECES, PIECE_ROWS = "k int, j int, piece binary", 1 << 11


def _table_pieces(tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for k, table in enumerate(tables):
        for j, piece in enumerate(np.split(table, len(table) // PIECE_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([j], pa.int32()), pa.array([pa.compress(piece.tobytes(), "zstd", asbytes=True)], pa.binary())], ["k", "j", "piece"])


def _observed(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of feature and outcome over a task's documents, as compressed pieces of tables."""
        seen, any_row = shape.empty(), False
        for batch in batches:
            for _, _, symbols, to in _parts(batch, 1 << 18):
                any_row = True
                one, two = contexts(symbols, to, shape.start)
                cls, word = split_symbols(shape, symbols)
                for at in _places(len(symbols)):
                    _observe(class_features(shape, one[at], two[at]), cls[at], seen[0])
                    head = np.flatnonzero(symbols[at] < shape.head) + at.start
                    _observe(word_features(shape, one[head], two[head], cls[head]), word[head], seen[1])
        if any_row:
            yield from _table_pieces(seen)

    return run


def _contexts(shape: Shape):
    """Counts of places by context, added up while up to 2^21 are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> tuple[np.ndarray, np.ndarray]:
            key, count = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            order = np.argsort(key)
            key = key[order]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            return key[starts], np.add.reduceat(count[order], starts)

        held, n = [], 0
        for batch in batches:
            for _, _, symbols, to in _parts(batch, 1 << 18):
                one, two = contexts(symbols, to, shape.start)
                pair = one.astype(np.int64) * (shape.start + 1) + two
                head = symbols < shape.head
                cls = split_symbols(shape, symbols[head])[0]
                held += [np.unique(k, return_counts=True) for k in (pair, pair[head] * shape.heads + cls + shape.with_class)]
                n += sum(len(k) for k, _ in held[-2:])
                if n >= 1 << 21:
                    held = [counted()]
                    n = len(held[0][0])
                    if n >= 1 << 20:
                        yield _context_rows(*held[0])
                        held, n = [], 0
        if held:
            yield _context_rows(*counted())

    return run


def _context_rows(key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(count.astype(np.int64))], ["h", "c"])


def _expect(w: Weights, key: np.ndarray, count: np.ndarray, totals: list[np.ndarray]) -> None:
    """Adds to ``totals`` the expected counts of feature and outcome at all places of these contexts."""
    shape = w.shape
    for k, part in enumerate((key < shape.with_class, key >= shape.with_class)):
        keys, counts = key[part] - k * shape.with_class, count[part].astype(np.float32)
        for at in _places(len(keys)):
            pair = keys[at] // shape.heads if k else keys[at]
            one, two = pair // (shape.start + 1), pair % (shape.start + 1)
            features = word_features(shape, one, two, keys[at] % shape.heads) if k else class_features(shape, one, two)
            p = w.soft(w.words if k else w.classes, features)
            p *= counts[at, None]
            for f in features:
                _add_rows(totals[k], f, p)


def _expected(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Weights = weights.value
        totals, any_row = w.shape.empty(np.float64), False
        for batch in batches:
            any_row = any_row or batch.num_rows > 0
            _expect(w, *(batch.column(k).to_numpy() for k in ("h", "c")), totals)
        if any_row:
            yield from _table_pieces([x.astype(np.float32) for x in totals])

    return run


def _unpacked(piece: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(piece, size, "zstd", asbytes=True), np.float32)


def _summed(parts: DataFrame, shape: Shape, fan: int = 32) -> list[np.ndarray]:
    """The summed tables, added up in a tree: pieces of ``fan`` tasks at a time meet in one group."""
    out = shape.empty()
    size = [x[:PIECE_ROWS].nbytes for x in out]

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        t, k, j = key
        total = np.zeros(size[k] // 4)
        for piece in frame["piece"]:
            total += _unpacked(piece, size[k])
        return pd.DataFrame({"k": [k], "j": [j], "piece": [pa.compress(total.astype(np.float32).tobytes(), "zstd", asbytes=True)], "t": [t]})

    table, groups = parts.withColumn("t", F.spark_partition_id()), parts.rdd.getNumPartitions()
    while True:
        grouped = table.withColumn("t", F.floor(F.col("t") / fan).cast("int")).groupBy("t", "k", "j")
        before, table = table, saved(grouped.applyInPandas(add, "k int, j int, piece binary, t int"), "lm-sums")
        if hasattr(before, "scratch"):
            forget(before)
        groups = math.ceil(groups / fan)
        if groups <= 1:
            break
    for row in table.toLocalIterator():  # one set of tables, of a bounded size
        into = out[row["k"]][row["j"] * PIECE_ROWS : (row["j"] + 1) * PIECE_ROWS]
        into[:] = _unpacked(row["piece"], into.nbytes).reshape(into.shape)
    forget(table)
    return out


def _tasks(n: int, shape: Shape, cores: int, each: int) -> int:
    """Tasks for ``n`` places or contexts: up to one a core with ``each`` of them at least for each row of its tables, and eight times as many at most."""
    return max(1, min(math.ceil(n / (each << shape.bits)), cores), math.ceil(n / (8 * each << shape.bits)))


def observed(rows: DataFrame, shape: Shape, n: int) -> list[np.ndarray]:
    """Counts of feature and outcome at all ``n`` training places."""
    few = rows.coalesce(_tasks(n, shape, rows.sparkSession.sparkContext.defaultParallelism, 256))
    return _summed(few.filter("trains").select("symbols").mapInArrow(_observed(shape), _PIECES), shape)


def context_counts(rows: DataFrame, shape: Shape) -> DataFrame:
    """Each context of a training place and at how many it stands, in few tasks, as each makes tables of sums."""
    partial = rows.filter("trains").select("symbols").mapInArrow(_contexts(shape), "h long, c long")
    table = saved(partial.groupBy("h").agg(F.sum("c").alias("c")), "lm-contexts")
    few = table.coalesce(_tasks(table.count(), shape, rows.sparkSession.sparkContext.defaultParallelism, 32))
    few.scratch = table.scratch
    return few


def expected(table: DataFrame, weights: Weights) -> list[np.ndarray]:
    """Expected counts of feature and outcome at all training places; ``table``: of ``context_counts``."""
    known = table.sparkSession.sparkContext.broadcast(weights)
    return _summed(table.mapInArrow(_expected(known), _PIECES), weights.shape)


def initial(seen: np.ndarray, bias_rows: np.ndarray, share: float, floor: float) -> np.ndarray:
    """Weights from counts: the bias has log shares, another feature ``share`` of the log ratio of its outcomes to the bias's."""
    mean = seen.sum(0) + 1e-3
    p = mean / mean.sum()
    w = share * np.log((seen + floor * p) / ((seen.sum(1, keepdims=True) + floor) * p))
    w[bias_rows] = np.log((seen[bias_rows] + floor * p) / (seen[bias_rows].sum(1, keepdims=True) + floor))
    return w.astype(np.float32)


def train(rows: DataFrame, shape: Shape, n: int, rounds: int = 3, rate: float = 1.5) -> Weights:
    s0, s1 = observed(rows, shape, n)
    table = context_counts(rows, shape)
    w = Weights(shape, initial(s0, np.array([_BIAS]), 0.5, 5.0), initial(s1, np.unique(bias_rows(shape)), 0.5, 5.0))
    for _ in range(rounds):
        for weights, s, e, active in zip((w.classes, w.words), (s0, s1), expected(table, w), (4, 3), strict=True):
            e += s
            s *= 2
            weights += rate / active * (s - e) / (0.5 * e + 1.0)
            s /= 2
        w = Weights(shape, w.classes, w.words)
    forget(table)
    return w


def _score(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Weights = weights.value
        for batch in batches:
            scores = []
            for _, _, symbols, to in _parts(batch):
                one, two = contexts(symbols, to, w.shape.start)
                cls, word = split_symbols(w.shape, symbols)
                logs = np.empty(len(symbols))
                for at in _places(len(symbols)):
                    logs[at] = w.log(w.classes, class_features(w.shape, one[at], two[at]), cls[at])
                    head = np.flatnonzero(symbols[at] < w.shape.head) + at.start
                    if len(head):
                        logs[head] += w.log(w.words, word_features(w.shape, one[head], two[head], cls[head]), word[head])
                scores.append(np.add.reduceat(logs, to[:-1]) * _LOG10E)
            model = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*map(batch.column, _KEPT), model], [*_KEPT, "model"])

    return run


_KEPT = ("uid", "doc_id", "trains", "n_tokens", "n_known", "base", "tail")


def score(docs: DataFrame, mod: int = 10, held: int = 0, known: int = 1_000_000) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sc = docs.sparkSession.sparkContext
    base = with_uid(bounded(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), training_row(F.col("doc_id"), mod, held).alias("trains")))
    partial = base.filter("trains").select("text").mapInArrow(_counts, "h long, c long")
    counts = saved(partial.groupBy("h").agg(F.sum("c").alias("c")), "lm-counts")
    vocab = vocabulary(counts, known)
    rows = saved(base.mapInArrow(_encode(sc.broadcast(vocab)), _ROWS), "lm-rows")
    weights = sc.broadcast(train(rows, vocab.shape, vocab.n))

    rest = rows.select("uid", F.explode("rest").alias("h")).join(counts, "h", "left")
    more = rest.groupBy("uid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("l"), F.count("c").alias("k"))

    model = rows.select(*_KEPT, "symbols").mapInArrow(_score(weights), "uid long, doc_id long, trains boolean, n_tokens long, n_known long, base double, tail double, model double")
    zero = lambda x: F.coalesce(x, F.lit(0))
    return model.join(more, "uid", "left").select(
        "doc_id",
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + zero("k")).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("l")).alias("base_score"),
        (F.col("model") + F.col("tail") + zero("l")).alias("score"),
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
