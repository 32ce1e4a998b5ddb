"""Benchmark decontamination by spaced seeds.

A mask is laid on every word position of the documents and of the benchmark's items; it looks at some of the positions it covers and
ignores the others, so that a substituted word under an ignored position does not matter.  Documents and items join
on the hash of what a mask sees.  A Bloom filter of the items' hashes, of a bounded size, keeps most positions of clean documents from the
join; it loses none of the hits.  Each hit proposes an alignment of an item with a document; around it the words are compared
one by one, and the document is contaminated if a window of ``window`` item words (all of a shorter item) has at least
``same`` of its words in place.

Items shorter than a window are cut into one piece more than they may have words out of place, so one piece at least stands
unchanged in any passage that contains them: they are found by runs of words as long as a piece, and none is missed.

Words are runs of letters and digits, with A-Z lower-cased, so case, punctuation and spacing make no difference.

Rows are told apart by the hash of id and text, so null ids don't meet.  Of a document and an item only the distinct shifts of one to the other are kept,
8 bytes each and never more than the two have words; words come with an item once.

Cases.  A null or empty text contains nothing, and an item without words is contained in nothing.  A very long text is hashed by windows, and a repetitive one may
have as many shifts for an item as it has words; they are tried until one fits whole.  Of windows or shifts of one item with equally many words in place
the one at the smallest shift, then the first, is given.  Repeated rows are found
each.  Rows with a null id are found like others.  With an empty benchmark or no documents the result is empty.  Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import wordhash
from citeweave.llm.common import bit_set, bounded, documents, is_small, keep_rows, row_hash, saved, with_asked, with_uid

_U64 = np.uint64
#: 1: a position that the mask looks at.  Together they meet every window of 13 words that has up to two substituted.
MASKS = ("11101011", "1101100111", "110010110101", "1001111111")
#: The filter takes so many bits a hash, and never more than so many in all (64 MB); a fuller filter only lets more through to the join.
_BITS_EACH, _BITS_MOST = 512, 1 << 29
#: Most words of all items, 8 bytes each, that are broadcast; more are shuffled.
_WORDS_MOST = 4_000_000


def allowed(n: int, window: int, same: float) -> int:
    """How many words of an item of ``n`` may be out of place."""
    size = min(window, n)
    return sum(size - k >= same * size for k in range(1, size))


def pieces(n: int, window: int, same: float) -> list[tuple[int, int]]:
    """(place, length) of the pieces of an item of ``n`` words, shorter than a window."""
    edges = [n * k // (allowed(n, window, same) + 1) for k in range(allowed(n, window, same) + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def seeds(words: np.ndarray, firsts: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of what the mask sees at each place where it fits into a document, and those places in ``words``."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    total = np.full(n, int(mask, 2) + (len(mask) << 32), _U64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += words[k : k + n] * wordhash._TURNS[k]
    fits = np.zeros(len(words) + 1, np.int64)
    full = np.diff(firsts) >= len(mask)
    np.add.at(fits, firsts[:-1][full], 1)
    np.add.at(fits, firsts[1:][full] - len(mask) + 1, -1)
    places = np.flatnonzero(np.cumsum(fits[:-1])[:n] > 0)
    return wordhash.mix(total[places]), places


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, raw, offsets in wordhash.text_slices(batch):
            words, firsts = wordhash.word_hashes(raw, offsets, alnum=True)
            own = batch.slice(begin, end - begin)
            lists = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(words.view(np.int64)))
            yield pa.RecordBatch.from_arrays([own.column("item"), own.column("item_id"), lists], ["item", "item_id", "words"])


def _item_seeds(masks: tuple[str, ...], window: int, same: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [np.zeros((0, 3), np.int64)]
            for item, words in zip(frame["item"], frame["words"], strict=True):
                words = np.asarray(words, np.int64).view(_U64)
                n = len(words)
                if n >= window:
                    for mask in masks:
                        h, at = seeds(words, np.array([0, n]), mask)
                        out.append(np.column_stack([h.view(np.int64), np.full(len(h), item), at]))
                elif n:
                    for place, size in pieces(n, window, same):
                        h, at = seeds(words[place : place + size], np.array([0, size]), "1" * size)
                        out.append(np.column_stack([h.view(np.int64), np.full(len(h), item), at + place]))
            yield pd.DataFrame(np.concatenate(out), columns=["h", "item", "q"])

    return run


class Filter:
    """A Bloom filter with two probes."""

    def __init__(self, hashes: int):
        self.bits = 1 << min(_BITS_MOST, max(1 << 16, hashes * _BITS_EACH)).bit_length() - 1
        self.table = np.zeros(self.bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._at(hashes):
            np.bitwise_or.at(self.table, at >> _U64(3), np.uint8(1) << (at & _U64(7)).astype(np.uint8))

    def _at(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = _U64(self.bits - 1)
        return h & low, (h >> _U64(32)) & low

    def may_have(self, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` of hashes that may be in the filter."""
        one, two = self._at(h)
        left = np.flatnonzero(self.table[one >> _U64(3)] >> (one & _U64(7)).astype(np.uint8) & np.uint8(1))
        two = two[left]
        return left[(self.table[two >> _U64(3)] >> (two & _U64(7)).astype(np.uint8) & np.uint8(1)) > 0]


def _hits(masks: list[str], known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ = known.value
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                words, firsts = wordhash.word_hashes(raw, offsets, alnum=True)
                found = [(h[k], at[k]) for h, at in (seeds(words, firsts, m) for m in masks) for k in [known_.may_have(h)]]
                h, at = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
                row = np.searchsorted(firsts, at, side="right") - 1
                ids = batch.column("row").slice(begin, end - begin).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(h.view(np.int64)), pa.array(at - firsts[row])], ["row", "h", "p"])

    return run


def best_window(doc: np.ndarray, item: np.ndarray, shift: int, window: int) -> tuple[int, int]:
    """Most words in place in any ``window`` words of ``item`` laid at ``shift`` on ``doc``, and the first such window's place in the item."""
    window = min(window, len(item))
    same = np.zeros(len(item), np.int64)
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi > lo:
        same[lo:hi] = doc[lo + shift : hi + shift] == item[lo:hi]
    sums = np.cumsum(np.concatenate([[0], same]))
    sums = sums[window:] - sums[:-window]
    return int(sums.max()), int(sums.argmax())


#: Ids pass through pandas as text: a null beside them would turn them into floating-point numbers.
_FOUND = "uid long, doc_id string, item_id string, start long, n_words int, n_same int"


def _verify(window: int, same: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for uid, doc_id, text, asked in zip(frame["uid"], frame["doc_id"], frame["text"], frame["asked"], strict=True):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                doc, _ = wordhash.word_hashes(raw, np.array([0, len(raw)]), alnum=True)
                for ask in asked:
                    item = np.asarray(ask["words"], np.int64).view(_U64)
                    size, best = min(window, len(item)), (0, 0)
                    for shift in np.sort(np.asarray(ask["shifts"], np.int64)):
                        n, at = best_window(doc, item, int(shift), window)
                        if n > best[0]:
                            best = (n, int(shift) + at)
                        if n == size:
                            break
                    if best[0] >= same * size:
                        out.append((uid, doc_id, ask["item_id"], best[1], size, best[0]))
            yield pd.DataFrame(out, columns=["uid", "doc_id", "item_id", "start", "n_words", "n_same"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, window: int = 13, same: float = 0.8, uid: Column | None = None) -> DataFrame:
    """A row for each document and benchmark item that it contains: uid, doc_id, item_id, start (word), n_words, n_same of the best window."""
    spark = docs.sparkSession
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = saved(items.mapInArrow(_item_words, "item long, item_id long, words array<long>"), "items")
    index = saved(items.select("item", "words").mapInPandas(_item_seeds(masks, window, same), "h long, item long, q long"), "item-seeds")
    short = items.select(F.size("words").alias("n")).filter(f"n > 0 and n < {window}").distinct().collect()  # lengths under that of a window
    runs = sorted({size for r in short for _, size in pieces(r["n"], window, same)})
    known = spark.sparkContext.broadcast(_filter_of(index))

    base = bounded(docs).select(row_hash().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    hits = base.mapInArrow(_hits([*masks, *("1" * n for n in runs)], known), "row long, h long, p long")
    # A small index meets the hits where they are made; beyond that hits are shuffled, and adaptive execution splits frequent hashes.
    shifts = hits.join(F.broadcast(index) if is_small(index) else index, "h").groupBy("row", "item").agg(F.collect_set(F.col("p") - F.col("q")).alias("shifts"))
    n_words = items.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    known_items = items.withColumn("item_id", F.col("item_id").cast("string"))
    asked = shifts.join(F.broadcast(known_items) if n_words <= _WORDS_MOST else known_items, "item").groupBy("row").agg(F.collect_list(F.struct("item_id", "shifts", "words")).alias("asked"))
    asked = saved(asked.withColumnRenamed("row", "asked_row"), "alignments")
    near = with_uid(docs.select("doc_id", "text"), uid)
    rows = asked.select("asked_row")
    if is_small(rows):
        near = near.join(F.broadcast(rows), row_hash() == F.col("asked_row"), "left_semi")
    else:  # by a set of bits of a bounded size: only texts that it passes are shuffled
        near = with_asked(near, bit_set(rows, F.col("asked_row")), row_hash(), "is_asked").filter("is_asked").drop("is_asked")
    near = near.join(asked, row_hash() == F.col("asked_row")).select("uid", F.col("doc_id").cast("string").alias("doc_id"), "text", "asked")
    found = near.mapInPandas(_verify(window, same), _FOUND)
    return found.withColumns({name: F.col(name).cast("long") for name in ("doc_id", "item_id")})


def _filter_of(index: DataFrame, parts: int = 8) -> Filter:
    """The filter of all hashes: ``parts`` filters of the bounded size are made on the executors and united one by one."""
    n = index.count()

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = Filter(n)
        for frame in frames:
            part.add(frame["h"].to_numpy(np.int64).view(_U64))
        yield pd.DataFrame({"table": [part.table.tobytes()]})

    whole = Filter(n)
    for row in index.select("h").coalesce(parts).mapInPandas(make, "table binary").toLocalIterator():
        whole.table |= np.frombuffer(row["table"], np.uint8)
    return whole


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they are."""
    found = contaminated(docs, benchmark, uid=row_hash()).select("doc_id", "uid").distinct()
    return keep_rows(docs, found.select("doc_id", "uid", F.lit(False).alias("kept"), F.lit(False).alias("once")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "start", "n_words", "n_same")
