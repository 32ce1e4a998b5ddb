"""Words of many documents as 64-bit hashes, computed in numpy over Arrow buffers.

A hash depends on a word's bytes alone.  Two words share one with probability 2**-64, so that sets of hashes stand for
sets of words: a wrong count needs a clash inside one pair of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The same for words of letters and digits: all ASCII bytes but 0-9, A-Z, a-z part them.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [(1 << 64) - 1], dtype=U64)
#: Longer words are hashed one by one.
_LONG = 512
#: Bytes that are worked on at a time.
WINDOW = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * _M2
    x = (x ^ (x >> U64(27))) * _M3
    return x ^ (x >> U64(31))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = WINDOW) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with up to ``limit`` bytes, one row at least; null is empty."""
    texts = batch.column(column)
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1)
        yield begin, end, raw[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def _bounds(raw: np.ndarray, breaks: np.ndarray, alnum: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; ``breaks``: places in ``raw`` that no word goes across."""
    edge = np.zeros(len(raw) + 1, bool)
    edge[breaks] = True
    edge[0] = edge[-1] = True
    word = ~(_APART if alnum else _SPACE)[raw]
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eight = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    out = mix(left.astype(U64) * _M1)
    long = np.flatnonzero(left > _LONG)
    now = np.flatnonzero((left > 0) & (left <= _LONG))
    at, left = starts[now], left[now]
    while len(now):
        chunk = eight[at] & _KEEP[np.minimum(left, 8)]
        out[now] = mix((out[now] ^ chunk) * _M1 + _M2)
        more = left > 8
        now, at, left = now[more], at[more] + 8, left[more] - 8
    for k in long:
        out[k] = U64(int.from_bytes(hashlib.blake2b(raw[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little"))
    return out


def word_spans(raw: np.ndarray, offsets: np.ndarray, alnum: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, lower-cased bytes, starts, ends) by windows of ``WINDOW`` bytes; all words come once, in order.

    Windows end at white space or between documents.  Starts and ends count from the window's place.
    """
    at = 0
    while at < len(raw):
        end = min(len(raw), at + WINDOW)
        while end < len(raw):  # go on to the next space or document
            near = raw[end : end + WINDOW]
            gap = np.flatnonzero(_SPACE[near])
            stop = end + (int(gap[0]) if len(gap) else len(near))
            k = int(np.searchsorted(offsets, end))
            stop = min(stop, int(offsets[k])) if k < len(offsets) else stop
            done = len(gap) > 0 or (k < len(offsets) and stop == int(offsets[k]))
            end = stop
            if done:
                break
        window = raw[at:end]
        breaks = offsets[(offsets > at) & (offsets < end)] - at
        starts, ends = _bounds(window, breaks, alnum)
        yield at, _LOWER[window], starts, ends
        at = end


def word_hashes(raw: np.ndarray, offsets: np.ndarray, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents, and the offset of each document's first word (one more than documents)."""
    hashes, places = [], []
    for at, window, starts, ends in word_spans(raw, offsets, alnum):
        hashes.append(hash_spans(window, starts, ends))
        places.append(starts + at)
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


_TURNS = mix(np.arange(1, 65, dtype=U64) * _M1) | U64(1)


def shingles(words: np.ndarray, firsts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's runs of ``size`` words (all words as one run if there are fewer), and offsets."""
    counts = np.diff(firsts)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    to = np.zeros(len(firsts), np.int64)
    np.cumsum(made, out=to[1:])
    out = np.zeros(int(to[-1]), U64)
    n = len(words) - size + 1
    if n > 0:
        run = words[:n] * _TURNS[0]
        for k in range(1, size):
            run = run + words[k : k + n] * _TURNS[k]
        run = mix(run)
        full = counts >= size
        inside = np.zeros(len(words) + 1, np.int64)  # +1 where a document's runs begin, -1 where they end
        np.add.at(inside, firsts[:-1][full], 1)
        np.add.at(inside, firsts[1:][full] - size + 1, -1)
        keep = np.flatnonzero(np.cumsum(inside[:-1])[:n] > 0)
        slot = np.zeros(len(out), bool)
        for_full = np.repeat(full, made)
        slot[:] = for_full
        out[slot] = run[keep]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[firsts[d] : firsts[d + 1]]
        out[to[d]] = mix(np.sum(own * _TURNS[: len(own)], keepdims=True) + _TURNS[-len(own)])[0]
    return out, to
