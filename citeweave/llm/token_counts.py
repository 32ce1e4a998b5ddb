"""Token counts, with overlap resynchronisation for huge documents.

A document of up to ``huge`` characters is encoded whole.  A longer one is cut into chunks that overlap; the chunks are
encoded wherever there is room, each giving its number of tokens and, for the overlaps, the places where a pre-token
starts, with the number of tokens before it.  Two neighbours are spliced at a place where both start a pre-token: merges
never cross such a place and splitting into pre-tokens depends on what follows alone, so from there on both encodings
are the same, up to ``MARGIN`` characters before the left chunk's end (what a cut special string or contraction can
reach).  Where neighbours share no such place, the document is encoded anew with chunks and overlaps four times as wide, in the
last resort as a single chunk.  The counts are those of the whole text, always.

Cases.  A null or empty text has 0 bytes and 0 tokens.  Repeated rows and null ids get a result each.  An empty table gives
an empty result.  Further columns are ignored.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.common import bounded, documents, saved, with_uid

MARGIN = 32
SLICE_CHARS = 1 << 20


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in batches:
            texts, counts, begin = batch.column("text").to_pylist(), [], 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= SLICE_CHARS):
                    chars += len(texts[end])
                    end += 1
                counts += [len(e) for e in tok.encode_batch_fast(texts[begin:end], add_special_tokens=False)]
                begin = end
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def _chunks(step: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), step)
                last = len(starts) - 1
                for k, start in enumerate(starts):
                    piece = text[start:] if k == last else text[start : start + step + overlap]
                    yield pa.RecordBatch.from_pydict({"uid": [uid], "k": [k], "start": [start], "last": [k == last], "text": [piece]}, schema=_CHUNK)

    return run


_CHUNK = pa.schema([("uid", pa.int64()), ("k", pa.int32()), ("start", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])
_PART = "uid long, k int, last boolean, n long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"


def _encode_chunk(path: str, overlap: int):
    """For each chunk: pre-token starts of its first and its last ``overlap`` characters, as place in the document and tokens before."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = _tokenizer(path)
        for frame in frames:
            out = []
            for uid, k, start, last, text in frame[["uid", "k", "start", "last", "text"]].itertuples(index=False):
                e = tok.encode(text, add_special_tokens=False)
                head, tail = _starts(e, 0, overlap), [] if last else _starts(e, len(text) - overlap, len(text) - MARGIN + 1)
                out.append((uid, k, last, len(e), [start + p for p, _ in head], [i for _, i in head], [start + p for p, _ in tail], [i for _, i in tail]))
            yield pd.DataFrame(out, columns=["uid", "k", "last", "n", "head_at", "head_n", "tail_at", "tail_n"])

    return run


def _starts(encoding, low: int, high: int) -> list[tuple[int, int]]:
    """(place, token) where a pre-token starts at low <= place < high; only tokens near those places are looked at."""
    n, out = len(encoding), []
    i = 0 if low <= 0 else bisect_left(range(n), low, key=lambda i: encoding.token_to_chars(i)[0])
    while i < n and (place := encoding.token_to_chars(i)[0]) < high:
        if i == 0 or encoding.token_to_word(i) != encoding.token_to_word(i - 1):
            out.append((place, i))
        i += 1
    return out


def splice(parts: pd.DataFrame) -> int | None:
    """Tokens of one document from its chunks; None if two neighbours share no pre-token start."""
    parts = parts.sort_values("k")
    total, before, entered = 0, None, 0
    for part in parts.itertuples(index=False):
        if before is not None:
            here = dict(zip(part.head_at, part.head_n, strict=True))
            common = next(((n, here[at]) for at, n in zip(before.tail_at, before.tail_n, strict=True) if at in here), None)
            if common is None:
                return None
            total += common[0] - entered
            entered = common[1]
        before = part
    return int(total + before.n - entered)


def _splice(parts: pd.DataFrame) -> pd.DataFrame:
    n = splice(parts)
    return pd.DataFrame({"uid": [parts["uid"].iloc[0]], "n_tokens": pd.array([n], dtype="Int64")})


def count_tokens(docs: DataFrame, path: str, huge: int = 32768, step: int = 16384, overlap: int = 512) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens."""
    text = F.coalesce("text", F.lit(""))
    base = bounded(docs).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    small = base.filter(F.length("text") <= huge).mapInArrow(_encode_whole(path), "doc_id long, n_bytes long, n_tokens long")

    large = saved(with_uid(base.filter(F.length("text") > huge)), "huge-documents")
    pending, done = large.select("uid", "text"), None
    while True:
        chunks = pending.mapInArrow(_chunks(step, overlap), "uid long, k int, start long, last boolean, text string").repartition("uid", "k")
        parts = chunks.mapInPandas(_encode_chunk(path, overlap), _PART)
        found = saved(parts.groupBy("uid").applyInPandas(_splice, "uid long, n_tokens long"), "huge-counts")
        good = found.filter("n_tokens is not null")
        done = good if done is None else done.unionByName(good)
        failed = found.filter("n_tokens is null").select("uid")
        if failed.isEmpty():
            break
        pending = large.select("uid", "text").join(failed, "uid", "left_semi")
        step, overlap = step * 4, overlap * 4
    counted = large.select("uid", "doc_id", "n_bytes").join(done, "uid").select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(counted)


def op4_token_counts(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    import public_tokenizers

    found = count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
