"""Spliced counts against the library's own encoding of whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citeweave.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(3)
    alphabet = ["the", "don't", "we're", " ", "  ", "\n", "\n\n ", "é", "😀", "ü", "漢字", "123", "4567", "!!", "<|endoftext|>", "<|endof", "a'll", "'s", "\t", "x" * 9]
    out = [None, "", "short text", "<|endoftext|>"]
    for n in (50, 400, 3000, 9000):
        out += ["".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(n)) for _ in range(4)]
    return out + ["a" * 5000, " " * 3000 + "b", "ab " * 3000, "<|endoftext|>" * 900]


@pytest.mark.parametrize(("step", "overlap"), [(200, 64), (700, 100)])
def test_spliced_counts(docs_of, step, overlap):
    tok = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts()))
    got = token_counts.count_tokens(docs_of(rows + [(None, rows[5][1])]), PATH, huge=300, step=step, overlap=overlap).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        text = rows[5 if r["doc_id"] is None else r["doc_id"]][1] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(tok.encode(text, add_special_tokens=False)), text[:60]


def test_counts_of_nothing(docs_of):
    assert token_counts.count_tokens(docs_of([]).filter("doc_id < 0"), PATH).count() == 0
