from __future__ import annotations

import base64
import random
from pathlib import Path

import pytest

from silexa.llm import encoding

PATH = Path(encoding.TOKENIZERS) / "byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not PATH.exists(), reason="no vocabulary files")


@pytest.fixture(scope="module")
def other():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, PATH.open("rb"))}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_merging(other):
    rng = random.Random(5)
    bits = ["a", "aa", "b", "the", " ", "  ", "é", "中", "1", "'s", "'", "\n", "\t", "😀", "ing", "\x1c", "\x85", "_", "<|endoftext|>", "²", "Ⅷ", "́", " ", "0xDEAD", "ULPX_", "\x00", " ", "of", "zzzz", "ﬁ", "‍"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))
        ids = encoding.encode(text, str(PATH))
        assert ids == other.encode_ordinary(text), repr(text)
        assert other.decode(ids) == text


def test_defined_cases(spark, other):
    long = "reset " * 20_000 + "x" * 5000
    rows = [(1, None), (2, ""), (3, " "), (4, "<|endoftext|> ordinary"), (5, long), (6, "same"), (6, "same"), (None, "no id")]
    frame = spark.createDataFrame([(*r, [1], "x") for r in rows], "doc_id bigint, text string, ids array<int>, name string")
    got = encoding.token_ids(frame).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: list(r["ids"]) for r in got}
    assert by[1] == [] and by[2] == [] and by[5] == other.encode_ordinary(long) and by[4] == other.encode_ordinary("<|endoftext|> ordinary")
    assert {r["doc_id"]: r["n_tokens"] for r in encoding.token_counts(encoding.token_ids(frame)).collect()}[1] == 0
    assert encoding.token_ids(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_memo_bounds(other, monkeypatch):
    monkeypatch.setattr(encoding, "_KNOWN", 3)
    for text in ("one two three four five six seven", "eight nine ten one two"):
        assert encoding.encode(text, str(PATH)) == other.encode_ordinary(text)
