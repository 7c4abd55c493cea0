"""Byte-pair encoding of texts with a public vocabulary."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silexa.functions.batches import by_text

#: Where the vocabularies lie unless the caller says otherwise.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
# How the public vocabulary's texts are parted before pairs are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
# The same for texts of ASCII characters only, where the standard library's engine suffices and is faster.
_ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_KNOWN = 400_000


class Vocabulary:
    """Exact encoding by dynamic programming over prefixes.

    ``last[i]`` is the last token of the encoding of a piece's first ``i`` bytes. It is the one
    token that ends at ``i``, fits behind ``last`` of where it starts, and whose start has an
    encoding itself: a pair of tokens fits if merging their concatenation gives the two back.
    An automaton over the vocabulary lists the tokens that end at each byte; following the
    ``last`` tokens from the end gives the encoding. Memos keep pairs and whole pieces.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes = {r: t for t, r in ranks.items()}
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        self.halves = {rank: self._halves(token, ranks) for token, rank in ranks.items() if len(token) > 1}
        self.merged = {pair: rank for rank, pair in self.halves.items() if pair}
        self.fit: dict[tuple[int, int], bool] = {}
        self.left: dict[int, list[int]] = {}
        self.right: dict[int, list[int]] = {}

    @staticmethod
    def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
        """The pair whose merge makes the token; None where no merge leads to it."""
        own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = own, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], own)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (ranks[parts[0]], ranks[parts[1]]) if parts[0] in ranks and parts[1] in ranks else None

    def _edge(self, token: int, side: int, memo: dict[int, list[int]]) -> list[int]:
        """The tokens at one edge while ``token`` is being made, from its byte on."""
        if (known := memo.get(token)) is None:
            pair = self.halves.get(token)
            known = memo[token] = [*self._edge(pair[side], side, memo), token] if pair else [token]
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether the border between two adjacent tokens stays when their bytes are merged."""
        known = self.fit.get((a, b))
        if known is None:
            if len(self.fit) > 4 * _KNOWN:
                self.fit.clear()
            known = self.fit[a, b] = self._fits(self._edge(a, 1, self.right), self._edge(b, 0, self.left))
        return known

    def _fits(self, left: list[int], right: list[int]) -> bool:
        never = 1 << 62
        i = j = 0
        while True:
            grows_left = left[i + 1] if i + 1 < len(left) else never
            grows_right = right[j + 1] if j + 1 < len(right) else never
            across = self.merged.get((left[i], right[j]), never)
            # of equal merges the one further left comes first
            if across < grows_left and across <= grows_right and across < never:
                return False
            if grows_left == grows_right == never:
                return True
            if grows_left <= grows_right:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> list[int]:
        n = len(piece)
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        for end, (token, size) in self.ends.iter(piece.decode("latin-1")):
            end += 1
            if last[end] is None:
                start = end - size
                if start == 0:
                    if self.halves.get(token, True):
                        last[end] = (token, size)
                elif (before := last[start]) is not None and self.fits(before[0], token):
                    last[end] = (token, size)
        out = []
        while n:
            token, size = last[n]
            out.append(token)
            n -= size
        return out[::-1]


class _Pieces(dict):
    """Ids of pieces; emptied when it grows beyond a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) > _KNOWN:
            self.clear()
        ids = tuple(self.vocabulary.encode_piece(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= 64:
            self[piece] = ids
        return ids


_loaded: dict[str, tuple] = {}


def _tools(path: str) -> tuple:
    """Vocabulary, memo and pattern, made once per worker."""
    if path not in _loaded:
        vocabulary = Vocabulary(path)
        _loaded[path] = vocabulary, _Pieces(vocabulary), regex.compile(PATTERN)
    return _loaded[path]


def encode(text: str | None, path: str) -> list[int]:
    """Ids of one text; null and '' give none."""
    _, pieces, wide = _tools(path)
    if not text:
        return []
    return list(chain.from_iterable(map(pieces.__getitem__, (_ASCII if text.isascii() else wide).findall(text))))


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_text(whole, 1):
                found = [encode(t, path) for t in batch.column(1).to_pylist()]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return run


def token_ids(documents: DataFrame, tokenizer_dir: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of every document: the ids of its whole text, without special tokens.

    Strings that look like special tokens are ordinary text. ``tokenizer_dir`` has to be readable
    at the same place on every executor. One pass without a shuffle; a worker reads the
    vocabulary once and keeps memos of bounded size.

    Defined results: null and '' give an empty list; unpaired surrogates are encoded as their
    bytes; repeated rows come out repeated; columns of other names are ignored.
    """
    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(_encoded(f"{tokenizer_dir.rstrip('/')}/{name}.tiktoken"), "doc_id bigint, ids array<int>")


def token_counts(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens)."""
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"))
