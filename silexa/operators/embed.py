"""Embedding of texts: any batch function, loaded once per worker; a hashing one is built in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[list[str]], list[list[float]]]
#: Set before a query's text; documents are embedded as they are.
QUERY_PREFIX = "Instruct: find passages of documentation that answer the question\nQuery: "


def hashing_embedder(dimension: int = 64) -> Embedder:
    """Unit vectors of signed word hashes: deterministic, needs no model."""
    import zlib

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dimension), np.float32)
        for row, text in zip(out, texts):
            for word in (text or "").lower().split():
                h = zlib.crc32(word.encode())
                row[h % dimension] += 1 if h >> 31 else -1
            norm = np.linalg.norm(row)
            if norm:
                row /= norm
        return out.tolist()

    return embed


def embed_documents(docs: DataFrame, make: Callable[[], Embedder], text: str = "text", batch: int = 32) -> DataFrame:
    """Adds ``vector``. ``make`` runs once per worker; texts go through it in batches of similar length.

    Null texts get the vector of ''.
    """

    @F.pandas_udf("array<float>")
    def vector(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = make()
        for part in parts:
            texts = part.fillna("").tolist()
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            out: list = [None] * len(texts)
            for k in range(0, len(order), batch):
                some = order[k : k + batch]
                for i, v in zip(some, embed([texts[i] for i in some])):
                    out[i] = v
            yield pd.Series(out)

    return docs.withColumn("vector", vector(F.col(text)))


def embed_query(text: str, embed: Embedder) -> list[float]:
    """The vector of a question, with its prefix."""
    return embed([QUERY_PREFIX + text])[0]
