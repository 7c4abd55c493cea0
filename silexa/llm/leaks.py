"""Documents that contain passages of held-out evaluation items."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silexa.functions.batches import by_text
from silexa.functions.pywords import TERM, folded
from silexa.llm.near_dups import WordCodes, mixed
from silexa.session import cut

#: Words of a shingle; shorter runs are one shingle.
SHINGLE = 5
#: Bits of the filter of item shingles: 16 for each, between these powers of two.
LEAST_BITS, MOST_BITS = 16, 28
RUNS = "item_id bigint, at int, item_words int, run string, shingles array<bigint>"
FOUND = "shingle bigint, n bigint, row bigint, doc_id bigint, at int, words array<string>, shingles array<bigint>"
LEAKS = "doc_id bigint, item_id bigint, shared_words int, item_words int, share double"


def shingle_hashes(words: list[str], size: int, codes: WordCodes) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words."""
    coded = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    n = max(0, len(coded) - size + 1)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + coded[k : k + n]
    return mixed(value)


def _runs(run: int, size: int):
    """The runs of the texts of each item; runs don't cross texts."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            rows = []
            for item, texts in zip(*(c.to_pylist() for c in batch.columns)):
                lists = [w for w in (TERM.findall(folded(t)) for t in sorted(texts)) if len(w) >= run]
                total, at = sum(map(len, lists)), 0
                for words in lists:
                    hashes = shingle_hashes(words, size, codes).view(np.int64)
                    rows += [(item, at + k, total, " ".join(words[k : k + run]), hashes[k : k + run - size + 1].tolist()) for k in range(len(words) - run + 1)]
                    at += len(words)
            columns, types = list(zip(*rows)) or [()] * 5, (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[x.split()[0] for x in RUNS.split(", ")])

    return go


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a shingle."""
    mask = np.uint64((1 << bits) - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def shingle_filter(shingles: DataFrame, bits: int | None) -> tuple[np.ndarray, int]:
    """Bits set for all shingles, put together by the tasks: two for each of 16, at most 2^MOST_BITS (32 MB)."""
    if bits is None:
        n = shingles.agg(F.approx_count_distinct("shingle")).first()[0]
        bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, 16 * n)))))
    mask = F.lit((1 << bits) - 1)
    both = F.explode(F.array(F.col("shingle").bitwiseAND(mask), F.shiftrightunsigned("shingle", 32).bitwiseAND(mask)))
    spots = shingles.select(both.alias("spot")).select(F.shiftright("spot", 6).alias("slot"), F.expr("shiftleft(1L, cast(spot & 63 AS INT))").alias("bit"))
    told = spots.groupBy("slot").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # at most 2^MOST_BITS / 64 rows
    out = np.zeros(max(1, (1 << bits) // 64), np.int64)
    out[told["slot"].to_numpy()] = told["bits"].to_numpy()
    return out.view(np.uint8), bits


def _passages(run: int, size: int, wanted: Broadcast):
    """What of the documents may be in items: how often each shingle, and passages of ``run`` or more words all of whose shingles are."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
    least = run - size + 1

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, (filter_, bits) = WordCodes(), wanted.value
        for batch in (part for whole in batches for part in by_text(whole, 2)):
            flat: list[str] = []
            ends = []
            for text in batch.column(2).to_pylist():
                flat += TERM.findall(folded(text))
                ends.append(len(flat))
            hashes = shingle_hashes(flat, size, codes)
            if not len(hashes):
                continue
            held = np.ones(len(hashes), bool)
            for place in _places(hashes, bits):
                held &= (filter_[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            for end in set(ends):  # shingles across the ends of texts are none
                held[max(0, end - size + 1) : end] = False
            seen, n = np.unique(hashes[held], return_counts=True)
            turns = np.flatnonzero(np.diff(np.r_[False, held, False].astype(np.int8)))
            low, high = turns[::2], turns[1::2]
            long = high - low >= least
            low, high = low[long], high[long]
            doc = np.searchsorted(ends, low, side="right")
            starts = np.r_[0, ends][doc]
            none = [None] * len(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([*seen.view(np.int64).tolist(), *[None] * len(low)], types[0]), pa.array([*n.tolist(), *[None] * len(low)], types[1]),
                pa.array(none + batch.column(0).take(pa.array(doc)).to_pylist(), types[2]), pa.array(none + batch.column(1).take(pa.array(doc)).to_pylist(), types[3]),
                pa.array(none + (low - starts).tolist(), types[4]), pa.array(none + [flat[a : b + size - 1] for a, b in zip(low, high)], types[5]),
                pa.array(none + [hashes[a:b].view(np.int64).tolist() for a, b in zip(low, high)], types[6]),
            ], names=names)

    return go


def shared_words(hits: list[tuple[int, int]], run: int, length: int) -> int:
    """Most words of an item of ``length`` words that one window of the document, as long as the item, holds in shared runs.

    ``hits``: where runs begin in the document and in the item.
    """
    hits = sorted(hits)
    reach = max(0, length - run)
    best, low, held = 0, 0, Counter()
    for p, k in hits:
        held.update(range(k, k + run))
        while hits[low][0] < p - reach:
            for x in range(hits[low][1], hits[low][1] + run):
                held[x] -= 1
                if not held[x]:
                    del held[x]
            low += 1
        best = max(best, len(held))
    return best


def _contained(run: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, item, length, at, k = (batch.column(c) for c in ("doc_id", "item_id", "item_words", "p", "k"))
            shared = [shared_words(list(zip(p, q)), run, n) for p, q, n in zip(at.to_pylist(), k.to_pylist(), length.to_pylist())]
            share = [round(s / n, 6) for s, n in zip(shared, length.to_pylist())]
            yield pa.RecordBatch.from_arrays([doc, item, pa.array(shared, pa.int32()), length, pa.array(share, pa.float64())], names=[x.split()[0] for x in LEAKS.split(", ")])

    return go


def leaks(documents: DataFrame, items: DataFrame, run: int = 10, bits: int | None = None) -> DataFrame:
    """(doc_id, item_id, shared_words, item_words, share) for every document and item with at least ``run`` consecutive words in common.

    Both texts are put into NFKC, lower-cased and rid of format characters; words are runs of
    letters, digits and underscores.

    A set join on shingles of SHINGLE words with prefix filter. (1) One pass over the documents, for
    any number of items, keeps by a filter of fixed size what may be a shingle of an item: counts of
    the shingles in all documents, and passages that consist of such shingles and have the length
    of a run. (2) Shingles are ordered by these counts. A shared run has all its shingles in
    common, so the necessary prefix of a run is the rarest of them: runs and passages are joined
    on it, by a shuffle, where its position leaves room for the rest of the run on both sides.
    (3) The words of each candidate are compared, and the words of the item counted in windows
    of the document as long as the item: shared_words are the most that one window holds, ``run``
    at least.

    Defined results: null and empty texts, and items shorter than ``run`` words, match nothing; an
    item that repeats or contains another is reported beside it; an item_id given twice counts as
    all its texts; rows of an item without an id take no part; repeated documents are reported
    each; columns of other names are ignored. ``bits`` sets the size of the filter (for tests); the
    result doesn't depend on it.
    """
    size = min(SHINGLE, run)
    told = items.select("item_id", "text").where(F.col("item_id").isNotNull() & (F.length("text") > 0)).groupBy("item_id").agg(F.collect_list("text").alias("texts"))
    runs = cut(told.mapInArrow(_runs(run, size), RUNS), "runs")
    wanted = documents.sparkSession.sparkContext.broadcast(shingle_filter(runs.select(F.explode("shingles").alias("shingle")), bits))

    # a word takes a character and a blank, but in NFKC one character may become many
    other = F.octet_length("text") > F.length("text")
    texts = documents.where((F.length("text") >= 2 * run - 1) | other).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = cut(texts.mapInArrow(_passages(run, size, wanted), FOUND), "passages")

    count = found.where("row IS NULL").groupBy("shingle").agg(F.sum("n").alias("n"))
    one = runs.select("run", "shingles").dropDuplicates(["run"]).select("run", F.posexplode("shingles").alias("offset", "shingle"))
    prefix = one.join(count, "shingle").groupBy("run").agg(F.min(F.struct("n", "shingle", "offset")).alias("rarest"), F.count("*").alias("have"))
    prefix = prefix.where(F.col("have") == run - size + 1).select("run", "rarest.shingle", "rarest.offset")

    spots = found.where("row IS NOT NULL").select("row", "doc_id", "at", "words", F.posexplode("shingles").alias("p", "shingle"))
    before = F.least("p", F.lit(run - size))
    spots = spots.select("row", "doc_id", "shingle", (F.col("at") + F.col("p")).alias("p"), before.alias("before"), F.slice("words", F.col("p") - before + 1, F.lit(2 * run - size)).alias("near"))
    room = (F.col("offset") <= F.col("before")) & (F.col("before") - F.col("offset") + run <= F.size("near"))
    same = F.array_join(F.slice("near", F.col("before") - F.col("offset") + 1, F.lit(run)), " ") == F.col("run")
    matched = spots.join(prefix, "shingle").where(room).where(same).select("row", "doc_id", "run", (F.col("p") - F.col("offset")).alias("p"))

    hits = matched.join(runs.select("run", "item_id", F.col("at").alias("k"), "item_words"), "run")
    lists = hits.groupBy("row", "doc_id", "item_id", "item_words").agg(F.collect_list(F.struct("p", "k")).alias("h"))  # no longer than the document
    lists = lists.select("doc_id", "item_id", "item_words", F.col("h.p").alias("p"), F.col("h.k").alias("k"))
    return lists.mapInArrow(_contained(run), LEAKS).where(F.col("shared_words") >= run)
