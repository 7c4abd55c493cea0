"""Near-duplicate texts: an exact set-similarity join on word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silexa.functions.batches import by_items, by_text
from silexa.functions.pywords import terms
from silexa.functions.totals import total_array
from silexa.session import cut

DIGESTS, SETS = "raw_id bigint, digest binary", "raw_id bigint, size int, shingles array<int>"
SIGNED = "band int, part int, class_id bigint, size int, own boolean, scan boolean, bits binary, whole array<int>, less array<int>"
#: Counters of the popularity sketch.
COUNTERS = 1 << 20
#: Heads of classes (8 bytes each) that are sent to all tasks; more of them are joined by a shuffle.
SENT_HEADS = 1_000_000
#: Signatures that one task joins.
JOINED = 3_000_000
#: Candidate pairs compared at a time.
BLOCK = 2_000_000
_KNOWN = 1_000_000


class WordCodes(dict):
    """64-bit code of a word; the memo is emptied when it grows beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > _KNOWN:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], words: int, least: int, codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 32-bit hashes of the distinct runs of ``words`` terms of all texts, and how many each text has (-1: under ``least`` terms)."""
    flat: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = terms(text)
        if len(found) < least:
            found = []
        counts[i] = len(found)
        flat += found
    coded = np.fromiter(map(codes.__getitem__, flat), np.uint64, len(flat))
    runs = max(0, len(coded) - words + 1)
    value = np.zeros(runs, np.uint64)
    for k in range(words):
        value = value * np.uint64(0x9E3779B97F4A7C15) + coded[k : k + runs]
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = owner[:runs] == owner[words - 1 :] if runs else np.zeros(0, bool)
    keys = np.unique((owner[:runs][inside].astype(np.uint64) << np.uint64(32)) | (mixed(value[inside]) >> np.uint64(32)))
    sizes = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    sizes[counts == 0] = -1
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), sizes


def _sets(words: int, least: int, whole: bool):
    """The shingles of each text, or without ``whole`` a digest of them only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in (part for every in batches for part in by_text(every, 1)):
            hashes, sizes = shingle_sets(batch.column(1).to_pylist(), words, least, codes)
            kept = np.flatnonzero(sizes > 0)
            ids, ends = batch.column(0).take(pa.array(kept)), np.cumsum(np.maximum(sizes, 0))
            if whole:
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends[kept]].astype(np.int32)), pa.array(hashes.view(np.int32)))
                columns, names = [ids, pa.array(sizes[kept].astype(np.int32)), lists], SETS
            else:
                digests = [xxhash.xxh3_128_digest(hashes[e - n : e].tobytes()) for n, e in zip(sizes[kept].tolist(), ends[kept].tolist())]
                columns, names = [ids, pa.array(digests, pa.binary())], DIGESTS
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in names.split(", ")])

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and lengths."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def _counted(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    total = np.zeros(COUNTERS)
    for batch in batches:
        values, _ = _lists(batch.column(0))
        total += np.bincount(values.view(np.uint32) & np.uint32(COUNTERS - 1), minlength=COUNTERS)
    return total


def popularity(sets: DataFrame) -> np.ndarray:
    """In how many sets each shingle occurs, by a sketch of fixed size over all sets."""
    return np.minimum(total_array(sets.select("shingles"), _counted, COUNTERS), np.iinfo(np.int32).max).astype(np.int32)


def band_edges(largest: int, similarity: float) -> list[int]:
    """First sizes of the bands up to that of ``largest``; similar sets are in one band or in adjacent ones."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * max(1.1, 1 / similarity))))
    return edges


def segment_count(high: int, similarity: float) -> int:
    """Segments of the universe for sets up to ``high`` shingles and their larger partners.

    Twice the segments has to exceed the largest difference by some slack, so that costly
    segments can be passed over; tiny sets get a segment for nearly each shingle.
    """
    half = ((1 - similarity) / similarity * high + 1) / 2
    return max(1, math.ceil(1.15 * half + math.sqrt(half)), min(64, high * high))


def _signed(edges: list[int], parts: dict[int, int], similarity: float, popular: Broadcast):
    """Signatures of the sets for their own band and for the lower ones in which they may have partners."""
    ratio = (1 - similarity) / (1 + similarity)
    starts = np.array(edges)

    def emit(band: int, ids, sizes, own, values, counter) -> pa.RecordBatch:
        high = edges[band + 1] - 1
        m, split = segment_count(high, similarity), parts.get(band, 1)
        by_segment = min(split, m)
        extra = -(-split // by_segment)
        owner = np.repeat(np.arange(len(ids)), sizes)
        segment = (values.astype(np.uint64) * np.uint64(m)) >> np.uint64(32)
        key = owner * m + segment.astype(np.int64)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.diff(np.r_[first, len(key)])
        scrambled = mixed(values.astype(np.uint64) + np.uint64(1))
        total = np.add.reduceat(scrambled, first)
        held, where = owner[first], segment[first]
        # cost: how common the subset stays when its rarest shingle is taken out
        common = counter[values & np.uint32(COUNTERS - 1)].astype(np.int64)
        rarest = np.minimum.reduceat(common, first)
        is_rarest = common == np.repeat(rarest, length)
        rest = np.minimum.reduceat(np.where(is_rarest, np.iinfo(np.int64).max, common), first)
        cost = np.where((length == 1) | (np.add.reduceat(is_rarest.astype(np.int64), first) > 1), rarest, rest)
        gives = np.where(length > 1, 2, 1)
        need = np.floor(ratio * (sizes + np.minimum(sizes, high)) + 1e-9).astype(np.int64) + 1
        order = np.lexsort((cost, held))
        run = np.cumsum(gives[order])
        opens = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
        before = run - gives[order] - np.repeat(run[opens] - gives[order][opens], np.diff(np.r_[opens, len(held)]))
        probes = np.zeros(len(first), bool)
        probes[order] = before < need[held[order]]
        short = np.add.reduceat(gives, opens) < need
        # signatures: the whole subset, and without each of its shingles; lowest bits: 1 = doesn't probe
        several = np.repeat(length > 1, length)
        flag = (~probes).astype(np.uint64)
        whole = (mixed(total + where * np.uint64(0xA24BAED4963EE407)) >> np.uint64(33) << np.uint64(1)) | flag
        less = (mixed(np.repeat(total, length) - scrambled + segment * np.uint64(0xA24BAED4963EE407)) >> np.uint64(33) << np.uint64(1)) | np.repeat(flag, length)
        keep = probes | own[held]  # a set of a higher band only probes
        keep_less = (np.repeat(keep, length) & several)
        outs = []
        for sig, at, seg in ((whole[keep], held[keep], where[keep]), (less[keep_less], owner[keep_less], segment[keep_less])):
            part = (seg.astype(np.int64) * by_segment) // m
            if extra > 1:
                part = part * extra + ((sig >> np.uint64(1)) % np.uint64(extra)).astype(np.int64)
            row = at * split_all + part if (split_all := by_segment * extra) else at
            if extra > 1:
                o = np.argsort(row, kind="stable")
                row, sig = row[o], sig[o]
            outs.append((row, sig.astype(np.uint32).view(np.int32), np.bincount(row, minlength=len(ids) * split_all)))
        filled = (outs[0][2] > 0) | (outs[1][2] > 0)
        filled[::split_all] = True
        rows = np.flatnonzero(filled)
        at, part = rows // split_all, rows % split_all
        bits = 1 << max(7, (2 * high - 1).bit_length())
        bits = min(bits, 8192)
        spots = (scrambled >> np.uint64(20)) % np.uint64(bits)
        odd = np.bincount(owner * bits + spots.astype(np.int64), minlength=len(ids) * bits) & 1
        packed = np.packbits(odd.astype(np.uint8).reshape(len(ids), bits), axis=1)
        columns = [pa.array(np.full(len(rows), band, np.int32)), pa.array(part.astype(np.int32)), pa.array(ids[at]), pa.array(sizes[at].astype(np.int32)), pa.array(own[at]), pa.array(short[at] & (part == 0))]
        width = bits // 8
        columns.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(packed[at]))]))
        for _, sig, n in outs:
            columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n[rows])].astype(np.int32)), pa.array(sig)))
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SIGNED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = popular.value
        for whole_batch in batches:
            for batch in by_items(whole_batch, 1):
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                values, sizes = _lists(batch.column(1))
                values = values.view(np.uint32)
                of = np.searchsorted(starts, sizes, side="right") - 1
                for band in range(int(of.max()) + 1 if len(of) else 0):
                    high = edges[band + 1] - 1
                    taken = (of == band) | ((of > band) & (sizes * similarity <= high + 1e-9))
                    if parts.get(band) and taken.any():
                        yield emit(band, ids[taken], sizes[taken], of[taken] == band, values[np.repeat(taken, sizes)], counter)

    return run


def _candidates(similarity: float):
    """Pairs of one part of a band that share a signature and whose bits differ no more than similar sets can."""
    ratio = (1 - similarity) / (1 + similarity)

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        n = group.num_rows
        ids, sizes = group["class_id"].to_numpy(), group["size"].to_numpy().astype(np.int64)
        own, scan = group["own"].to_numpy(), group["scan"].to_numpy()
        bits = np.frombuffer(b"".join(group["bits"].to_pylist()), np.uint64).reshape(n, -1)
        block = max(1, min(BLOCK, (64 << 20) // (8 * bits.shape[1])))
        found: list[np.ndarray] = []

        def check(a: np.ndarray, b: np.ndarray) -> None:
            a, b = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
            ok = (a != b) & (own[a] | own[b]) & (np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]) - 1e-9)
            a, b = a[ok], b[ok]
            differ = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            ok = differ <= ratio * (sizes[a] + sizes[b]) + 1e-9
            found.append(np.unique(a[ok] * n + b[ok]))

        # signature (31 bits), less, doesn't probe, owner: sorted by themselves, without an order beside them
        keys = []
        for k, name in enumerate(("whole", "less")):
            values, counts = _lists(group[name].chunk(0) if group[name].num_chunks else group[name].combine_chunks())
            sig = values.view(np.uint32).astype(np.uint64)
            keys.append(((sig >> np.uint64(1)) << np.uint64(33)) | np.uint64(k << 32) | ((sig & np.uint64(1)) << np.uint64(31)) | np.repeat(np.arange(n, dtype=np.uint64), counts))
        key = np.concatenate(keys)
        del keys, sig
        key.sort()
        owner, rank, base = (key & np.uint64(0x7FFFFFFF)).astype(np.int32), ((key >> np.uint64(31)) & np.uint64(3)).astype(np.int8), (key >> np.uint64(33)).astype(np.uint32)
        del key
        first = np.flatnonzero(np.r_[True, base[1:] != base[:-1]]) if len(base) else np.zeros(0, np.int64)
        length = np.diff(np.r_[first, len(base)])
        run_of = np.repeat(np.arange(len(first), dtype=np.int32), length)
        ends = first + length
        at = np.arange(len(base), dtype=np.int32)
        below = [np.bincount(run_of[rank == k], minlength=len(first)) for k in range(3)]
        less_from = first + below[0] + below[1]
        start = np.where(rank == 0, at + 1, less_from[run_of])
        stop = np.where(rank == 0, ends[run_of], np.where(rank == 1, (less_from + below[2])[run_of], start))
        many = np.maximum(stop - start, 0)
        active = np.flatnonzero(many)
        done = np.cumsum(many[active])
        k = 0
        while k < len(active):
            upto = max(k + 1, int(np.searchsorted(done, (done[k - 1] if k else 0) + block, side="right")))
            some = active[k:upto]
            for low in range(0, int(many[some].max()), block):  # one run may be longer than a block
                part = np.clip(many[some] - low, 0, block)
                shift = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
                check(np.repeat(owner[some], part), owner[np.repeat(start[some] + low, part) + shift])
            k = upto
            if len(found) > 64:
                found[:] = [np.unique(np.concatenate(found))]
        everyone = np.arange(n)
        for i in np.flatnonzero(scan):
            check(np.full(n, i), everyone)
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        a, b = pairs // max(n, 1), pairs % max(n, 1)
        small = sizes[a] <= sizes[b]
        return pa.table({"id_s": pa.array(np.where(small, ids[a], ids[b])), "id_t": pa.array(np.where(small, ids[b], ids[a]))})

    return run


class NearDuplicates:
    """Rows of a table whose texts share at least ``similarity`` of their shingles (Jaccard).

    Steps. (1) Every text becomes the set of 32-bit hashes of its runs of ``words`` terms; rows
    with equal sets form a class, which goes on as one set, however many copies it has. (2) Sets
    are put into bands by size. The universe of shingles is cut into segments, more of them for
    bands of larger sets. Similar sets differ in at most H shingles, so if the segments that the
    larger one probes give more than H together - one for a segment probed for equality, two for
    one probed with one deletion - one of them matches. (3) Each set picks the cheapest segments
    that suffice, by a popularity sketch over all sets. Signatures are joined within parts of
    bands; parts grow in number, not in size. (4) Candidates are compared by parity bits, which
    can't reject a similar pair, and the remaining ones exactly.

    The result doesn't depend on costs, bands or parts. Defined results: null, empty and short
    texts (under ``least`` terms) take no part and are similar to none; repeated rows are classes;
    columns of other names are ignored.

    ``members``: raw_id, class_id (smallest raw_id of the class). ``pairs``: id_a, id_b (class
    ids, id_a < id_b), shared (shingles), size_a, size_b.
    """

    def __init__(self, chunks: DataFrame, words: int = 5, similarity: float = 0.8, least: int | None = None) -> None:
        least = max(words, least or 0)
        # a term takes a character and a blank, but beyond ASCII a lower-case letter may be several characters
        long = (F.length("text") >= 2 * least - 1) | (F.octet_length("text") > F.length("text"))
        texts = chunks.select("raw_id", "text").where(long)
        digests = cut(texts.mapInArrow(_sets(words, least, False), DIGESTS), "digests")
        classes = digests.groupBy("digest").agg(F.min("raw_id").alias("class_id"))
        self.members = cut(digests.join(classes, "digest").select("raw_id", "class_id"), "members")
        heads = self.members.where("raw_id = class_id").select("class_id").distinct()
        # sets are made again for the heads of classes: the digests are a fraction of what writing all sets would take
        head = lambda rows: rows.join(picked, F.col("raw_id") == F.col("class_id")).drop("class_id")
        if heads.count() <= SENT_HEADS:
            picked = F.broadcast(heads)
            sets = head(texts).mapInArrow(_sets(words, least, True), SETS)
        else:  # sets are smaller than texts to shuffle
            picked = heads
            sets = head(texts.mapInArrow(_sets(words, least, True), SETS))
        one = cut(sets.select(F.col("raw_id").alias("class_id"), "size", "shingles"), "sets")
        self.pairs = cut(self._join(one, similarity), "pairs")

    @staticmethod
    def _join(one: DataFrame, similarity: float) -> DataFrame:
        largest = one.agg(F.max("size")).first()[0] or 0
        edges = band_edges(largest, similarity)
        band = F.lit(0)
        for k, edge in enumerate(edges):  # a few dozen: sizes grow geometrically
            band = F.when(F.col("size") >= edge, k).otherwise(band)
        tokens = {r["band"]: r["n"] for r in one.groupBy(band.alias("band")).agg(F.sum("size").alias("n")).collect()}
        parts = {b: -(-int(1.4 * (n + tokens.get(b + 1, 0))) // JOINED) for b, n in tokens.items()}
        popular = one.sparkSession.sparkContext.broadcast(popularity(one))
        signed = one.select("class_id", "shingles").mapInArrow(_signed(edges, parts, similarity, popular), SIGNED)
        met = signed.groupBy("band", "part").applyInArrow(_candidates(similarity), "id_s bigint, id_t bigint").distinct()
        # a head that is there twice is met by itself and verified twice
        return verified(met.where("id_s <> id_t"), one, similarity).distinct()


def verified(met: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (id_s, id_t) whose shingles are as similar as asked, counted exactly.

    The smaller set travels to the larger one.
    """
    s = sets.select(F.col("class_id").alias("id_s"), F.col("shingles").alias("in_s"))
    t = sets.select(F.col("class_id").alias("id_t"), F.col("shingles").alias("in_t"))
    both = met.join(s, "id_s").join(t, "id_t")
    shared = F.size(F.array_intersect("in_s", "in_t"))
    counted = both.select("id_s", "id_t", F.size("in_s").alias("size_s"), F.size("in_t").alias("size_t"), shared.alias("shared"))
    counted = counted.where(F.col("shared") >= similarity * (F.col("size_s") + F.col("size_t") - F.col("shared")) - 1e-9)
    ordered = F.col("id_s") < F.col("id_t")
    pick = lambda x, y: F.when(ordered, F.col(x)).otherwise(F.col(y))
    return counted.select(pick("id_s", "id_t").alias("id_a"), pick("id_t", "id_s").alias("id_b"), "shared", pick("size_s", "size_t").alias("size_a"), pick("size_t", "size_s").alias("size_b"))


def row_pairs(found: NearDuplicates) -> DataFrame:
    """All pairs of rows: those of similar classes and those within a class."""
    a = found.members.select(F.col("class_id").alias("id_a"), F.col("raw_id").alias("a"))
    b = found.members.select(F.col("class_id").alias("id_b"), F.col("raw_id").alias("b"))
    across = found.pairs.select("id_a", "id_b").join(a, "id_a").join(b, "id_b").select("a", "b")
    inside = a.join(b, F.col("id_a") == F.col("id_b")).where(F.col("a") < F.col("b")).select("a", "b")
    both = across.unionByName(inside)
    return both.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of the edges (id_a, id_b); root is the smallest node reachable.

    Alternates linking the larger neighbours and the smaller ones of each node to its smallest
    neighbour until nothing changes; every step is written to the shared folder.
    """
    now = cut(edges.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).where("u <> v").distinct(), "links")
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        new = cut(small, "links")
        if new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty():
            break
        now = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(chunks: DataFrame, found: NearDuplicates) -> DataFrame:
    """One row per row that takes part: raw_id, file_path, class_id, group_id, links (similar classes), copies (rows of the class).

    group_id is the smallest class id connected by links; a row without any is its own group.
    """
    roots = components(found.pairs)
    ends = found.pairs.select(F.col("id_a").alias("class_id")).unionByName(found.pairs.select(F.col("id_b").alias("class_id")))
    links = ends.groupBy("class_id").agg(F.count("*").alias("links"))
    copies = found.members.groupBy("class_id").agg(F.count("*").alias("copies"))
    classes = copies.join(links, "class_id", "left").join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    classes = classes.select("class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class_id").alias("group_id"))
    rows = found.members.join(classes, "class_id").join(chunks.select("raw_id", "file_path"), "raw_id")
    return rows.select("raw_id", "file_path", "class_id", "group_id", "links", "copies")
