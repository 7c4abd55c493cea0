"""The most similar vectors of vectors, by hashing with several probes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Width of a hash slot for unit vectors, slots that one hash tells apart on average, and 1 over the chance that two vectors share one.
WIDTH, SLOTS, SHARED = 2.0, 3.3, 2.06
#: Vectors aimed at in the cell of a vector and in a region; a region of more than HEAVY is cut further.
CELL, REGION, HEAVY = 300, 128_000, 256_000
#: Vectors that ask in one part of a region; with more of them it is stored once for each part.
ASKED = 500_000
#: Vectors by whose neighbours the reach of the probes is fitted, and made-up pairs for a given cosine.
SAMPLE, PAIRED = 256, 20_000
#: Costs of cells computed at a time, and pairs compared exactly at a time.
COSTS, PAIRS = 8_000_000, 200_000
SENT = "place int, region bigint, block int, part int, asks boolean, id bigint, vector binary"
HITS = "id bigint, other bigint, similarity double"


class Hashes:
    """The p-stable hashes of one table: ``k`` slots floor((a.x + b) / WIDTH) with Gaussian a; the cell is the tuple of slots.

    A neighbour lies in another slot than one's own the more likely the nearer the vector is to
    that side. The cost of a cell is the sum of squared distances from the vector's values to the
    slots of the cell; cells are promising in the order of their costs.
    """

    def __init__(self, seed: int, dimension: int, k: int, depth: int) -> None:
        rng = np.random.default_rng(seed)
        self.k, self.depth = k, depth
        self.a = rng.standard_normal((dimension, k)).astype(np.float32)
        self.b = rng.uniform(0, WIDTH, k).astype(np.float32)
        self.weights = rng.integers(1 << 20, 1 << 58, k) | 1

    def values(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.a + self.b) / np.float32(WIDTH)

    def none(self) -> list[np.ndarray]:
        """No heavy prefix at any level."""
        return [np.zeros(0, np.int64)] * (self.k - self.depth + 1)

    def prefixes(self, slots: np.ndarray) -> np.ndarray:
        """Keys of the first depth, depth + 1, ..., k slots."""
        return np.cumsum(slots * self.weights, axis=-1)[..., self.depth - 1 :]

    def home(self, slots: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
        """The region of each cell: its shortest prefix that isn't heavy; that of all slots if all are."""
        prefixes = self.prefixes(slots)
        out = prefixes[:, -1].copy()
        for level in range(prefixes.shape[1] - 2, -1, -1):
            out = np.where(np.isin(prefixes[:, level], heavy[level]), out, prefixes[:, level])
        return out

    def costs(self, values: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Of the cells ``slots`` for vectors with ``values``, row by row."""
        outside = np.maximum(0, np.maximum(slots - values, values - slots - 1)) * np.float32(WIDTH)
        return (outside**2).sum(axis=-1)

    def reached(self, values: np.ndarray, reach: float, heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, region, first ``depth`` slots of the region) of all regions whose slots cost no more than ``reach``, however many."""
        who, key, cost = np.arange(len(values)), np.zeros(len(values), np.int64), np.zeros(len(values), np.float32)
        base, far = key, math.ceil(math.sqrt(reach) / WIDTH)
        steps = np.arange(-far, far + 1)
        done = []
        for h in range(self.k):
            z = values[who, h][:, None]
            slot = np.floor(z) + steps
            more = cost[:, None] + (np.maximum(0, np.maximum(slot - z, z - slot - 1)) * np.float32(WIDTH)) ** 2
            i, j = np.nonzero(more <= reach)
            who, base, key, cost = who[i], base[i], key[i] + slot[i, j].astype(np.int64) * self.weights[h], more[i, j]
            level = h + 1 - self.depth
            if level == 0:
                base = key
            if level >= 0:
                on = np.isin(key, heavy[level]) if h + 1 < self.k else np.zeros(len(key), bool)
                done.append((who[~on], key[~on], base[~on]))
                who, base, key, cost = who[on], base[on], key[on], cost[on]
        return tuple(np.concatenate(x) for x in zip(*done))


def _vectors(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column whose lists have one length."""
    offsets = column.offsets.to_numpy()
    raw = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].reshape(len(column), -1).astype(np.float64)
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


def usable(vector: Column, dimension: int) -> Column:
    """Of that many finite entries, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == dimension) & finite & F.exists(vector, lambda x: x != 0)


def reach_for_cosine(tables: list[Hashes], cosine: float, target: float) -> float:
    """The cost up to which cells have to be visited to find a share ``target`` of the pairs at this cosine, in any table; found by made-up pairs."""
    rng = np.random.default_rng(1)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, PAIRED, tables[0].a.shape[0])))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * y / np.linalg.norm(y, axis=1, keepdims=True)
    return _reach(tables, x.astype(np.float32), y.astype(np.float32), target)


def _reach(tables: list[Hashes], x: np.ndarray, y: np.ndarray, target: float) -> float:
    least = np.full(len(x), np.inf, np.float32)
    for table in tables:
        least = np.minimum(least, table.costs(table.values(x), np.floor(table.values(y))))
    return float(np.sort(least)[max(0, math.ceil(target * len(least)) - 1)]) + 1e-6


def _best_of_all(asked: Broadcast, k: int):
    """Per task the ``k`` best of its rows for each sampled vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = asked.value
        score, found = np.full((len(names), 0), 0, np.float32), np.zeros((len(names), 0, queries.shape[1]), np.float32)
        for whole in batches:
            for low in range(0, whole.num_rows, 4000):
                batch = whole.slice(low, 4000)
                unit, ids = _vectors(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
                new = queries @ unit.T
                new[names[:, None] == ids[None, :]] = -2
                top = np.argsort(-new, axis=1, kind="stable")[:, :k]
                score = np.concatenate([score, np.take_along_axis(new, top, axis=1)], axis=1)
                found = np.concatenate([found, unit[top]], axis=1)
                keep = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, found = np.take_along_axis(score, keep, axis=1), np.take_along_axis(found, keep[:, :, None], axis=1)
        if score.shape[1]:
            n = score.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, n)), pa.array(score.ravel().astype(np.float64)), pa.array([v.tobytes() for v in found.reshape(-1, queries.shape[1])], pa.binary())], names=["id", "score", "vector"])

    return run


def reach_for_neighbours(good: DataFrame, tables: list[Hashes], k: int, target: float) -> tuple[float, int]:
    """The cost up to which cells have to be visited to find a share ``target`` of the ``k`` nearest, and how many pairs told it.

    Fitted on SAMPLE asking vectors, whose true neighbours among all rows one exact pass finds.
    """
    rows = good.where("asks").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).select("id", "vector").toArrow().combine_chunks()
    if not rows.num_rows:
        return 0.0, 0
    names, queries = rows["id"].to_numpy(), _vectors(rows["vector"].chunk(0))
    asked = good.sparkSession.sparkContext.broadcast((names, queries))
    best = good.select("id", "vector").mapInArrow(_best_of_all(asked, k), "id bigint, score double, vector binary")
    order = Window.partitionBy("id").orderBy(F.desc("score"))
    near = best.withColumn("n", F.row_number().over(order)).where((F.col("n") <= k) & (F.col("score") > -1.5)).select("id", "vector").toArrow()  # SAMPLE x k rows
    if not near.num_rows:
        return 0.0, 0
    at = {int(i): n for n, i in enumerate(names)}
    x = queries[[at[i] for i in near["id"].to_pylist()]]
    y = np.frombuffer(b"".join(near["vector"].to_pylist()), np.float32).reshape(len(x), -1)
    return _reach(tables, x, y, target), len(x)


def _tallied(tables: list[Hashes], reach: float, crowded: list[np.ndarray] | None = None):
    """How many vectors are stored (level 0) and how many ask (level -1) under each first ``depth`` slots; of the ``crowded`` ones, under each longer prefix."""

    def counts(t: int, table: Hashes, unit: np.ndarray, asks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        values = table.values(unit)
        prefixes = table.prefixes(np.floor(values).astype(np.int64))
        if crowded is None:
            yield 0, prefixes[:, 0]
            yield -1, table.reached(values[asks], reach, table.none())[1]
        else:
            inside = prefixes[np.isin(prefixes[:, 0], crowded[t])]
            yield from ((level, inside[:, level]) for level in range(1, prefixes.shape[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 4000):
                batch = whole.slice(low, 4000)
                unit, asks = _vectors(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                for t, table in enumerate(tables):
                    for level, keys in counts(t, table, unit, asks):
                        keys, n = np.unique(keys, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), t, np.int32)), pa.array(np.full(len(n), level, np.int32)), pa.array(keys), pa.array(n)], names=["place", "level", "prefix", "n"])

    return run


class Layout:
    """Of a table: the heavy prefixes by level, the cells stored in several blocks, and the first slots stored several times for those that ask there.

    There are at most n / HEAVY of each of the former, and one for ASKED that ask of the latter.
    """

    def __init__(self, heavy: list[np.ndarray], blocks: dict[int, int], parts: dict[int, int]) -> None:
        self.heavy, self.blocks, self.parts = heavy, blocks, parts

    @staticmethod
    def numbers(held: dict[int, int], keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), np.int64)
        if held:
            for i in np.flatnonzero(np.isin(keys, np.fromiter(held, np.int64, len(held)))):
                out[i] = held[int(keys[i])]
        return out


def _laid_out(good: DataFrame, tables: list[Hashes], reach: float) -> list[Layout]:
    kind, rows = "place int, level int, prefix bigint, n bigint", good.select("vector", "asks")

    def many(crowded: list[np.ndarray] | None) -> list:
        tally = rows.mapInArrow(_tallied(tables, reach, crowded), kind).groupBy("place", "level", "prefix").agg(F.sum("n").alias("n"))
        return tally.where(F.col("n") > F.when(F.col("level") < 0, ASKED).otherwise(HEAVY)).collect()  # at most n / HEAVY a level

    found = many(None)
    first = [np.array([r["prefix"] for r in found if (r["place"], r["level"]) == (t, 0)], np.int64) for t in range(len(tables))]
    if any(len(x) for x in first) and tables[0].k > tables[0].depth:
        found += many(first)
    out = []
    for t, table in enumerate(tables):
        mine = [r for r in found if r["place"] == t]
        last = table.k - table.depth
        heavy = [np.array([r["prefix"] for r in mine if r["level"] == level], np.int64) for level in range(last + 1)]
        out.append(Layout(heavy, {r["prefix"]: -(-r["n"] // HEAVY) for r in mine if r["level"] == last}, {r["prefix"]: -(-r["n"] // ASKED) for r in mine if r["level"] == -1}))
    return out


def _sent(tables: list[Hashes], layouts: Broadcast, reach: float):
    """The rows of the vectors: in their own region, and in each region that they ask in."""

    def pack(t, layout: Layout, unit, ids, who, region, base, asks: bool) -> pa.RecordBatch:
        blocks, parts = layout.numbers(layout.blocks, region), layout.numbers(layout.parts, base)
        copies, own = (blocks, parts) if asks else (parts, blocks)
        at = np.repeat(np.arange(len(who)), copies)
        each = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
        mixed = (ids[who].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        mine = (mixed % own.astype(np.uint64)).astype(np.int64)[at]
        block, part = (each, mine) if asks else (mine, each)
        n, width = len(at), unit.shape[1] * 4
        raw = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(unit[who[at]]))])
        columns = [pa.array(np.full(n, t, np.int32)), pa.array(region[at]), pa.array(block.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(np.full(n, asks)), pa.array(ids[who[at]]), raw]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2000):
                batch = whole.slice(low, 2000)
                unit, ids = _vectors(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
                asks = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False).astype(bool))
                for t, (table, layout) in enumerate(zip(tables, layouts.value)):
                    values = table.values(unit)
                    slots = np.floor(values).astype(np.int64)
                    yield pack(t, layout, unit, ids, np.arange(len(ids)), table.home(slots, layout.heavy), table.prefixes(slots)[:, 0], False)
                    if len(asks):
                        who, region, base = table.reached(values[asks], reach, layout.heavy)
                        yield pack(t, layout, unit, ids, asks[who], region, base, True)

    return run


class _Region:
    """The vectors stored in one block of a region, cell by cell."""

    def __init__(self, table: Hashes, ids: np.ndarray, unit: np.ndarray) -> None:
        self.table = table
        slots = np.floor(table.values(unit)).astype(np.int64)
        key = table.prefixes(slots)[:, -1]
        order = np.argsort(key, kind="stable")
        key = key[order]
        self.ids, self.unit = ids[order], unit[order]
        self.first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.stop = np.r_[self.first[1:], len(key)]
        cells = slots[order][self.first]
        self.low = cells.min(axis=0)
        self.many = cells.max(axis=0) - self.low + 1
        starts = np.cumsum(self.many) - self.many
        self.which = np.zeros((len(cells), int(self.many.sum())), np.float32)
        np.put_along_axis(self.which, cells - self.low + starts, 1.0, axis=1)

    def costs(self, unit: np.ndarray) -> np.ndarray:
        """Of all cells for all vectors that ask."""
        values = self.table.values(unit)
        each = []
        for h in range(self.table.k):
            slot, z = self.low[h] + np.arange(self.many[h]), values[:, h][:, None]
            each.append((np.maximum(0, np.maximum(slot - z, z - slot - 1)) * np.float32(WIDTH)) ** 2)
        return np.concatenate(each, axis=1).astype(np.float32) @ self.which.T

    def step(self) -> int:
        return max(1, COSTS // len(self.first))

    def search(self, ids: np.ndarray, unit: np.ndarray, reach: float, k: int, least: float | None) -> pa.RecordBatch:
        """The best ``k`` among the cells within reach for each vector that asks, compared exactly."""
        asker, other, value, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], 0
        cell, who = np.nonzero(self.costs(unit).T <= reach + 1e-5)
        bounds = np.searchsorted(cell, np.arange(len(self.first) + 1))
        for c in np.flatnonzero(bounds[1:] > bounds[:-1]):
            every, low_d, high_d = who[bounds[c] : bounds[c + 1]], self.first[c], self.stop[c]
            d = self.unit[low_d:high_d]
            some_at_once = max(1, COSTS // len(d))
            for low in range(0, len(every), some_at_once):
                some = every[low : low + some_at_once]
                score = unit[some] @ d.T
                if least is not None:
                    hits = np.flatnonzero(score.ravel() >= least - 1e-4)
                elif len(d) > k + 1:
                    # all that may be among the k + 1 best, however many tie: the exact comparison tells them apart
                    hits = np.flatnonzero((score >= np.partition(score, len(d) - k - 1, axis=1)[:, len(d) - k - 1, None] - 1e-4).ravel())
                else:
                    hits = np.arange(score.size)
                for piece in range(0, len(hits), PAIRS):
                    i, j = np.divmod(hits[piece : piece + PAIRS], len(d))
                    i, j = some[i], j + low_d
                    differ = ids[i] != self.ids[j]
                    i, j = i[differ], j[differ]
                    exact = np.einsum("ij,ij->i", unit[i].astype(np.float64), self.unit[j].astype(np.float64))
                    if least is not None:
                        i, j, exact = i[exact >= least], j[exact >= least], exact[exact >= least]
                    asker.append(i)
                    other.append(j)
                    value.append(exact)
                    held += len(i)
                    if held > PAIRS:  # no more than the best are kept of however many
                        asker, other, value = ([x] for x in self.best(asker, other, value, k))
                        held = 0
        a, o, v = self.best(asker, other, value, k)
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(self.ids[o]), pa.array(v)], names=["id", "other", "similarity"])

    def best(self, asker: list, other: list, value: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, o, v = np.concatenate(asker), np.concatenate(other), np.concatenate(value)
        order = np.lexsort((self.ids[o], -v, a))
        sorted_ = a[order]
        first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
        kept = order[rank < k]
        return a[kept], o[kept], v[kept]


def _searched(tables: list[Hashes], reach: float, k: int, least: float | None):
    """Over rows sorted by region: holds the vectors stored in one block of a region, while those that ask there stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, region, stored, asking, held = None, None, [], [], 0

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal region, held
            if asking and (region or stored):
                if region is None:
                    region = _Region(tables[now[0]], *(np.concatenate(x) for x in zip(*stored)))
                    stored.clear()
                ids, unit = (np.concatenate(x) for x in zip(*asking))
                for low in range(0, len(ids), region.step()):
                    yield region.search(ids[low : low + region.step()], unit[low : low + region.step()], reach, k, least)
            asking.clear()
            held = 0

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)], axis=1)
            ids, raw = batch.column(5).to_numpy(zero_copy_only=False), batch.column(6)
            start = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
            unit = np.frombuffer(raw.buffers()[2], np.float32, n * tables[0].a.shape[0], int(start)).reshape(n, -1)
            opens = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for low, high in zip(opens.tolist(), [*opens[1:].tolist(), n]):
                here = tuple(keys[low, :4].tolist())
                if here != now:
                    yield from answer()
                    now, region = here, None
                    stored.clear()
                (asking if keys[low, 4] else stored).append((ids[low:high].copy(), unit[low:high].copy()))
                held += (high - low) if keys[low, 4] else 0
                if held >= 20_000:
                    yield from answer()
        yield from answer()

    return run


def nearest(chunks: DataFrame, k: int = 5, queries: Column | None = None, least: float | None = None, tables: int = 1, recall: float = 0.95, hashes: int | None = None, dimension: int = 64, seed: int = 7) -> DataFrame:
    """(id, other, similarity, rank): the ``k`` vectors of highest cosine for every vector that meets ``queries`` (all of them by default).

    Every usable vector is stored in the cell of its hash values in each table. A query visits
    cells in the order of their estimated success, up to a cost at which a share ``recall`` of the
    neighbours is found, and is compared exactly with all vectors there; the lists of tables and
    cells, also of those that found the pair from the other side, are merged and ranked; ties go
    to the smaller id. The cost is fitted anew for every collection, so recall doesn't fall with
    its size: on the true neighbours of SAMPLE queries among all rows or, where ``least`` leaves
    out pairs below a cosine and makes the search far cheaper, on made-up pairs of that cosine.
    Neither cells nor regions that are visited have a cap.

    The number of hashes grows with the logarithm of the number of vectors, so cells keep their
    size. Cells are shuffled as regions (their first hashes), to which a vector is sent once for all
    cells that it visits there. Regions of more than HEAVY vectors are cut by further hashes, and
    single cells of more into blocks, each compared with all that ask; regions in which more than
    ASKED ask are stored in several parts. A task holds one block and lets those that ask stream by.

    Defined results: vectors that are null, of another length, not finite or all zero take no
    part and have no row, neither have vectors without any candidate; repeated rows are
    neighbours of each other; columns of other names are ignored. The README has measured recall.
    """
    asks = queries if queries is not None else F.lit(True)
    good = chunks.select(F.col("chunk_id").alias("id"), "vector", F.coalesce(asks, F.lit(False)).alias("asks"))
    good = good.where(F.col("id").isNotNull() & usable(F.col("vector"), dimension)).select("id", "vector", "asks")
    n = max(1, good.count())
    many = hashes or max(2, round(math.log(max(1, n / CELL)) / math.log(SHARED)))
    depth = min(many, max(1, round(math.log(max(1, n / REGION)) / math.log(SLOTS))))
    made = [Hashes(seed + t, dimension, many, depth) for t in range(tables)]
    reach = reach_for_neighbours(good, made, k, recall)[0] if least is None else reach_for_cosine(made, least, recall)
    layouts = chunks.sparkSession.sparkContext.broadcast(_laid_out(good, made, reach))

    sent = good.mapInArrow(_sent(made, layouts, reach), SENT)
    place = ["place", "region", "block", "part"]
    hits = sent.repartition(*place).sortWithinPartitions(*place, "asks").mapInArrow(_searched(made, reach, k, least), HITS)
    if queries is None:
        hits = hits.unionByName(hits.select(F.col("other").alias("id"), F.col("id").alias("other"), "similarity"))
    best = hits.groupBy("id", "other").agg(F.max("similarity").alias("similarity"))
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "other")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def similar_pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b): pairs of which one is a neighbour of the other."""
    return found.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
