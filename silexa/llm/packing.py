"""Texts assigned to containers of fixed capacity, with as few containers as possible."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silexa.functions.pywords import white_count
from silexa.llm.splitting import one_limit
from silexa.session import cut

ITEMS = "raw_id bigint, doc_type string, capacity int, piece_no int, first_word int, n_words int"
#: Items of one length and bucket that one task ranks.
RANKED = 200_000


def minimum_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (how often, {length: items}) that use up the multiset ``counts`` of lengths.

    Each pattern holds the longest item left and the multiset of others that fills the rest of
    the container best: a subset-sum over the lengths, with counts split into powers of two, held
    as the bits of one integer and traced back to counts. A pattern is taken as often as the
    counts allow, so the work depends on the number of lengths and not on the number of items.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        longest = max(left)
        room = capacity - longest
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for n in sorted((n for n in left if n <= room), reverse=True):
            have, k = min(left[n] - (n == longest), room // n), 1
            while have > 0:
                take = min(k, have)
                steps.append((n, take, reach))
                reach |= (reach << (n * take)) & mask
                have, k = have - take, 2 * k
            if reach >> room & 1:
                break
        at, used = reach.bit_length() - 1, {longest: 1}
        for n, take, before in reversed(steps):
            if not before >> at & 1:
                at -= n * take
                used[n] = used.get(n, 0) + take
        times = min(left[n] // c for n, c in used.items())
        out.append((times, used))
        for n, c in used.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
    return out


def segments(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int]]:
    """(length, first rank, items per container, first container): where the items of a length go, in order of rank."""
    seen: dict[int, int] = {}
    base, out = 0, []
    for times, used in patterns:
        for n, per in used.items():
            out.append((n, seen.get(n, 0), per, base))
            seen[n] = seen.get(n, 0) + times * per
        base += times
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw_id, kind, text, capacity in zip(*(c.to_pylist() for c in batch.columns)):
            n = white_count(text)
            if not capacity or n <= capacity:
                rows.append((raw_id, kind, capacity, 0, 0, n))
            else:
                rows += [(raw_id, kind, capacity, k, k * capacity, min(capacity, n - k * capacity)) for k in range(-(-n // capacity))]
        types = [pa.int64(), pa.string(), *[pa.int32()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)], names=[x.split()[0] for x in ITEMS.split(", ")])


def _plan(table: pa.Table) -> pa.Table:
    kind, capacity = table["doc_type"][0].as_py(), table["capacity"][0].as_py()
    counts = dict(zip(table["n_words"].to_pylist(), table["items"].to_pylist()))
    rows = segments(minimum_slack(counts, capacity))
    n, start, per, base = (list(x) for x in zip(*rows))
    return pa.table({"doc_type": pa.array([kind] * len(n), pa.string()), "n_words": pa.array(n, pa.int32()), "start": pa.array(start, pa.int64()), "per": pa.array(per, pa.int64()), "base": pa.array(base, pa.int64())})


def _assign(plan: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, lengths = batch.column("doc_type").to_pylist(), batch.column("n_words").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            where = np.zeros(len(ranks), np.int64)
            rows: dict[tuple[str, int], list[int]] = {}
            for i, key in enumerate(zip(kinds, lengths.tolist())):
                rows.setdefault(key, []).append(i)
            for key, at in rows.items():
                start, per, base = plan[key]
                k = np.searchsorted(start, ranks[at], side="right") - 1
                where[at] = base[k] + (ranks[at] - start[k]) // per[k]
            kept = batch.select(["doc_type", "raw_id", "piece_no", "first_word", "n_words", "capacity"])
            yield kept.append_column("container", pa.array(where))

    return run


def fill_containers(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """Containers of ``container_words`` words for the texts of each doc_type.

    Rows: doc_type, container (numbered from 0 within the doc_type), raw_id, piece_no, first_word
    and n_words (the part of the text: all of it, unless the text alone exceeds the capacity; then
    pieces of the capacity and a rest), capacity.

    Only the histogram of lengths decides the containers: at most ``capacity`` lengths per
    doc_type, whatever the number of texts, so the plan is made in one small task per doc_type
    and its segments are sent to all tasks. The texts take their places by rank within their
    length; ranks are counted in buckets of bounded size with a prefix sum of bucket sizes, so
    no length is gathered in one task.

    Defined results: texts without a word (null, empty, blank) and rows whose doc_type is null or
    has no capacity take no room: container is null. Repeated rows are items each. Columns of
    other names are ignored.
    """
    rows = chunks.select("raw_id", "doc_type", "text")
    limit = one_limit(limits).select("doc_type", F.col("_container_words").alias("capacity"))
    rows = rows.join(limit, "doc_type", "left").select("raw_id", "doc_type", "text", "capacity")
    items = cut(rows.mapInArrow(_items, ITEMS), "items")
    sized = items.where((F.col("n_words") > 0) & (F.col("capacity") > 0))
    histogram = sized.groupBy("doc_type", "capacity", "n_words").agg(F.count("*").alias("items"))
    made = histogram.groupBy("doc_type").applyInArrow(_plan, "doc_type string, n_words int, start bigint, per bigint, base bigint")
    plan: dict[tuple[str, int], list[tuple[int, int, int]]] = {}
    for r in made.collect():  # bounded by the capacities: see minimum_slack
        plan.setdefault((r["doc_type"], r["n_words"]), []).append((r["start"], r["per"], r["base"]))
    table = {key: tuple(np.array(x, np.int64) for x in zip(*sorted(v))) for key, v in plan.items()}

    buckets = max(1, -(-items.count() // RANKED))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("raw_id", "piece_no"), F.lit(buckets)).cast("int"))
    keys = ["doc_type", "n_words"]
    sizes = sized.groupBy(*keys, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy(*keys, "bucket").orderBy("raw_id", "piece_no")
    ranked = sized.withColumn("k", F.row_number().over(within) - 1).join(offsets, [*keys, "bucket"])
    ranked = ranked.select("doc_type", "raw_id", "piece_no", "first_word", "n_words", "capacity", (F.col("k") + F.col("offset")).alias("rank"))
    schema = "doc_type string, raw_id bigint, piece_no int, first_word int, n_words int, capacity int, container bigint"
    placed = ranked.mapInArrow(_assign(table), schema)
    rest = items.where(~F.coalesce((F.col("n_words") > 0) & (F.col("capacity") > 0), F.lit(False)))
    return placed.unionByName(rest.withColumn("container", F.lit(None).cast("bigint")).select(placed.columns))


def container_use(filled: DataFrame) -> DataFrame:
    """Words, items and free room of every container."""
    used = filled.where(F.col("container").isNotNull()).groupBy("doc_type", "container")
    return used.agg(F.sum("n_words").alias("words"), F.count("*").alias("items"), (F.max("capacity") - F.sum("n_words")).alias("free_words"))
