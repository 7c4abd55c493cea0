"""Cutting documents into chunks: packing, word windows, merging of small chunks, section trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silexa.functions.arrays import listed
from silexa.functions.batches import by_text
from silexa.functions.text import LINE_ENDS, content_words, headings, lines, word_count, words
from silexa.operators.ordering import position_within, running_total
from silexa.session import cut

MOST_WORDS, LEAST_WORDS = 400, 50
LINE_END = re.compile(LINE_ENDS)
_LAST_END = re.compile(rf"(?:{LINE_ENDS})\Z")


def _step(n: int, state: int, limit: int) -> tuple[int, int]:
    """(new state, groups opened) of a block of size ``n``; the state is the sum of the open group, or limit + 1 if none is open."""
    if n > limit:
        return limit + 1, 1
    return (state + n, 0) if state + n <= limit else (n, 1)


def group_starts(sizes: Column, limit: int) -> Column:
    """For a list of sizes the number of the group of each: groups are filled in order up to ``limit``, and a size above it is a group of its own.

    One pass over each list, which has to fit into a task; ``pack_blocks`` is for lists of any length.
    """

    @F.pandas_udf("array<int>")
    def folded(lists: pd.Series) -> pd.Series:
        out = []
        for items in lists:
            state, group, row = limit + 1, -1, []
            for n in () if items is None else items:
                state, new = _step(int(n), state, limit)
                group += new
                row.append(group)
            out.append(row)
        return pd.Series(out, dtype=object)

    return folded(sizes)


_PIECES = "piece int, n_lines int, n_words int, text string"


def _line_pieces(text: str, limit: int) -> Iterator[tuple[int, int, str]]:
    held: list[str] = []
    total = 0
    for line in LINE_END.split(text):
        n = len(line.split())
        if held and (n > limit or total + n > limit):
            yield len(held), total, "\n".join(held)
            held, total = [], 0
        if n > limit:
            found = line.split()
            for k in range(0, n, limit):
                yield 1, min(limit, n - k), " ".join(found[k : k + limit])
        else:
            held.append(line)
            total += n
    if held:
        yield len(held), total, "\n".join(held)


def pack_lines(docs: DataFrame, key: str, text: str, limit: int = MOST_WORDS) -> DataFrame:
    """Lines of each text put together up to ``limit`` words: (key, piece, n_lines, n_words, text).

    A line of more words is cut into windows of ``limit`` words, which stand alone, joined by
    single blanks. Blank lines take part with no words; null and '' give no piece. One pass over
    each text, without a shuffle.
    """
    rows = docs.select(F.col(key), F.col(text)).where(F.length(F.col(text)) > 0)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_text(whole, 1)):
            at, out = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for k, piece in enumerate(_line_pieces(_LAST_END.sub("", t), limit)):
                    at.append(i)
                    out.append((k, *piece))
            columns = list(zip(*out)) or [()] * 4
            types = (pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(list(c), x) for c, x in zip(columns, types))], names=[key, "piece", "n_lines", "n_words", "text"])

    return rows.mapInArrow(run, f"`{key}` {kind}, {_PIECES}")


def windows(items: Column, size: int) -> Column:
    """Consecutive slices of a list."""
    n = F.ceil(F.size(items) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(items, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))


def word_windows(docs: DataFrame, key: str, text: str, size: int = 350) -> DataFrame:
    """Windows of ``size`` words, joined by single blanks; a text without words gives one empty window."""
    cut = F.transform(windows(words(F.col(text)), size), lambda w: F.array_join(w, " "))
    some = F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))
    return docs.select(F.col(key), F.posexplode(some).alias("window", "text"))


def _table(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For every state at the beginning the state at the end and the groups opened."""
    state, opened = np.arange(limit + 2), np.zeros(limit + 2, np.int64)
    for i, n in enumerate(sizes.tolist()):
        if n > limit:
            state[:] = limit + 1
            opened += 1
        else:
            fits = state + n <= limit
            state, opened = np.where(fits, state + n, n), opened + ~fits
        if (state == state[0]).all():  # from here on all go alike
            one, more = int(state[0]), 0
            for m in sizes[i + 1 :].tolist():
                one, new = _step(m, one, limit)
                more += new
            return np.full(limit + 2, one), opened + more
    return state, opened


def _first_rows(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows in order, their sizes, and where documents begin."""
    group = group.sort_by([("_none", "ascending"), ("_doc", "ascending"), ("_at", "ascending")])
    names = list(zip(group["_none"].to_pylist(), group["_doc"].to_pylist()))
    opens = np.array([i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)])
    return group, group["_size"].to_numpy(), opens


def pack_blocks(blocks: DataFrame, key: str, order: str, size: str, limit: int = MOST_WORDS) -> DataFrame:
    """(key, order, n_words, piece): the group of each block of a document when blocks are put together in order up to ``limit``.

    Blocks above the limit stand alone; a null size counts 0; blocks of a null key are one
    document. ``order`` has to be unique within a document.

    A document may hold any share of the rows: they are range-partitioned as numbers, without
    texts. All that a partition does to the rows behind it is a table from the sum of the group
    that is open before it to the one open after it, and the groups opened between; the tables, of
    ``limit`` entries each, are put together in the order of partitions, and a second pass numbers
    the rows.
    """
    rows = blocks.select(F.col(key), F.col(order), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("_size"))
    rows = rows.withColumns({"_none": F.col(key).isNull().cast("int"), "_doc": F.coalesce(F.col(key).cast("string"), F.lit("")), "_at": F.col(order)})
    parts = cut(rows.repartitionByRange("_none", "_doc", "_at").withColumn("_part", F.spark_partition_id()), "blocks")

    def told(group: pa.Table) -> pa.Table:
        part = group["_part"][0].as_py()
        group, sizes, opens = _first_rows(group)
        head_state, head_opened = _table(sizes[: opens[1]], limit)
        tail_state, tail_opened = (x[-1] for x in _table(sizes[opens[-2] :], limit))
        ends = [(group["_none"][i].as_py(), group["_doc"][i].as_py()) for i in (0, group.num_rows - 1)]
        return pa.table({
            "part": pa.array([part], pa.int32()), "none_first": pa.array([ends[0][0]], pa.int32()), "first": pa.array([ends[0][1]]), "none_last": pa.array([ends[1][0]], pa.int32()), "last": pa.array([ends[1][1]]),
            "state": pa.array([head_state.tolist()], pa.list_(pa.int64())), "opened": pa.array([head_opened.tolist()], pa.list_(pa.int64())), "tail_state": pa.array([int(tail_state)]), "tail_opened": pa.array([int(tail_opened)]),
        })

    kind = "part int, none_first int, first string, none_last int, last string, state array<bigint>, opened array<bigint>, tail_state bigint, tail_opened bigint"
    known = parts.groupBy("_part").applyInArrow(told, kind).orderBy("part").collect()  # one row of 2 x limit numbers per partition
    before: dict[int, tuple[int, int]] = {}
    state, opened, last = limit + 1, 0, None
    for r in known:
        if (r["none_first"], r["first"]) != last:
            state, opened = limit + 1, 0
        before[r["part"]] = (state, opened)
        if (r["none_first"], r["first"]) == (r["none_last"], r["last"]):
            state, opened = r["state"][state], opened + r["opened"][state]
        else:
            state, opened = r["tail_state"], r["tail_opened"]
        last = (r["none_last"], r["last"])

    def numbered(group: pa.Table) -> pa.Table:
        state, opened = before[group["_part"][0].as_py()]
        group, sizes, opens = _first_rows(group)
        fresh, piece = set(opens[1:].tolist()), []
        for i, n in enumerate(sizes.tolist()):
            if i in fresh:
                state, opened = limit + 1, 0
            state, new = _step(n, state, limit)
            opened += new
            piece.append(opened - 1)
        return group.select([key, order]).append_column("n_words", group["_size"].cast(pa.int32())).append_column("piece", pa.array(piece, pa.int32()))

    types = {c: rows.schema[c].dataType.simpleString() for c in (key, order)}
    return parts.groupBy("_part").applyInArrow(numbered, f"`{key}` {types[key]}, `{order}` {types[order]}, n_words int, piece int")


def merge_small(chunks: DataFrame, doc: str, order: str, least: int = LEAST_WORDS) -> DataFrame:
    """Chunks of each document after small ones have joined a neighbour: (doc, chunk_index, first, rows, n_words, section_path, text).

    A chunk under ``least`` content words joins the one before it; if the first group is still
    under it and another follows, it joins that one, whose section_path stays. The size of a
    merged chunk counts the words of all its texts less those of its first section_path. A
    document of one chunk is left as it is. Rows are numbered anew from 0. ``order`` has to be
    unique within a document; null documents are one document.

    Groups are runs between running totals over all rows, so a document of very many rows is
    spread over tasks; one task holds the texts of one merged chunk.
    """
    rows = chunks.select(doc, order, "section_path", F.coalesce("text", F.lit("")).alias("text"), word_count(F.col("text")).alias("_w"), content_words(F.col("text"), F.col("section_path")).alias("_c"))
    firsts = rows.groupBy(F.col(doc).alias("_d")).agg(F.min(order).alias("_o")).select("_d", "_o", F.lit(True).alias("_opens"))
    same = (F.col(order) == F.col("_o")) & F.col(doc).eqNullSafe(F.col("_d"))
    rows = rows.join(firsts, same, "left").withColumn("_opens", F.coalesce("_opens", F.lit(False))).drop("_o", "_d")
    rows = running_total(rows, [F.col(doc), F.col(order)], (F.col("_opens") | (F.col("_c") >= least)).cast("int"), "_g")

    head = F.min_by(F.struct("section_path", "_c", "_w"), order)
    groups = rows.groupBy("_g").agg(F.first(doc).alias(doc), F.max("_opens").alias("_opens"), F.sum("_w").alias("_w"), head.alias("_h"), F.min(order).alias("_first"), F.count("*").alias("rows"))
    size = F.col("_w") - F.col("_h._w") + F.col("_h._c")
    docs = groups.groupBy(doc).agg(F.min("_g").alias("_from"), F.count("*").alias("_n"), F.max(F.when(F.col("_opens"), size)).alias("_size"))
    docs = docs.select(F.col(doc).alias("_doc"), "_from", ((F.col("_size") < least) & (F.col("_n") > 1)).alias("_joins"))
    groups = groups.join(docs, F.col(doc).eqNullSafe(F.col("_doc")))
    moved = F.col("_joins") & F.col("_opens")
    groups = groups.select("_g", doc, (F.col("_g") + moved.cast("int")).alias("_m"), (F.col("_from") + F.col("_joins").cast("int")).alias("_from"), "_w", F.col("_h.section_path").alias("section_path"), F.col("_first"), "rows")

    last = F.max_by("section_path", "_g")
    whole = groups.groupBy("_m").agg(F.first(doc).alias(doc), F.first("_from").alias("_from"), F.min("_first").alias("first"), F.sum("rows").alias("rows"), F.sum("_w").alias("_w"), last.alias("section_path"))
    texts = rows.select("_g", order, "text").join(groups.select("_g", "_m"), "_g").groupBy("_m").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "text"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: x["text"]), "\n\n")
    index = (F.col("_m") - F.col("_from")).cast("int").alias("chunk_index")
    return whole.join(texts, "_m").select(doc, index, "first", "rows", (F.col("_w") - word_count(F.col("section_path"))).alias("n_words"), "section_path", text.alias("text"))


def subtree_words(nodes: DataFrame) -> DataFrame:
    """Words below each section: nodes (doc, path array, n_words own, title_words) with ``subtree``.

    Every node adds its own words to all its ancestors, and its title's to all but itself: each
    row is exploded by its depth, so the cost is linear in the tree and there is no recursion.
    """
    ups = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice(F.col("path"), F.lit(1), n))
    spread = nodes.select("doc", F.col("path").alias("_own"), "n_words", "title_words", F.explode(ups).alias("path"))
    share = F.col("n_words") + F.when(F.size("_own") > F.size("path"), F.col("title_words")).otherwise(0)
    return nodes.join(spread.groupBy("doc", "path").agg(F.sum(share).alias("subtree")), ["doc", "path"])


def tree_chunks(nodes: DataFrame, limit: int = MOST_WORDS) -> DataFrame:
    """How each section is emitted: 'whole' with all below it, 'own' blocks only, or 'inside' a larger whole.

    A subtree is never smaller than one below it, so a node is emitted whole just where it fits
    and its parent doesn't.
    """
    sized = subtree_words(nodes)
    parent = sized.select("doc", F.col("path").alias("_parent"), (F.col("subtree") <= limit).alias("_fits"))
    up = F.slice("path", F.lit(1), F.size("path") - 1)
    both = sized.withColumn("_parent", F.when(F.size("path") > 1, up)).join(parent, ["doc", "_parent"], "left")
    fits = F.col("subtree") <= limit
    how = F.when(fits & ~F.coalesce("_fits", F.lit(False)), "whole").when(fits, "inside").otherwise("own")
    return both.select("doc", "path", "n_words", "subtree", how.alias("emitted"))


def section_nodes(chunks: DataFrame, doc: str) -> DataFrame:
    """The tree of the sections of documents, from section paths: every prefix of a path is a node."""
    rows = chunks.select(F.col(doc).alias("doc"), headings(F.col("section_path")).alias("path"), F.greatest(content_words(F.col("text"), F.col("section_path")), F.lit(0)).alias("n"))
    rows = rows.where(F.size("path") > 0)
    ups = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.struct(F.slice(F.col("path"), F.lit(1), n).alias("path"), F.when(n == F.size("path"), F.col("n")).otherwise(0).alias("n")))
    flat = rows.select("doc", F.explode(ups).alias("u")).select("doc", "u.path", "u.n")
    return flat.groupBy("doc", "path").agg(F.sum("n").alias("n_words")).withColumn("title_words", word_count(F.element_at("path", -1)))


def line_runs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Blocks of consecutive non-blank lines: (key, run, first_line, n_lines).

    Lines are numbered within their row, so there is no shuffle; one pass over each text.
    """
    rows = docs.select(F.col(key), F.col(text)).where(F.length(F.col(text)) > 0)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_text(whole, 1)):
            at, out = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                blank = np.array([True] + [not x.strip() for x in LINE_END.split(_LAST_END.sub("", t))] + [True])
                turns = np.flatnonzero(blank[1:] != blank[:-1])
                at += [i] * (len(turns) // 2)
                out += [(k, first, last - first) for k, (first, last) in enumerate(turns.reshape(-1, 2).tolist(), 1)]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(list(c), x) for c, x in zip(columns, (pa.int32(), pa.int32(), pa.int64())))], names=[key, "run", "first_line", "n_lines"])

    return rows.mapInArrow(run, f"`{key}` {kind}, run int, first_line int, n_lines bigint")


def renumber(chunks: DataFrame, doc: str, *order: str) -> DataFrame:
    """Adds ``position``: 0, 1, 2, ... within each document. The order has to be total."""
    return position_within(chunks, doc, [F.col(c) for c in order])


def refs_of(chunks: DataFrame, column: str) -> DataFrame:
    """Edges from chunks to what they refer to: (chunk, position, target)."""
    return chunks.select(F.col("chunk_id"), F.posexplode(listed(F.col(column))).alias("position", "target")).where("target IS NOT NULL")
