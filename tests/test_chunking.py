from __future__ import annotations

import random

from pyspark.sql import functions as F

from silexa.operators import chunking
from silexa.sources.trees import Block, Refs, Section, chunks_of, line_pieces, merged, packed, subtree_words


def _words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def _groups(sizes, limit):
    out, group, total, is_open = [], -1, 0, False
    for n in sizes:
        if n > limit:
            group, total, is_open = group + 1, n, False
        elif is_open and total + n <= limit:
            total += n
        else:
            group, total, is_open = group + 1, n, True
        out.append(group)
    return out


def test_group_starts_equals_a_fold(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0, 0, 1, 3, 5, 9, 10, 11, 30]) for _ in range(rng.randint(0, 25))]) for i in range(300)]
    got = spark.createDataFrame(rows, "i int, s array<int>").select("i", chunking.group_starts(F.col("s"), 10).alias("g")).collect()
    assert {r["i"]: r["g"] for r in got} == {i: _groups(s, 10) for i, s in rows}
    flat = spark.createDataFrame([(i, k, n) for i, s in rows for k, n in enumerate(s)], "doc int, k int, n int")
    packed_rows = chunking.pack_blocks(flat, "doc", "k", "n", 10).collect()
    assert {(r["doc"], r["k"]): r["piece"] for r in packed_rows} == {(i, k): g for i, s in rows for k, g in enumerate(_groups(s, 10))}


def test_line_pack_equals_python(spark):
    rng = random.Random(2)
    texts = ["\n".join(_words(rng.choice([0, 1, 4, 9, 25])) for _ in range(rng.randint(1, 9))) for _ in range(60)] + [None, "", _words(37), "a b\r\nc"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "raw_id int, text string, piece string")
    got: dict[int, list[str]] = {}
    for r in chunking.pack_lines(rows, "raw_id", "text", 10).orderBy("raw_id", "piece").collect():
        got.setdefault(r["raw_id"], []).append(r["text"])
    assert got == {i: p for i, t in enumerate(texts) if t and (p := [b.text for b in line_pieces(Block(t), 10)])}


def test_word_windows(spark):
    rows = spark.createDataFrame([(1, _words(7)), (2, ""), (3, None), (4, _words(6))], "i int, t string")
    got = {}
    for r in chunking.word_windows(rows, "i", "t", 3).orderBy("i", "window").collect():
        got.setdefault(r["i"], []).append(len(r["text"].split()))
    assert got == {1: [3, 3, 1], 2: [0], 3: [0], 4: [3, 3]}


def test_merge_small_equals_a_fold(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for doc in range(120):
        chunks = []
        for k in range(rng.randint(1, 9)):
            path = rng.choice(["A", "A > B c", ""])
            body = _words(rng.choice([0, 2, 8, 12, 30]), f"d{doc}c{k}_")
            chunks.append((path, f"{path}\n\n{body}" if path else body, Refs()))
        rows += [(doc, k, p, t, "c") for k, (p, t, _) in enumerate(chunks)]
        want[doc] = [(k, p, t) for k, (p, t, _) in enumerate(merged(chunks, 10))]
    frame = spark.createDataFrame(rows, "doc int, k int, section_path string, text string, rows string")
    got: dict[int, list] = {}
    for r in chunking.merge_small(frame, "doc", "k", 10).orderBy("doc", "chunk_index").collect():
        got.setdefault(r["doc"], []).append((r["chunk_index"], r["section_path"], r["text"]))
    assert got == want
    assert chunking.merge_small(frame.limit(0), "doc", "k").count() == 0


def _random_tree(rng, depth=0):
    title = f"t{rng.randint(0, 10**9)}" + (" more" if rng.random() < 0.3 else "")
    blocks = [Block(_words(rng.choice([1, 5, 20, 60]))) for _ in range(rng.randint(0, 3))]
    return Section(title, blocks, [_random_tree(rng, depth + 1) for _ in range(rng.randint(0, 3) if depth < 3 else 0)])


def test_tree_chunks_equals_recursion(spark):
    rng = random.Random(4)
    nodes, want = [], {}

    def walk(doc, section, path, emitted):
        fits = subtree_words(section) <= 100
        how = "inside" if emitted else "whole" if fits else "own"
        nodes.append((doc, path, sum(len(b.text.split()) for b in section.blocks), len(section.title.split())))
        want[doc, tuple(path)] = (subtree_words(section), how)
        for c in section.children:
            walk(doc, c, [*path, c.title], emitted or fits)

    for doc in range(60):
        tree = _random_tree(rng)
        walk(str(doc), tree, [tree.title], False)
    frame = spark.createDataFrame(nodes, "doc string, path array<string>, n_words long, title_words int")
    assert {(r["doc"], tuple(r["path"])): (r["subtree"], r["emitted"]) for r in chunking.tree_chunks(frame, 100).collect()} == want


def test_line_runs(spark):
    rows = spark.createDataFrame([(1, "a\nb\n\n \nc\n"), (2, ""), (3, None), (4, "\n\nx")], "i int, t string")
    got = sorted((r["i"], r["run"], r["first_line"], r["n_lines"]) for r in chunking.line_runs(rows, "i", "t").collect())
    assert got == [(1, 1, 0, 2), (1, 2, 4, 1), (4, 1, 2, 1)]


def test_trees_to_chunks():
    small = Section("Root", [Block(_words(20))], [Section("One", [Block(_words(20))]), Section("Two", [Block(_words(20))])])
    rows = chunks_of(small, "p")
    assert len(rows) == 1 and "One\n\n" in rows[0]["text"] and rows[0]["section_path"] == "Root"
    large = Section("Root", [Block(_words(100), Refs(symbols=["s"]))], [Section("One", [Block(_words(300), Refs(files=["f"]))]), Section("Two", [Block(_words(300))])])
    rows = chunks_of(large, "p")
    assert [r["section_path"] for r in rows] == ["Root", "Root > One", "Root > Two"] and [r["chunk_index"] for r in rows] == [0, 1, 2]
    assert rows[0]["symbol_refs"] == ["s"] and rows[1]["file_refs"] == ["f"]
    table = "\n".join(_words(11) for _ in range(41))
    assert len(packed([Block(table, atomic=True)], 400)) == 1 and len(packed([Block(table)], 400)) > 1
    assert [b.text for b in packed([Block("a"), Block(""), Block(_words(9)), Block("b")], 10)] == [f"a\n\n\n\n{_words(9)}", "b"]
    tail = [("A", f"A\n\n{_words(60)}", Refs(symbols=["x"])), ("B", "B\n\ntiny", Refs(symbols=["y", "x"]))]
    assert merged(tail, 50)[0][2].symbols == ["x", "y"] and len(merged(tail, 50)) == 1
    head = [("A > very long trail of words", "A > very long trail of words\n\ntiny", Refs()), ("B", f"B\n\n{_words(60)}", Refs())]
    assert [r[0] for r in merged(head, 50)] == ["B"] and merged(tail[1:], 50) == tail[1:]
    assert chunks_of(Section("", [Block("  ")]), "p") == []


def test_pack_blocks_over_many_partitions(spark):
    rng = random.Random(9)
    docs = ["a"] * 700 + ["b"] * 5 + [None] * 90 + ["c"] * 40
    at: dict = {}
    rows = []
    for d in docs:
        rows.append((d, at.setdefault(d, 0), rng.choice([0, 1, 3, 5, 9, 10, 11, 30])))
        at[d] += 1
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc string, k int, n int").repartition(7)
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the small partitions apart
    try:
        got = {(r["doc"], r["k"]): r["piece"] for r in chunking.pack_blocks(frame, "doc", "k", "n", 10).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    for d in {d for d, *_ in rows}:
        sizes = [n for _, n in sorted((k, n) for x, k, n in rows if x == d)]
        assert [got[d, k] for k in range(len(sizes))] == _groups(sizes, 10)
    assert chunking.pack_blocks(frame.where("false"), "doc", "k", "n", 10).count() == 0
