from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from silexa.operators import dedup, embed, search, store, verify

RAW = "raw_id bigint, text string, section_path string, file_refs array<string>, doc_refs array<string>, symbol_refs array<string>, chips array<string>, file_path string, chunk_index int, chip string, revisions array<string>, doc_type string"


def _chunks(spark):
    rows = []
    for i, (kind, chip, chips, revisions) in enumerate([("trm", "p4", [], ["main", "r1"]), ("trm", "p4", [], ["r1"]), ("trm", "c3", [], ["main"]), ("idf", "", ["c3", "p4"], [])]):
        rows.append((i + 1, [float(k == i) for k in range(4)], f"text {i}", "doc", kind, chip, chips, revisions, "S", [], [], ["foo()"] if i != 2 else None, f"f{i}", i, "v1", "c"))
    return spark.createDataFrame(rows, store.CHUNK)


def _chips(spark):
    return spark.createDataFrame([("p4", True, "P4", ["main", "r1"]), ("c3", False, None, ["main"])], "chip string, idf_docs boolean, trm_folder string, revisions array<string>")


def test_dedup(spark):
    rows = [
        (3, "t", "second", ["b"], None, ["y", "x"], ["c2"], "p", 5, "k", ["r2"], "trm"),
        (1, "t", "first", ["a", "b"], [], ["x", None], ["c1", None, "c1"], "p", 9, "k", ["r1", "r2"], "trm"),
        (2, "t", None, None, None, None, None, "q", None, "k", None, "trm"),
        (4, None, "n", [], [], [], ["c1"], None, 1, "k", ["r1"], "trm"),
        (5, None, "n", [], [], [], ["c0"], None, 0, "k", ["r0"], "trm"),
        (6, "", "n", [], [], [], [], None, 0, "k", [], "trm"),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], RAW + ", copies string")
    got = {r["first_seen"]: r for r in dedup.dedup_targets(frame).collect()}
    assert set(got) == {1, 2, 4, 6}
    assert got[1]["chips"] == ["c1", "c2"] and got[1]["chunk_index"] == 5 and got[1]["section_path"] == "first" and got[1]["copies"] == 2
    assert got[1]["file_refs"] == ["a", "b"] and got[1]["symbol_refs"] == ["x", "y"] and got[2]["chips"] == [] and got[4]["chips"] == ["c0", "c1"]
    again = {r["first_seen"]: r for r in dedup.dedup_revisions(frame).collect()}
    assert set(again) == {1, 5} and again[1]["revisions"] == ["r1", "r2"] and again[1]["chunk_index"] == 9 and again[1]["symbol_refs"] == ["x", None]
    assert {r["values"]: r["rows"] for r in dedup.spread(dedup.dedup_targets(frame)).collect()} == {2: 2, 0: 2}
    assert dedup.dedup_targets(frame.limit(0)).count() == 0 and dedup.dedup_revisions(frame.limit(0)).count() == 0


def test_scope_and_search(spark):
    chunks, chips = _chunks(spark), _chips(spark)
    ids = lambda scope: sorted(r["chunk_id"] for r in chunks.where(search.scope_filter(scope)).collect())
    assert ids(search.Scope(chip="p4")) == [1, 2, 4] and ids(search.Scope(revision="r1")) == [1, 2, 4] and ids(search.Scope("trm", "p4", "main")) == [1] and ids(search.Scope()) == [1, 2, 3, 4]
    got = search.search(chunks, chips, [1.0, 0.0, 0.0, 0.0], search.Scope(chip="p4"), 2).collect()
    assert [r["chunk_id"] for r in got] == [1, 2] and got[0]["relevance_distance"] == 0.0 and got[0]["revision_scope"] == "all published revisions (main, r1)"
    assert got[1]["revision_scope"].startswith("ONLY revision r1") and "vector" not in got[0]
    for bad in (search.Scope(chip="zz"), search.Scope(revision="zz"), search.Scope(doc_type="zz")):
        with pytest.raises(ValueError):
            bad.check(chips)
    with pytest.raises(ValueError):
        search.nearest(chunks, [1.0], 0)
    assert search.nearest(chunks, [1.0], 3).count() == 0  # no vector has that length
    totals, first = search.find_symbol(chunks, " foo ", 2)
    assert {r["doc_type"]: r["matches"] for r in totals.collect()} == {"trm": 2, "idf": 1} and [r["doc_type"] for r in first.collect()] == ["idf", "trm"]
    assert "revision_scope" in search.as_json(search.results(chunks, chips)).first()["json"]
    assert [r["chip"] for r in search.list_chips(chips).collect()] == ["c3", "p4"] and search.chip_of_folder(chips, "P4") == "p4" and search.chip_of_folder(chips, "x") is None


def test_interleave_is_fair_and_stable(spark):
    rows = [("src", "c", f"f{i:02}", 0, i) for i in range(10)] + [("trm", "c", f"f{i:02}", 0, 100 + i) for i in range(8)]
    kind = "doc_type string, chip string, file_path string, chunk_index int, chunk_id int"
    first = [r["chunk_id"] for r in search.interleaved(spark.createDataFrame(rows, kind), 5).collect()]
    random.Random(1).shuffle(rows)
    assert first == [0, 100, 1, 101, 2] == [r["chunk_id"] for r in search.interleaved(spark.createDataFrame(rows, kind), 5).collect()]
    assert search.interleaved(spark.createDataFrame([r for r in rows if r[0] == "src"], kind), 5).count() == 5


def test_global_position_and_batches(spark):
    rng = random.Random(5)
    docs = [(i, "x" * rng.randint(0, 300)) for i in range(500)] + [(900, None)]
    got = verify.length_batches(spark.createDataFrame(docs, "doc_id int, text string"), "doc_id").collect()
    want = sorted((len(t or ""), i) for i, t in docs)
    assert sorted((r["position"], r["doc_id"]) for r in got) == [(k, i) for k, (_, i) in enumerate(want)] and all(r["batch"] == r["position"] // 32 for r in got)
    tax = verify.padding_tax(verify.length_batches(spark.createDataFrame(docs, "doc_id int, text string"), "doc_id")).first()
    assert tax["real"] == sum(n for n, _ in want) and 1 <= tax["tax"] < 1.2


def test_audits_pass_good_and_fail_broken_corpora(spark):
    registers = spark.createDataFrame([(i, f"REG\\_{i}\\_CTL", "0x0", "f", False, "CHIP-A", "01", i) for i in range(40)] + [(99, "B_{n}", "", "f", True, "CHIP-A", "01", 1), (98, None, "", "f", False, "CHIP-A", "01", 1), (97, "A B", "", "f", False, "CHIP-A", "02", 1)], "reg_id int, name string, address string, file string, parameterised boolean, chip string, chapter string, present int")
    good = [("chip_a", f"see REG_{i}_CTL and A B here") for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "chip string, text string")
    checked = verify.census_check(registers, frame(good))
    assert verify.gate(checked).first()["passed"] and {r["chip"]: r["percent"] for r in verify.census_rates(checked).collect()} == {"CHIP-A": 100.0, "TOTAL": 100.0}
    broken = verify.census_check(registers, frame(good[:10]))
    assert not verify.gate(broken).first()["passed"] and verify.missing_names(broken, 5).count() == 5
    assert verify.worst_chapters(verify.chapter_hits(broken)).first()["chapter"] == "01"
    other = verify.census_check(registers, frame([("another", t) for _, t in good]))  # no chunk of the chip: all chunks count, but not for names with blanks
    assert {r["name"] for r in other.where("NOT present").collect()} == {"A B"}
    assert verify.gate(verify.census_check(registers.limit(0), frame(good))).first()["passed"]
    stats = verify.file_stats(spark.createDataFrame([("f1", "A\n\n" + "w " * 90, "A"), ("f2", "w " * 20, ""), ("f3", None, None), ("f4", "w", "")], "file_path string, text string, section_path string"))
    rates = verify.capture_rates(stats, spark.createDataFrame([("f1", 100), ("f2", 100), ("f3", 10)], "file_path string, source_words int"))
    by = {r["file_path"]: r for r in rates.collect()}
    assert by["f1"]["capture"] == 90.0 and by["f3"]["capture"] is None and by["f4"]["missing"] and {r["file_path"] for r in verify.thin_files(rates).collect()} == {"f2"}


def test_samples_caps_and_endings_of_audits(spark):
    ids = spark.range(100).withColumnRenamed("id", "chunk_id")
    picked = lambda rows, **how: [r["chunk_id"] for r in verify.sample_rows(rows, **how).collect()]
    assert len(set(picked(ids))) == 5 and picked(ids) == picked(ids.repartition(7)) != picked(ids, seed=1) and sorted(picked(ids.limit(3))) == [0, 1, 2]
    checked = spark.createDataFrame([(c, "01", f"N{i}", i == 0) for c in "BA" for i in range(4)], "chip string, chapter string, name string, present boolean")
    assert [(r["chip"], r["name"]) for r in verify.missing_names(checked, 2, most=3).collect()] == [("A", "N1"), ("A", "N2"), ("B", "N1")] and verify.missing_names(checked, 2).count() == 4
    gained = verify.symbols_gained(spark.createDataFrame([(["A", "B"],), (["B", None],), ([],), (None,)], "symbol_refs array<string>")).first()
    assert tuple(gained) == (2, 2) and tuple(verify.symbols_gained(spark.createDataFrame([], "symbol_refs array<string>")).first()) == (0, 0)
    stats = verify.file_stats(spark.createDataFrame([(p, "w " * 50, "") for p in ("a", "b.tex", "c", "d", None)], "file_path string, text string, section_path string"))
    sources = spark.createDataFrame([("a.tex", 100), ("b", 100), ("c", 50), ("c.tex", 100)], "file_path string, source_words int")
    by = {r["file_path"]: (r["capture"], r["missing"]) for r in verify.capture_rates(stats, sources, ".tex").collect()}
    assert by == {"a": (50.0, False), "b.tex": (50.0, False), "c": (100.0, False), "d": (None, True), None: (None, True)}
    assert {r["file_path"] for r in verify.capture_rates(stats, sources).where("missing").collect()} == {"a", "b.tex", "d", None}


def test_store(spark, tmp_path):
    chunks, path = _chunks(spark), str(tmp_path / "store")
    store.append(chunks, path)
    store.append(chunks, path)
    assert store.read(spark, path).count() == 4
    store.write(chunks.where("doc_type = 'idf'").withColumn("text", F.lit("new")), path)
    now = {r["chunk_id"]: r["text"] for r in store.read(spark, path).collect()}
    assert now[4] == "new" and len(now) == 4
    assert store.without_collection(store.read(spark, path), "trm").count() == 1
    with pytest.raises(ValueError):
        store.without_collection(chunks, "x' OR 1=1")
    with pytest.raises(ValueError):
        store.with_constants(chunks, {"a": F.lit(1)}, only="trm")
    assert store.with_constants(chunks, {"a": F.lit(1), "text": F.lit("z")}).where("text = 'z'").count() == 0
    with pytest.raises(Exception, match="doc_type"):
        store.checked(chunks.withColumn("doc_type", F.lit("pdf"))).collect()
    assert store.replace(store.read(spark, path).withColumn("chip", F.lit("all")), path, dry_run=True) == 4
    assert store.replace(store.read(spark, path).withColumn("chip", F.lit("all")), path) == 4
    assert {r["chip"] for r in store.read(spark, path).collect()} == {"all"}
    with pytest.raises(ValueError, match="became"):
        store.replace(store.read(spark, path).limit(1), path)
    assert store.read(spark, path).count() == 4
    fresh = spark.createDataFrame([("f0", "text 0", None), ("f1", "text 1", ["new"])], "file_path string, text string, symbol_refs array<string>")
    texts = chunks.withColumn("text", F.when(F.col("chunk_id") == 3, "Register R_X at address 0").otherwise(F.col("text")))
    got = {r["chunk_id"]: r["symbol_refs"] for r in store.with_refreshed_symbols(texts, fresh).collect()}
    assert got == {1: [], 2: ["new"], 3: ["R_X"], 4: []}
    assert verify.missing_columns(chunks.drop("chip"), {"chip": "string", "text": "string"}) == ["chip"]


def test_tables_in_the_shared_folder(spark):
    from silexa.session import CHECKPOINT_KEY, cut, drop_tables, shared_dir

    table = cut(spark.range(5), "five")
    assert table.count() == 5 and spark.conf.get(CHECKPOINT_KEY) == shared_dir(spark) and shared_dir(spark) in table.inputFiles()[0]
    assert drop_tables(spark) >= 1 and drop_tables(spark) == 0


def test_embedding(spark):
    docs = spark.createDataFrame([(1, "reset the clock"), (2, None), (3, "reset the clock"), (4, "other words")], "i int, text string")
    got = {r["i"]: list(r["vector"]) for r in embed.embed_documents(docs, lambda: embed.hashing_embedder(16)).collect()}
    assert got[1] == got[3] != got[4] and len(got[2]) == 16 and not any(got[2])
    assert embed.embed_query("reset", embed.hashing_embedder(16)) != embed.hashing_embedder(16)(["reset"])[0]
