from __future__ import annotations

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from silexa.llm import packing, splitting

RAW = "raw_id bigint, text string, section_path string, file_path string, chunk_index int, doc_type string"
LIMITS = "doc_type string, max_words int, overlap_words int, container_words int"
LIMIT_ROWS = [("idf", 10, 3, 12), ("src", 5, 0, 8)]


def _limits(spark, rows=LIMIT_ROWS):
    return spark.createDataFrame(rows, LIMITS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c", "\n", "\n\n", "# h", "d!", "é"]), min_size=1, max_size=80), st.integers(1, 9), st.integers(0, 9))
def test_pieces_cover_the_text(parts, limit, overlap):
    text = " ".join(parts)
    spans = splitting.units(text)
    if not spans:
        return
    ranges = splitting.cuts(text, spans, limit, overlap)
    shared = max(0, min(overlap, limit - 1))
    assert ranges[0][0] == 0 and ranges[-1][1] == len(spans)
    for (a, b), (c, d) in zip(ranges, ranges[1:]):
        assert c == b - shared and d > b
    assert all(b - a <= limit for a, b in ranges)


def test_a_section_that_fits_stays_whole():
    text = "w " * 44 + "w\n\n# " + "v. " * 83 + "v."
    assert splitting.cuts(text, splitting.units(text), 100, 0) == [(0, 45), (45, 130)]


def _recursive(text, spans, limit):
    """Where pieces end: parts of one level packed as long as they fit, a first one that doesn't fit split by the next level."""

    def end_of(start, stop, level):
        if stop - start <= limit:
            return stop
        if level > splitting.WORD:
            return start + limit
        ends = [i for i in range(start + 1, stop) if splitting.boundary(text, spans, i) == level] + [stop]
        fit = [i for i in ends if i - start <= limit]
        return fit[-1] if fit else end_of(start, ends[0], level + 1)

    out = [0]
    while out[-1] < len(spans):
        out.append(end_of(out[-1], len(spans), splitting.SECTION))
    return list(zip(out, out[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c", "\n", "\n\n", "\n# h", "d!", "é"]), min_size=1, max_size=80), st.integers(1, 9))
def test_cuts_are_those_of_the_recursion(parts, limit):
    text = " ".join(parts)
    spans = splitting.units(text)
    assert not spans or splitting.cuts(text, spans, limit, 0) == _recursive(text, spans, limit)


def test_cuts_at_pauses():
    text = "one two three. four five six seven\n\neight nine ten eleven"
    spans = splitting.units(text)
    first = splitting.cuts(text, spans, 8, 0)[0]
    assert text[: spans[first[1] - 1][1]].endswith("seven")  # the paragraph before the sentence
    one_line = text.replace("\n\n", " ")
    assert one_line[: splitting.units(one_line)[splitting.cuts(one_line, splitting.units(one_line), 5, 0)[0][1] - 1][1]].endswith("three.")


def test_long_words_are_cut_only_by_characters():
    text = "x" * 25 + " y"
    assert len(splitting.units(text)) == 2
    spans = splitting.units(text, 10)
    assert [b - a for a, b in spans] == [10, 10, 5, 1]
    assert all(spans[b - 1][1] - spans[a][0] <= 12 for a, b in splitting.cuts(text, spans, 5, 1, 12))


def test_split_oversized(spark):
    body = " ".join(f"w{i}" for i in range(23))
    rows = [
        (1, f"A > B\n\n{body}", "A > B", "p", 4, "idf"),
        (2, body, None, "p", None, "idf"),
        (3, None, "A", "p", 1, "idf"),
        (4, "", "", None, 1, "idf"),
        (5, "short", "", "p", 1, "idf"),
        (6, body, "", "p", 1, None),
        (7, body, "", "p", 1, "unlimited"),
        (8, "a b c d e f g", "", "p", 2, "src"),
        (8, "a b c d e f g", "", "p", 2, "src"),
        (9, " ".join(["w"] * 13), "one two three", "p", 0, "idf"),
    ]
    chunks = spark.createDataFrame([(*r, "x", 7) for r in rows], RAW + ", max_words string, _max_words int")
    pieces = splitting.split_oversized(chunks, _limits(spark)).collect()
    by = {}
    for p in pieces:
        by.setdefault(p["raw_id"], []).append(p)
    assert set(by) == {1, 2, 8}  # 9: its section path's words don't count
    assert len([p for p in by[8] if p["piece_no"] == 0]) == 2
    for raw_id, start in ((1, 4), (2, 0)):
        got = sorted(by[raw_id], key=lambda p: p["piece_no"])
        assert [p["chunk_index"] for p in got] == [start + k for k in range(len(got))]
        words = got[0]["text"].split()
        for p in got[1:]:
            assert p["overlap_words"] == 3 and p["text"].split()[:3] == words[-3:]
            words += p["text"].split()[3:]
        assert " ".join(words) == body
        assert all(len(p["text"].split()) == p["n_words"] <= 10 for p in got)
    assert by[1][0]["section_path"] == "A > B"
    assert sorted(r["raw_id"] for r in splitting.oversized(splitting.split_oversized(chunks, _limits(spark))).collect()) == [1, 2, 8, 8]


def test_split_empty_tables(spark):
    assert splitting.split_oversized(spark.createDataFrame([], RAW), _limits(spark)).count() == 0
    assert splitting.split_oversized(spark.createDataFrame([(1, "a b " * 50, "", "p", 1, "idf")], RAW), _limits(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1, max_size=15))
def test_minimum_slack_uses_every_item_once(counts):
    patterns = packing.minimum_slack(counts, 40)
    used: dict[int, int] = {}
    for times, pattern in patterns:
        assert times >= 1 and sum(n * c for n, c in pattern.items()) <= 40
        for n, c in pattern.items():
            used[n] = used.get(n, 0) + times * c
    assert used == counts
    rooms: list[int] = []  # first fit by decreasing length
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= n), None)
        if at is None:
            rooms.append(40 - n)
        else:
            rooms[at] -= n
    assert sum(t for t, _ in patterns) <= 1.15 * len(rooms) + 1


def test_minimum_slack_is_near_the_bound():
    rng = random.Random(3)
    counts: dict[int, int] = {}
    for _ in range(5000):
        n = min(512, max(1, int(rng.lognormvariate(4.5, 0.9))))
        counts[n] = counts.get(n, 0) + 1
    least = math.ceil(sum(n * c for n, c in counts.items()) / 512)
    assert sum(t for t, _ in packing.minimum_slack(counts, 512)) <= least + 1


def test_fill_containers(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), "", "p", 0, rng.choice(["idf", "src"])) for i in range(1, 300)]
    rows += [(1000, None, "", "p", 0, "idf"), (1001, "", "", "p", 0, "idf"), (1002, " \n", "", "p", 0, "idf"), (1003, "a b", "", "p", 0, None), (1004, "a b", "", "p", 0, "other")]
    rows += [(1005, "a b", "", "p", 0, "idf")] * 3
    chunks = spark.createDataFrame([(*r, "c", 1) for r in rows], RAW + ", container string, capacity int")
    packing_rows = packing.RANKED
    try:
        packing.RANKED = 50  # several buckets
        got = packing.fill_containers(chunks, _limits(spark)).collect()
    finally:
        packing.RANKED = packing_rows
    words: dict[int, int] = {}
    room: dict[tuple[str, int], int] = {}
    for r in got:
        if r["container"] is None:
            assert r["raw_id"] in (1000, 1001, 1002, 1003, 1004)
            continue
        words[r["raw_id"]] = words.get(r["raw_id"], 0) + r["n_words"]
        key = (r["doc_type"], r["container"])
        room[key] = room.get(key, 0) + r["n_words"]
    capacity = {"idf": 12, "src": 8}
    assert all(n <= capacity[k[0]] for k, n in room.items())
    told: dict[int, int] = {}
    for i, text, *_ in rows:
        if text and text.split() and i not in (1003, 1004):
            told[i] = told.get(i, 0) + len(text.split())
    assert words == told
    for kind, size in capacity.items():
        total = sum(n for k, n in room.items() if k[0] == kind)
        containers = {k[1] for k in room if k[0] == kind}
        assert containers == set(range(len(containers))) and len(containers) <= math.ceil(total / size) * 1.15 + 1
    for r in got:
        if r["n_words"] and r["raw_id"] < 1000 and r["doc_type"] == "idf" and told[r["raw_id"]] <= 12:
            assert r["first_word"] == 0 and r["n_words"] == told[r["raw_id"]]  # not cut
    assert packing.fill_containers(spark.createDataFrame([], RAW), _limits(spark)).count() == 0
