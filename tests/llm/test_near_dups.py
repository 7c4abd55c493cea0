from __future__ import annotations

import random

import pytest

from silexa.functions.pywords import terms
from silexa.llm import near_dups

KIND = "raw_id bigint, text string, file_path string"


def _truth(rows, words, similarity, least):
    sets = {i: {tuple(t[k : k + words]) for k in range(len(t) - words + 1)} for i, text in rows if len(t := terms(text)) >= least}
    ids = sorted(sets)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-12}


def _corpus(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    phrase = "the reset sequence of the unit"
    rows = []
    for _ in range(70):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 21, 40, 90, 200]))]
        for _ in range(rng.randint(1, 4)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                at = rng.randrange(len(text))
                text[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(vocabulary)], [phrase]])
            rows.append((len(rows) * 3 + 1, " ".join(text)))
    rows.append((9001, "go " * 40))
    rows.append((9002, "go " * 55))
    return rows


@pytest.mark.parametrize(("words", "similarity", "least"), [(3, 0.6, 20), (5, 0.8, 5), (2, 0.35, 3)])
def test_pairs_are_those_of_brute_force(spark, words, similarity, least):
    rows = _corpus(words)
    found = near_dups.NearDuplicates(spark.createDataFrame([(i, t, "p") for i, t in rows], KIND), words, similarity, least)
    got = [tuple(r) for r in near_dups.row_pairs(found).collect()]
    assert len(got) == len(set(got)) and set(got) == _truth(rows, words, similarity, least)


def test_parts_do_not_change_the_result(spark, monkeypatch):
    rows = _corpus(9)
    monkeypatch.setattr(near_dups, "SENT_HEADS", 5)
    monkeypatch.setattr(near_dups, "JOINED", 4000)
    monkeypatch.setattr(near_dups, "BLOCK", 2000)
    found = near_dups.NearDuplicates(spark.createDataFrame([(i, t, "p") for i, t in rows], KIND), 3, 0.6, 20)
    assert {tuple(r) for r in near_dups.row_pairs(found).collect()} == _truth(rows, 3, 0.6, 20)


def test_edges_of_the_input(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    same = " ".join(f"y{i}" for i in range(25))
    rows = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, "one two", "a"), (5, same, "a"), (6, same.upper(), None), (7, same, "b"), (7, same, "b"), (8, long, "c"), (9, long + " z", "c")]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], KIND + ", size string, class_id int")
    found = near_dups.NearDuplicates(frame, 3, 0.6, 20)
    assert {tuple(r) for r in near_dups.row_pairs(found).collect()} == {(5, 6), (5, 7), (6, 7), (8, 9)}
    grouped = {r["raw_id"]: r for r in near_dups.groups(frame.dropDuplicates(["raw_id"]), found).collect()}
    assert set(grouped) == {5, 6, 7, 8, 9}
    assert grouped[7]["class_id"] == 5 and grouped[9]["group_id"] == 8 and grouped[8]["links"] == 1 and grouped[6]["copies"] == 4
    empty = near_dups.NearDuplicates(spark.createDataFrame([], KIND), 3, 0.6, 20)
    assert near_dups.row_pairs(empty).count() == 0 and near_dups.groups(spark.createDataFrame([], KIND), empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(25)] + [(500, 501), (500, 501), (502, 500)]
    edges = [(a, b) for a, b in edges if a != b]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in near_dups.components(spark.createDataFrame(edges, "id_a bigint, id_b bigint")).collect()}
    assert {n: r for n, r in got.items() if n != r} == {n: root(n) for a, b in edges for n in (a, b) if root(n) != n}


def test_short_texts_of_many_terms(spark):
    """A letter that lower case makes two characters parts words, so 20 characters may be 20 terms."""
    rows = spark.createDataFrame([(1, "İ" * 20), (2, "İ" * 20), (3, "İ" * 19)], "raw_id bigint, text string")
    found = near_dups.NearDuplicates(rows, words=3, similarity=0.6, least=20)
    assert {tuple(r) for r in found.members.collect()} == {(1, 1), (2, 1)}


def test_repeated_heads(spark):
    near = " ".join(f"y{i}" for i in range(25))
    rows = spark.createDataFrame([(1, near), (1, near), (2, near + " z"), (2, near + " z"), (3, near)], "raw_id bigint, text string")
    found = near_dups.NearDuplicates(rows, 3, 0.6, 20)
    assert [tuple(r)[:2] for r in found.pairs.collect()] == [(1, 2)]
