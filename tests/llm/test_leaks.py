from __future__ import annotations

import random
import unicodedata

from silexa.functions.pywords import TERM
from silexa.llm import leaks

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def _words(text):
    low = unicodedata.normalize("NFKC", text or "").lower()
    return TERM.findall("".join(c for c in low if unicodedata.category(c) != "Cf"))


def _truth(docs, items, run):
    grams = {}
    for i, text in items:
        w = _words(text)
        for k in range(len(w) - run + 1):
            grams.setdefault(tuple(w[k : k + run]), set()).add(i)
    out = set()
    for d, text in docs:
        w = _words(text)
        for k in range(len(w) - run + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + run]), ())}
    return out


def test_same_as_brute_force_whatever_the_filter(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 30)))) for i in range(1, 30)]
    items += [(40, items[0][1]), (41, f"{items[1][1]} {items[2][1]}")]
    docs = []
    for d in range(1, 120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if d % 3 == 0:
            source = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(source) - 6))
            words[5:5] = source[at : at + rng.randint(4, 9)]
        docs.append((d, rng.choice([" ", ", ", " -- "]).join(words)))
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    truth = _truth(docs, items, 6)
    assert truth
    for bits in (None, 6):  # the smaller filter lets everything pass
        got = leaks.leaks(*frames, run=6, bits=bits).collect()
        assert len(got) == len(truth) and {(r["doc_id"], r["item_id"]) for r in got} == truth
        assert all(6 <= r["shared_words"] <= r["item_words"] and 0 < r["share"] <= 1 for r in got)


def test_forms_and_defined_cases(spark):
    passage = "Ｔhe quick brown fox jumps over the lazy dog again today"
    docs = [(1, "see: the QUICK, brown fox; jumps over​ the la­zy dog again today!"), (2, None), (3, ""), (4, "the quick brown fox"), (5, passage), (5, passage), (6, "pad " * 60_000 + passage), (7, "the quick brown fox jumps over the lazy cat again today")]
    items = [(1, passage), (2, None), (3, ""), (4, "too short"), (5, passage + " and more"), (5, passage), (None, passage)]
    docs_frame = spark.createDataFrame([(*r, 5, "w") for r in docs], DOCS + ", item_id int, words string")
    got = sorted((r["doc_id"], r["item_id"], r["shared_words"]) for r in leaks.leaks(docs_frame, spark.createDataFrame(items, ITEMS)).collect())
    assert [(d, i) for d, i, _ in got] == [(1, 1), (1, 5), (5, 1), (5, 1), (5, 5), (5, 5), (6, 1), (6, 5)]
    assert all(n == 11 for _, i, n in got if i == 1)
    none = spark.createDataFrame([], ITEMS)
    assert leaks.leaks(docs_frame, none).count() == 0 and leaks.leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0


def test_short_texts_that_grow_in_nfkc(spark):
    docs = [(1, "½ ½ ½ ½ ½"), (2, "\ufdfa \ufdfa \ufdfa"), (3, "½ ½ ½ ½"), (4, "1 2 1 2 1 2 1 2 1"), (5, "1 2 1 2 1 2 1 2 1 2"), (6, None), (7, "é")]
    items = [(1, "1 2 1 2 1 2 1 2 1 2"), (2, " ".join(_words("\ufdfa") * 3))]
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(1, 1), (2, 2), (5, 1)} == _truth(docs, items, 10)


def test_share_is_of_one_window():
    runs = lambda at, k, n: [(at + i, k + i) for i in range(n - 4)]
    assert leaks.shared_words(runs(0, 0, 10) + runs(13, 20, 7), 5, 30) == 17
    assert leaks.shared_words(runs(0, 0, 10) + runs(50, 20, 7), 5, 30) == 10
