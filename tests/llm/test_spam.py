from __future__ import annotations

import random

import numpy as np

from silexa.llm import spam

KIND = "doc_id bigint, text string"


def _prose(rng, n):
    names = ["CTRL_REG", "dma_start", "0x1F", "STAT_MAP", "irq_ack"]
    verbs = ["clears", "sets", "holds", "reads", "masks"]
    things = ["counter", "buffer", "clock", "bridge", "filter", "queue"]
    return "\n".join(f"The {rng.choice(things)} {rng.choice(verbs)} {rng.choice(names)} before the {rng.choice(things)} is ready, and firmware waits {rng.randint(1, 99)} us." for _ in range(n))


def _corpus(seed=3):
    rng = random.Random(seed)
    goods, words = ["vela board", "tavo kit", "nori sensor"], ["buy", "cheap", "best", "sale", "order", "discount"]
    docs, spammy = [], set()
    for i in range(1, 301):
        kind = i % 10
        if kind == 0:
            text = ", ".join(f"{rng.choice(words)} {rng.choice(goods)}" for _ in range(60))
        elif kind == 1:
            text = "\n".join(f"[{rng.choice(goods)}](https://shop{rng.randint(1, 99)}.invalid/{rng.randint(1, 999)})" for _ in range(30))
        elif kind == 2:
            text = "".join(f"#{rng.choice(words)}{rng.choice(goods).split()[0]}" for _ in range(40))
        elif kind == 3:
            text = "\n".join(f"SKU-{rng.randint(100, 999)} {rng.choice(goods)} {rng.choice(words)} {rng.randint(1, 99)}.{rng.randint(10, 99)} Compare" for _ in range(25))
        elif kind == 4:
            text = "\n".join(f"{rng.choice(['CTRL', 'STAT'])}_{rng.randint(1, 50)} | {rng.randint(0, 31)} | R/W | 0x{rng.randint(0, 9999):X}" for _ in range(25))
        elif kind == 5:
            text = _prose(rng, 12) + "\n\n" + ", ".join(f"{rng.choice(words)} {rng.choice(goods)}" for _ in range(8))
        else:
            text = _prose(rng, 12)
        if kind < 4:
            spammy.add(i)
        docs.append((i, text))
    return docs, spammy


def test_finds_all_kinds_and_spares_the_rest(spark):
    docs, spammy = _corpus()
    shares = spam.word_shares(spark.createDataFrame(docs, KIND))
    got = {r["doc_id"] for r in spam.flagged(shares).collect()}
    assert got == spammy
    assert shares.count() == len(docs)


def test_defined_cases(spark):
    docs, _ = _corpus()
    odd = [(1001, None), (1002, ""), (1003, " \n\t"), (1004, "buy cheap"), (1005, "!!! ... ---"), (1006, "x" * 200_000), (None, "no id"), (1007, "buy kit " * 40_000), (1007, "buy kit " * 40_000)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in docs + odd], KIND + ", tags int, prose string")
    shares = spam.word_shares(frame)
    by = {r["doc_id"]: r for r in shares.collect()}
    assert shares.count() == len(docs) + len(odd)
    for i in (1001, 1002, 1003, 1005):
        assert sum(by[i][k] for k in ("prose", "links", "tags", "menu")) == 0
    got = [r["doc_id"] for r in spam.flagged(shares).collect()]
    assert 1004 not in got and got.count(1007) == 2
    assert spam.word_shares(spark.createDataFrame([], KIND)).count() == 0


def test_labels_are_the_most_probable_path():
    model, rng = spam.LineModel(), np.random.default_rng(1)
    sizes = np.array([0, 3, 1, 0, 4, 2])
    features = rng.integers(0, int(np.prod(spam.SHAPE)), sizes.sum())
    got, table, start = model.labels(features, sizes), model.scores(), 0
    for n in sizes:
        best, path = -1e9, ()
        for code in range(4**n):
            labels = [(code // 4**k) % 4 for k in range(n)]
            if n:
                score = np.log(model.start[labels[0]]) + sum(table[features[start + k], labels[k]] for k in range(n)) + sum(np.log(model.move[labels[k - 1], labels[k]]) for k in range(1, n))
                if score > best:
                    best, path = score, tuple(labels)
        assert tuple(got[start : start + n]) == path
        start += n
