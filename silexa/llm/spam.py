"""Pages of repeated keywords, link lists or product tags instead of sentences or domain matter."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silexa.functions.batches import by_text
from silexa.functions.totals import total_array
from silexa.session import cut

PROSE, LINKS, TAGS, MENU = range(4)
#: Words of a line that are labelled together; longer lines are cut.
SPAN = 12
#: Words are learned that make up this share of the words they are learned from, so there are at most a million; and at least so many occurrences.
LEAST_SHARE, LEAST_SEEN = 1e-6, 3
#: Pages of fewer words are never flagged.
LEAST_WORDS = 12
#: Occurrences from which a pair of words counts as repeated on a page.
REPEATED = 3
ROUNDS, KEEP = 3, 0.5
_KNOWN = 1_000_000
BREAK, BLANK = 0, 1

# Directives that begin with a number sign but are no tags.
_DIRECTIVES = frozenset("define include if ifdef ifndef elif else endif undef pragma error warning line".split())
_HREF = re.compile(r"^\W*www\.|href=", re.I)
_TARGET = re.compile(r"\]\([^)\s]*\)?")
_CODE = re.compile(r"\w_\w|\b0[xX][0-9a-fA-F]+|\w\(|[{};]$|\w[-.]>|==|&\w|\w\.[ch]\b|\w/\w")
_PRICE = re.compile(r"^\W?\d+[.,]\d\d\W?$|^[A-Z]{2,4}-\d{2,}\W?$|^[$€£¥]\d|^\d+[$€£¥]")
_LEET = re.compile(r"[a-z]\d+[a-z]|^\d+[a-z]*\d*[a-z]{2,}\d*[a-z]*$")
_PLAIN = str.maketrans("013457@$", "oleastas")
_LINES = re.compile("[\n\r\x0b\x0c\x1c-\x1e\x85\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}\0]+")
#: Letters beyond which a word is no odd spelling.
_LONG = 40
_EDGES = "\"'`*_~.,;:!?()[]{}<>|•·/\\-–—=+«»“”"
_HASHES = re.compile(r"(?<=\w)#(?=\w)")

IS_LINK, IS_TAG, IS_CODE, IS_PRICE, IS_ODD, IS_NUMBER = (1 << k for k in range(6))
#: Number of values of the features of a segment: links, tags, domain matter, repetition, words, prices and odd spellings.
SHAPE = (4, 3, 4, 4, 6, 3)
SEGMENTS = "doc_id bigint, n_words array<int>, features array<int>"


class WordOdds:
    """Log odds of the words that are learned, by key; other words have none."""

    def __init__(self, keys: np.ndarray, spam: np.ndarray, prose: np.ndarray, totals: tuple[int, int]) -> None:
        order = np.argsort(keys)
        self.keys = keys[order]
        spam, prose = spam[order].astype(np.float64), prose[order].astype(np.float64)
        odds = np.log((spam + 1) / (totals[0] + len(keys))) - np.log((prose + 1) / (totals[1] + len(keys)))
        self.odds = np.clip(odds, -4, 4).astype(np.float32)

    def of(self, key: int) -> float:
        at = int(np.searchsorted(self.keys, np.uint64(key)))
        return float(self.odds[at]) if at < len(self.keys) and self.keys[at] == np.uint64(key) else 0.0


class _Words(dict):
    """Numbers of tokens, by which their flags and keys are looked up; emptied beyond a bound.

    BREAK stands for the end of a line, BLANK for tokens without a letter or digit.
    """

    def __init__(self, odds: WordOdds | None = None) -> None:
        super().__init__()
        self.flags, self.keys = np.zeros(_KNOWN, np.int8), np.zeros(_KNOWN, np.uint64)
        self.told, self.odds = odds, np.zeros(_KNOWN, np.float32)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self["\0"] = BREAK

    def make_room(self) -> None:
        """Between batches, for a batch may hold no more new tokens than are left room for."""
        if len(self) > _KNOWN // 2:
            self.forget()

    def __missing__(self, token: str) -> int:
        made, at = self.describe(token), BLANK
        if made:
            at = len(self) + 1
            if at >= len(self.flags):
                self.flags, self.keys, self.odds = (np.resize(x, 2 * at) for x in (self.flags, self.keys, self.odds))
            self.flags[at], self.keys[at] = made
            self.odds[at] = self.told.of(made[1]) if self.told else 0.0
        self[token] = at
        return at

    @staticmethod
    def describe(token: str) -> tuple[int, int] | None:
        bare = token.strip(_EDGES)
        if token[0] != "#" and token.isascii():  # most tokens need no pattern
            if bare.isalpha():
                if token[-1] not in "{};(" and bare[:3].lower() != "www":
                    return 0, xxhash.xxh3_64_intdigest(bare.lower())
            elif bare.isidentifier() and "_" in bare:
                return IS_CODE, xxhash.xxh3_64_intdigest(bare.lower().translate(_PLAIN))
            elif bare.isdigit() and bare == token:
                return IS_NUMBER, xxhash.xxh3_64_intdigest(bare.translate(_PLAIN))
            elif bare[:2] == "0x" and bare.isalnum():
                return IS_CODE, xxhash.xxh3_64_intdigest(bare.lower().translate(_PLAIN))
        word = "".join(c for c in bare if c.isalnum() or c in "_'-")
        if not word:
            return None
        low = word.lower()
        flags = 0
        if "://" in token or _HREF.search(token) or _TARGET.search(token):
            flags |= IS_LINK
        elif token[0] == "#" and len(token) > 1 and token[1].isalnum() and low not in _DIRECTIVES:
            flags |= IS_TAG
        elif _PRICE.match(token):
            flags |= IS_PRICE
        elif _CODE.search(token) or (token[0] == "#" and low in _DIRECTIVES):
            flags |= IS_CODE
        elif not any(c.isalpha() for c in low) or (len(low) in (2, 4, 8) and all(c in "0123456789abcdef" for c in low) and any(c.isdigit() for c in low)):
            flags |= IS_NUMBER
        elif (bare[0] > "‖" and not bare[0].isalnum()) or (len(low) <= _LONG and _LEET.search(low)):
            flags |= IS_ODD
        return flags, xxhash.xxh3_64_intdigest("://" if flags & IS_LINK else low.translate(_PLAIN))


def _runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def segments(texts: list[str | None], words: _Words) -> dict[str, np.ndarray]:
    """Words of all texts with the segment and text they are in, and what share of each segment is what."""
    words.make_room()
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            before = len(flat)
            flat += map(words.__getitem__, _LINES.sub(" \0 ", _HASHES.sub(" #", text)).split())
            flat.append(BREAK)
            counts[i] = len(flat) - before
    token = np.array(flat, np.int64)
    line, doc = np.cumsum(token == BREAK), np.repeat(np.arange(len(texts)), counts)
    kept = token > BLANK
    token, line, doc = token[kept], line[kept], doc[kept]
    flag, key = words.flags[token], words.keys[token]
    opens = _runs(line)
    size = np.diff(np.r_[opens, len(line)])
    place = np.arange(len(line)) - np.repeat(opens, size)
    window = np.minimum(place // SPAN, np.maximum(1, (np.repeat(size, size) + SPAN // 2) // SPAN) - 1)
    first = _runs(line * (1 << 20) + np.minimum(window, (1 << 20) - 1))
    length = np.diff(np.r_[first, len(key)])
    # pairs of words within a line that occur again and again on the page
    pair = (key[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ key[1:]) >> np.uint64(28) if len(key) else key
    same = line[1:] == line[:-1]
    _, inverse, count = np.unique((doc[:-1][same].astype(np.uint64) << np.uint64(36)) | pair[same], return_inverse=True, return_counts=True)
    again = np.zeros(max(0, len(key) - 1), bool)
    again[same] = count[inverse] >= REPEATED
    covered = np.zeros(len(key), bool)
    covered[:-1] |= again
    covered[1:] |= again

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.float64), first) / length if len(first) else np.zeros(0)

    return {
        "doc": doc[first], "length": length, "first": first, "key": key, "odds": words.odds[token], "links": share(flag & IS_LINK > 0), "tags": share(flag & IS_TAG > 0), "code": share(flag & (IS_CODE | IS_NUMBER) > 0),
        "ids": share(flag & IS_CODE > 0), "repeated": share(covered), "shop": share(flag & (IS_PRICE | IS_ODD) > 0), "price": share(flag & IS_PRICE > 0),
    }


def _seeds(s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Segments that are surely no prose, and those that surely are, by their form alone."""
    spam = (s["ids"] == 0) & ((s["links"] > 0.3) | (s["tags"] > 0.3) | (s["repeated"] > 0.8) | (s["shop"] > 0.3)) & (s["code"] < 0.4)
    prose = (s["links"] == 0) & (s["tags"] == 0) & (s["price"] == 0) & ((s["ids"] > 0) | (s["repeated"] < 0.2)) & (s["length"] >= 4)
    return spam & ~prose, prose & ~spam


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word is in sure spam and in sure prose."""
    words = _Words()
    for whole in batches:
        for batch in by_text(whole, 1):
            s = segments(batch.column(1).to_pylist(), words)
            spam, prose = (np.repeat(x, s["length"]) for x in _seeds(s))
            chosen = spam | prose
            keys, at = np.unique(s["key"][chosen], return_inverse=True)
            columns = [pa.array(np.bincount(at, x[chosen], minlength=len(keys)).astype(np.int64)) for x in (spam, prose)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *columns], names=["word", "spam", "prose"])


def word_odds(texts: DataFrame) -> WordOdds:
    """The odds of all words of at least LEAST_SHARE of the words in sure spam and sure prose, counted over all texts (doc_id, text)."""
    seen = texts.mapInArrow(_learned, "word bigint, spam bigint, prose bigint").groupBy("word").agg(F.sum("spam").alias("spam"), F.sum("prose").alias("prose"))
    seen = cut(seen, "words")
    r = seen.agg(F.sum("spam"), F.sum("prose")).first()
    totals = (r[0] or 0, r[1] or 0)
    known = seen.where(F.col("spam") + F.col("prose") >= max(LEAST_SEEN, LEAST_SHARE * sum(totals))).toArrow()  # at most 1 / LEAST_SHARE rows
    return WordOdds(known["word"].to_numpy().view(np.uint64), known["spam"].to_numpy(), known["prose"].to_numpy(), totals)


def _coded(s: dict[str, np.ndarray]) -> np.ndarray:
    mean = np.add.reduceat(s["odds"].astype(np.float64), s["first"]) / s["length"] if len(s["first"]) else np.zeros(0)
    cut_at = lambda x, *edges: np.searchsorted(np.array(edges), x, side="left")
    values = (
        cut_at(s["links"], 0, 0.15, 0.4), cut_at(s["tags"], 0, 0.2), cut_at(s["code"], 0, 0.1, 0.5),
        cut_at(s["repeated"], 0.25, 0.5, 0.75), cut_at(mean, -2, -1, 0, 0.7, 1.6), cut_at(s["shop"], 0, 0.2),
    )
    return np.ravel_multi_index(values, SHAPE)


def _featured(odds: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(odds.value)
        for whole in batches:
            for batch in by_text(whole, 1):
                s = segments(batch.column(1).to_pylist(), words)
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(s["doc"], minlength=batch.num_rows))].astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (s["length"], _coded(s))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "n_words", "features"])

    return run


class LineModel:
    """Hidden Markov model over the segments of a page; features are independent given the label."""

    #: First guess, by label: how likely each value of each feature is. Training moves it halfway to the corpus.
    FIRST = (
        ((0.90, 0.08, 0.015, 0.005), (0.97, 0.02, 0.01), (0.20, 0.20, 0.35, 0.25), (0.65, 0.20, 0.10, 0.05), (0.45, 0.30, 0.17, 0.05, 0.02, 0.01), (0.94, 0.05, 0.01)),
        ((0.02, 0.08, 0.30, 0.60), (0.90, 0.05, 0.05), (0.75, 0.10, 0.10, 0.05), (0.40, 0.20, 0.20, 0.20), (0.02, 0.05, 0.20, 0.23, 0.25, 0.25), (0.80, 0.12, 0.08)),
        ((0.82, 0.08, 0.06, 0.04), (0.70, 0.10, 0.20), (0.90, 0.06, 0.03, 0.01), (0.12, 0.14, 0.24, 0.50), (0.01, 0.03, 0.12, 0.21, 0.28, 0.35), (0.70, 0.10, 0.20)),
        ((0.92, 0.04, 0.02, 0.02), (0.96, 0.02, 0.02), (0.60, 0.20, 0.17, 0.03), (0.25, 0.25, 0.25, 0.25), (0.02, 0.06, 0.17, 0.25, 0.25, 0.25), (0.05, 0.35, 0.60)),
    )

    def __init__(self) -> None:
        self.first = [np.array([label[f] for label in self.FIRST]) for f in range(len(SHAPE))]
        self.emit = [x.copy() for x in self.first]
        self.first_start = np.array([0.85, 0.05, 0.06, 0.04])
        stay = np.array([0.97, 0.93, 0.94, 0.93])
        self.first_move = np.diag(stay) + (1 - np.eye(4)) * ((1 - stay) / 3)[:, None]
        self.start, self.move = self.first_start.copy(), self.first_move.copy()

    def scores(self) -> np.ndarray:
        """Log probability of each combination of feature values under each label."""
        values = np.unravel_index(np.arange(int(np.prod(SHAPE))), SHAPE)
        return sum(np.log(e[:, v]) for e, v in zip(self.emit, values)).T

    def labels(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The most probable labels of the segments of many pages, all pages a step at a time."""
        table, move = self.scores(), np.log(self.move)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        out = np.zeros(len(features), np.int8)
        back = np.zeros((len(features), 4), np.int8)
        live = int((sizes > 0).sum())
        best = np.log(self.start) + table[features[starts[:live]]]
        last = best.copy()
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            live = int((sizes > t).sum())
            reach = best[:live, :, None] + move
            back[starts[:live] + t] = reach.argmax(axis=1)
            best = reach.max(axis=1) + table[features[starts[:live] + t]]
            last[:live] = best
        now = last.argmax(axis=1) if len(last) else np.zeros(0, np.int64)
        for t in range((int(sizes[0]) if len(sizes) else 0) - 1, -1, -1):
            live = int((sizes > t).sum())
            at = starts[:live] + t
            out[at] = now[:live]
            now[:live] = back[at, now[:live]]
        return out

    def tally(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Counts of labels with feature values, of first labels and of moves."""
        found = self.labels(features, sizes).astype(np.int64)
        n = int(np.prod(SHAPE))
        with_values = np.bincount(found * n + features, minlength=4 * n)
        opens = (np.cumsum(sizes) - sizes)[sizes > 0]
        inner = np.ones(len(found), bool)
        inner[opens] = False
        at = np.flatnonzero(inner)
        moves = np.bincount(found[at - 1] * 4 + found[at], minlength=16)
        return np.concatenate([with_values, np.bincount(found[opens], minlength=4), moves]).astype(np.float64)

    def learn(self, counts: np.ndarray) -> None:
        """Half the first guess, half the corpus as labelled."""
        n = int(np.prod(SHAPE))
        cube, opens, moves = counts[: 4 * n].reshape(4, *SHAPE), counts[4 * n :][:4], counts[4 * n + 4 :].reshape(4, 4)
        mix = lambda guess, seen: KEEP * guess + (1 - KEEP) * np.where(seen.sum(axis=-1, keepdims=True) > 0, seen / np.maximum(seen.sum(axis=-1, keepdims=True), 1), guess)
        self.emit = [mix(self.first[f], cube.sum(axis=tuple(1 + g for g in range(len(SHAPE)) if g != f))) for f in range(len(SHAPE))]
        self.start, self.move = mix(self.first_start, opens), mix(self.first_move, moves)


def _pages(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists, words = batch.column("features"), batch.column("n_words")
    offsets, other = lists.offsets.to_numpy(), words.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), words.values.to_numpy()[other[0] : other[-1]].astype(np.int64), np.diff(offsets).astype(np.int64)


def _tallied(model: LineModel):
    def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(4 * int(np.prod(SHAPE)) + 20)
        for batch in batches:
            features, _, sizes = _pages(batch)
            if len(features):
                total += model.tally(features, sizes)
        return total

    return fill


def _shared(model: LineModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, words, sizes = _pages(batch)
            label = model.labels(features, sizes) if len(features) else np.zeros(0, np.int8)
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            counts = [np.bincount(doc[label == k], words[label == k], minlength=batch.num_rows).astype(np.int64) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, counts)], names=["doc_id", "prose", "links", "tags", "menu"])

    return run


def word_shares(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Words of each document by label: doc_id, prose, links, tags, menu.

    Lines, cut after SPAN words, are segments. (1) Segments whose form alone says that they are
    spam or prose teach, over all documents, how much each word speaks for either. (2) A hidden
    Markov model labels segments as prose (sentences and domain matter: tables, code, lists of
    symbols, logs), link list, tag list (keywords, search phrases) or menu (products) by six
    features: links, tags, domain matter, pairs of words repeated on the page, words as learned,
    prices and odd spellings. (3) Its probabilities are re-estimated from the most probable
    labels of all documents, ``rounds`` times, and mixed with the first guess so that labels keep
    their meaning. Words that are a millionth or more of those counted are told apart, so their
    table is bounded, and probabilities have a fixed size; documents aren't shuffled, and
    the features are written once, so texts are read twice.

    Words are tokens between white space with a letter or digit; tags written together are
    parted. Defined results: null, empty and wordless texts have no words of any label; repeated
    rows come out repeated; columns of other names are ignored.
    """
    texts = documents.select("doc_id", "text")
    context = documents.sparkSession.sparkContext
    odds = context.broadcast(word_odds(texts))
    pages = cut(texts.mapInArrow(_featured(odds), SEGMENTS), "segments")
    model = LineModel()
    for _ in range(rounds):
        model.learn(total_array(pages, _tallied(model), 4 * int(np.prod(SHAPE)) + 20))
    return pages.mapInArrow(_shared(model), "doc_id bigint, prose bigint, links bigint, tags bigint, menu bigint")


def flagged(shares: DataFrame, share: float = 0.5, least: int = LEAST_WORDS) -> DataFrame:
    """Documents of at least ``least`` words more than ``share`` of which aren't prose."""
    other = F.col("links") + F.col("tags") + F.col("menu")
    total = F.col("prose") + other
    return shares.where((total >= least) & (other > share * total))
