"""Oversized texts cut into overlapping pieces at natural boundaries."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silexa.functions.pywords import BLANKED, white_count

SECTION, PARAGRAPH, LINE, SENTENCE, WORD, CHARACTER = range(6)
_BREAK = re.compile("\r\n|[\n\r\x0b\x0c\x85\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}]")
_ENDS = re.compile(r"[.!?;:。！？…][\"'”’)\]}>*_`]*$")
_HEADING = re.compile(r"(#{1,6}|={1,6}|-{3,}|\*{3,}|={3,})$")

PIECES = (
    "raw_id bigint, doc_type string, file_path string, section_path string, piece_no int, "
    "n_pieces int, chunk_index int, n_words int, overlap_words int, text string"
)


def units(text: str, max_chars: int | None = None) -> list[tuple[int, int]]:
    """Spans of the words; a word of more than ``max_chars`` characters is cut into such spans."""
    spans = [m.span() for m in BLANKED.finditer(text)]
    if max_chars is None or all(e - s <= max_chars for s, e in spans):
        return spans
    return [(x, min(x + max_chars, e)) for s, e in spans for x in range(s, e, max_chars)]


def boundary(text: str, spans: list[tuple[int, int]], i: int) -> int:
    """Level of the gap before unit ``i``: the smaller, the more natural a cut there."""
    left, right = spans[i - 1], spans[i]
    gap = text[left[1] : right[0]]
    if not gap:
        return CHARACTER
    breaks = len(_BREAK.findall(gap))
    if breaks:
        if _HEADING.match(text[right[0] : right[1]]):
            return SECTION
        return PARAGRAPH if breaks > 1 or "\N{PARAGRAPH SEPARATOR}" in gap else LINE
    return SENTENCE if _ENDS.search(text, max(left[0], left[1] - 12), left[1]) else WORD


def cuts(text: str, spans: list[tuple[int, int]], limit: int, overlap: int, max_chars: int | None = None) -> list[tuple[int, int]]:
    """Ranges of units of the pieces.

    Sections, of those that don't fit paragraphs, of these lines and so on, are packed greedily: a
    piece ends at the last gap of the most natural level that the space left for it has. A gap
    between words or within one is the last resort. Every later piece begins ``overlap`` units
    before the end of the piece before it.
    """
    n, start, done, out = len(spans), 0, 0, []
    overlap = max(0, min(overlap, limit - 1))
    gaps: list[list[int]] = [[] for _ in range(WORD + 1)]  # by level
    for i in range(1, n):
        if (level := boundary(text, spans, i)) <= WORD:
            gaps[level].append(i)
    while True:
        end = min(start + limit, n)
        if max_chars is not None:
            while end > done + 1 and spans[end - 1][1] - spans[start][0] > max_chars:
                end -= 1
        if end == n:
            out.append((start, n))
            return out
        first = min(max(done + 1, start + overlap + 1), end)
        at = next((g[k - 1] for g in gaps if (k := bisect_right(g, end)) and g[k - 1] >= first), end)
        out.append((start, at))
        start, done = max(at - overlap, start + 1), at
        while max_chars is not None and start < at and spans[at][1] - spans[start][0] > max_chars:
            start += 1  # the overlap gives way to the limit on characters


def body_start(text: str, section_path: str | None) -> int:
    """Offset behind the breadcrumb that a text begins with; 0 if it lacks it."""
    if not section_path or not section_path.strip():
        return 0
    lead = len(text) - len(text.lstrip())
    crumb = section_path.strip()
    end = lead + len(crumb)
    return end if text.startswith(crumb, lead) and (end == len(text) or text[end].isspace()) else 0


def _split(max_chars: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw_id, text, path, file_path, index, kind, limit, overlap in zip(*(c.to_pylist() for c in batch.columns)):
                if white_count(text) - white_count(path) <= limit:
                    continue
                body = text[body_start(text, path) :]
                spans = units(body, max_chars)
                ranges = cuts(body, spans, max(1, limit), overlap or 0, max_chars)
                for k, (a, b) in enumerate(ranges):
                    shared = ranges[k - 1][1] - a if k else 0
                    rows.append((raw_id, kind, file_path, path, k, len(ranges), (index or 0) + k, b - a, shared, body[spans[a][0] : spans[b - 1][1]]))
            columns = list(zip(*rows)) or [()] * 10
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return run


def one_limit(limits: DataFrame) -> DataFrame:
    """One row per doc_type: repeated rows leave the smallest limits."""
    names = ("max_words", "overlap_words", "container_words")
    return limits.where(F.col("doc_type").isNotNull()).groupBy("doc_type").agg(*(F.min(c).alias(f"_{c}") for c in names))


def may_exceed(text: Column, words: Column) -> Column:
    """Cheap necessary condition for more than ``words`` words: each takes a character and a blank."""
    return F.length(text) > 2 * words


def split_oversized(chunks: DataFrame, limits: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Pieces of the rows whose text has more words than ``max_words`` of their doc_type.

    The measure is the words of text less those of section_path, which texts normally repeat as
    their first line. Pieces are parts of the text behind that line, so text = breadcrumb + pieces
    without their first ``overlap_words`` words. ``max_chars`` also bounds a piece's characters
    and is the only case in which a word is cut; the default leaves words whole.

    Defined results: a null text, and a doc_type that is null or lacks a limit, give no piece; a
    null chunk_index counts from 0; repeated rows are split each; an overlap of the limit or more
    is taken as one word less than the limit. Columns of other names are ignored.

    The filter on length runs in the JVM, so that only texts that can be oversized reach Python;
    there is no shuffle.
    """
    rows = chunks.select("raw_id", "text", "section_path", "file_path", "chunk_index", "doc_type")
    rows = rows.join(one_limit(limits).select("doc_type", "_max_words", "_overlap_words"), "doc_type")
    rows = rows.where(F.col("_max_words").isNotNull() & may_exceed(F.col("text"), F.col("_max_words")))
    order = ("raw_id", "text", "section_path", "file_path", "chunk_index", "doc_type", "_max_words", "_overlap_words")
    return rows.select(*order).mapInArrow(_split(max_chars), PIECES)


def oversized(pieces: DataFrame) -> DataFrame:
    """The rows that were split, one each."""
    return pieces.where(F.col("piece_no") == 0).select("raw_id")
