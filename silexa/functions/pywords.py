"""Plain-Python word kernels for Arrow batches; each has one definition of a word."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

#: Maximal runs of Unicode letters, digits and underscores.
TERM = re.compile(r"\w+")
#: Unicode white space; Python's own also counts the separators U+001C to U+001F.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Maximal runs of characters that are not Unicode white space.
BLANKED = re.compile(f"[^{WHITE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def blank_count(text: str | None) -> int:
    """Number of words as Python's split parts them; null counts 0."""
    return len(text.split()) if text else 0


def white_count(text: str | None) -> int:
    """Number of words parted by Unicode white space; null counts 0."""
    if not text:
        return 0
    return len(BLANKED.findall(text)) if _SEPARATORS.search(text) else len(text.split())


def terms(text: str | None) -> list[str]:
    """Lower-case terms of a text; null gives none."""
    return TERM.findall(text.lower()) if text else []


@lru_cache(1)
def _format_characters() -> re.Pattern[str]:
    points = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf"]
    return re.compile("[" + "".join(map(re.escape, points)) + "]+")


def folded(text: str | None) -> str:
    """NFKC, lower case, without format characters (category Cf); null gives ''."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return _format_characters().sub("", unicodedata.normalize("NFKC", text).lower())
