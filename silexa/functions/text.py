"""Column expressions on text: words, lines, breadcrumbs and names. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's split sees it: Unicode's, and the separators U+001C to U+001F.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
WORD = r"(?U)[^\s\x1c-\x1f]+"
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def word_count(text: Column) -> Column:
    """Number of white-space separated words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def words(text: Column) -> Column:
    """The words in order; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def lines(text: Column) -> Column:
    """Lines without their ends; a final end adds no empty line, and '' has no line."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_ENDS)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def breadcrumb(path: Column) -> Column:
    """Headings joined by ' > '."""
    return F.array_join(path, " > ")


def headings(section_path: Column) -> Column:
    """The headings of a section path; blank gives none."""
    return F.filter(F.split(F.coalesce(section_path, F.lit("")), r"\s*>\s*"), lambda h: F.trim(h) != "")


def with_breadcrumb(section_path: Column, body: Column) -> Column:
    """Text of a chunk: its breadcrumb, a blank line, its body; without a breadcrumb just the body."""
    path = F.coalesce(section_path, F.lit(""))
    return F.when(path == "", body).otherwise(F.concat(path, F.lit("\n\n"), body))


def content_words(text: Column, section_path: Column) -> Column:
    """Words of a chunk without those of its repeated breadcrumb."""
    return word_count(text) - word_count(section_path)


def paragraphs(parts: Column) -> Column:
    """Parts joined by blank lines; empty ones are left out."""
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), "\n\n")


def squashed(name: Column) -> Column:
    """A name without dashes and underscores, in lower case."""
    return F.lower(F.translate(name, "-_", ""))


def unescaped(name: Column) -> Column:
    r"""``\_``, ``\%`` and ``\&`` as the characters they stand for, without blanks around."""
    plain = name
    for c in "_%&":
        plain = F.replace(plain, F.lit("\\" + c), F.lit(c))
    return F.trim(plain)


def tidy(text: Column) -> Column:
    """Runs of blanks as one, at most one empty line in a row, no blanks at the ends of lines."""
    flat = F.regexp_replace(text, r"[ \t]+", " ")
    flat = F.regexp_replace(F.regexp_replace(flat, r" *\n *", "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(flat, r"^\s+|\s+$", "")


def one_line(text: Column) -> Column:
    """Line ends and the blanks around them as one blank."""
    return F.trim(F.regexp_replace(text, r"\s*\n\s*", " "))


def without_comments(text: Column) -> Column:
    """LaTeX text without what follows an unescaped percent sign."""
    return F.regexp_replace(text, r"(?<!\\)%[^\n]*", "")


#: Macros whose argument isn't read, and all that is no word in LaTeX text: these with their arguments, math, other macros with their options, signs.
_UNREAD = "label ref hyperref cite includegraphics usepackage documentclass"
_MARKUP = "|".join([
    rf"\\(?:{'|'.join(_UNREAD.split())})\s*(?:\[[^\]]*\]\s*)?\{{[^}}]*\}}",
    r"\$[^$]*\$",
    r"\\[A-Za-z@]+\*?(?:\s*\[[^\]]*\])?",
    r"\\\\",
    r"[{}&~^_]",
])


def latex_words(text: Column) -> Column:
    """Approximate number of readable words of LaTeX text: markup, math, labels and braces count for none."""
    return word_count(F.regexp_replace(text, _MARKUP, " "))


def document_name(link: Column, base: Column) -> Column:
    """The page a link on a page of folder ``base`` points to; web and mail links give ''.

    The anchor is dropped, ``.`` and ``..`` are resolved, and leading dots and slashes removed.
    """
    bare = F.substring_index(F.coalesce(link, F.lit("")), "#", 1)
    joined = F.when(bare.startswith("/"), bare).otherwise(F.concat_ws("/", F.nullif(base, F.lit("")), bare))
    empty = F.array().cast("array<string>")
    up = lambda done, part: F.when((F.size(done) > 0) & (F.element_at(done, -1) != ".."), F.slice(done, 1, F.size(done) - 1)).otherwise(F.array_append(done, part))
    step = lambda done, part: F.when(part.isin("", "."), done).when(part == "..", up(done, part)).otherwise(F.array_append(done, part))
    resolved = F.array_join(F.aggregate(F.split(joined, "/"), empty, step), "/")
    away = bare.rlike(r"^(https?://|mailto:)") | (bare == "")
    plain = F.regexp_replace(bare, r"^/+|/+$", "")
    return F.when(away, "").when(F.coalesce(base, F.lit("")) == "", plain).otherwise(F.regexp_replace(resolved, r"^[./]+", ""))


def source_title(section_path: Column, text: Column, file_path: Column) -> Column:
    """Title of a chunk: its first heading, else the first line of its text, else the stem of its path."""
    head = F.get(headings(section_path), F.lit(0))
    first = F.trim(F.get(lines(text), F.lit(0)))
    stem = F.regexp_replace(F.substring_index(file_path, "/", -1), r"(.)\.[^.]*$", "$1")
    return F.coalesce(F.nullif(head, F.lit("")), F.nullif(first, F.lit("")), stem)


def repository_path(url: Column, prefix: str) -> Column:
    """Path within a repository of a link ``prefix``/(blob|tree|raw)/<version>/<path>; '' for other links."""
    quoted = "".join(c if c.isalnum() or c in "/:" else "\\" + c for c in prefix.rstrip("/"))
    return F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), rf"^{quoted}/(?:blob|tree|raw)/[^/]+/([^#?]+)", 1), "/+$", "")


def without_nul(text: Column) -> Column:
    return F.translate(text, "\0", "")
