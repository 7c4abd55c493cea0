"""Identifiers: finding them in text, their spellings, ranges, and what they apply to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silexa.functions.arrays import contains_all, listed
from silexa.functions.text import word_count

# Patterns of identifiers and of the line with which a register begins.
TOKEN = r"[A-Za-z][A-Za-z0-9_]{2,}"
REGISTER_HEADER = r"Register ([A-Za-z0-9_]+)\s*(?:\([^)]*\))?\s* at address"
FIELD = r"^[A-Z][A-Z0-9_]{3,}$"
#: Members of a bank of registers that are spelled out at most, and words of a banner at most.
MOST_MEMBERS, BANNER_WORDS = 64, 12


def tokens(text: Column) -> Column:
    """All identifiers of a text of three or more characters; null gives none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def documented_registers(text: Column) -> Column:
    """Registers whose description begins in the text, each once; the range of a bank is dropped."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(REGISTER_HEADER), F.lit(1)))


def register_symbols(name: Column) -> Column:
    """Names under which a register is found: ``X_n (n: 0-2)`` gives X_n, X_0, X_1, X_2.

    Only the first occurrence of the letter is the number. Ranges of more than MOST_MEMBERS, or
    without the letter in the name, give the name alone; '' and 'unknown' give none.
    """
    bare = F.trim(name)
    base, rest = F.rtrim(F.substring_index(bare, "(", 1)), F.trim(F.substring_index(bare, "(", -1))
    inner = F.split(F.rtrim(F.rtrim(rest), F.lit(")")), ":")
    letter, bounds = F.trim(F.get(inner, F.lit(0))), F.split(F.get(inner, F.lit(1)), "[-~]")
    low, high = (F.trim(F.get(bounds, F.lit(k))).try_cast("int") for k in (0, 1))
    bank = bare.endswith(")") & (F.size(F.split(bare, r"\(")) == 2) & (F.size(inner) == 2) & (F.size(bounds) == 2)
    bank = bank & letter.rlike("^[A-Za-z]$") & low.isNotNull() & high.isNotNull() & base.rlike(r"^\S+$")
    at = F.position(letter, base)
    spelled = F.transform(F.sequence(low, high), lambda i: F.concat(F.substr(base, F.lit(1), at - 1), i.cast("string"), F.substr(base, at + 1)))
    none = F.array().cast("array<string>")
    fits = (high >= low) & (high - low < MOST_MEMBERS) & (at > 0)
    many = F.array_distinct(F.concat(F.array(base), F.when(fits, spelled).otherwise(none)))
    return F.when(name.isNull() | (bare == "") | (name == "unknown"), none).when(F.coalesce(bank, F.lit(False)), many).otherwise(F.array(bare))


def field_symbols(names: Column) -> Column:
    """Names of bit fields that are worth a lookup, each once."""
    return F.array_distinct(F.filter(listed(names), lambda n: n.rlike(FIELD) & (F.lower(n) != "reserved")))


def bit_range(width: Column, position: Column) -> Column:
    """``[hi:lo]`` or ``[bit]``; '' where a part isn't a number."""
    w, p = F.trim(width).try_cast("int"), F.trim(position).try_cast("int")
    text = F.when(w > 1, F.concat(F.lit("["), (p + w - 1).cast("string"), F.lit(":"), F.trim(position), F.lit("]")))
    return F.coalesce(F.when(w.isNotNull() & p.isNotNull(), text.otherwise(F.concat(F.lit("["), F.trim(position), F.lit("]")))), F.lit(""))


def _directive(line: Column, name: str) -> Column:
    """What follows a directive of the preprocessor; null if the line is none of that name."""
    after = F.ltrim(F.substr(F.ltrim(line), F.lit(2)))
    return F.when(F.ltrim(line).startswith("#") & after.rlike(rf"^{name}\b"), F.trim(F.substr(after, F.lit(len(name) + 1))))


def include_of(line: Column) -> Column:
    """The file that a line includes, or ''."""
    told = _directive(line, "include")
    inner = F.substr(told, F.lit(2))
    found = F.when(told.startswith("<"), F.substring_index(inner, ">", 1)).when(told.startswith('"'), F.substring_index(inner, '"', 1))
    return F.coalesce(found, F.lit(""))


def defined_by(line: Column) -> Column:
    """The macro that a line defines, or ''."""
    return F.coalesce(F.regexp_extract(_directive(line, "define"), "^[A-Za-z_][A-Za-z0-9_]*", 0), F.lit(""))


def banner_title(line: Column) -> Column:
    """Heading of a line that holds nothing but a short comment, else null."""
    bare = F.trim(line)
    alone = bare.startswith("/*") & bare.endswith("*/") & (F.instr(bare, "*/") == F.length(bare) - 1)
    title = F.btrim(F.btrim(bare, F.lit("/")), F.lit("-=* \t"))
    return F.when(alone & title.rlike(r"(?U)\p{L}") & (word_count(title) <= BANNER_WORDS), title)


def bare_symbol(symbol: Column) -> Column:
    """A symbol without blanks around it and without a closing ``()``."""
    return F.regexp_replace(F.trim(symbol), r"\(\)$", "")


def mentions(refs: Column, symbol: Column) -> Column:
    """Whether a list holds the symbol in either spelling, ``foo`` or ``foo()``; case counts."""
    bare = bare_symbol(symbol)
    return F.coalesce(F.arrays_overlap(F.array_compact(listed(refs)), F.array(bare, F.concat(bare, F.lit("()")))), F.lit(False))


def chips_of_path(path: Column, known: list[str]) -> Column:
    """The chip that names a folder of the path, else all known chips in order."""
    everyone = F.array(*map(F.lit, sorted(known)))
    here = F.filter(F.split(path, "/"), lambda p: p.isin(*known))
    return F.when(F.size(here) > 0, F.slice(here, 1, 1)).otherwise(everyone)


def revisions_of_path(path: Column, folders: dict[str, list[str]]) -> Column:
    """Revisions that a folder of the path stands for, else none."""
    out = F.array().cast("array<string>")
    for folder, revisions in folders.items():
        out = F.when(F.array_contains(F.split(path, "/"), folder), F.array(*map(F.lit, revisions))).otherwise(out)
    return out


def revision_scope(doc_type: Column, revisions: Column, published: Column) -> Column:
    """What silicon a chunk applies to, in words; null where the question doesn't arise.

    ``published`` are the revisions of the chunk's chip. No revision of its own means an unknown
    coverage for manuals, and no revision axis for other collections.
    """
    # The wording of the labels
    own = F.array_join(F.array_sort(listed(revisions)), ", ")
    everything = (F.size(listed(published)) > 0) & contains_all(revisions, published)
    label = F.when(everything, F.concat(F.lit("all published revisions ("), own, F.lit(")"))).otherwise(F.concat(F.lit("ONLY revision "), own, F.lit(" -- does not apply to other silicon revisions")))
    return F.when(F.size(listed(revisions)) > 0, label).when(doc_type == "trm", "unknown revision coverage")
