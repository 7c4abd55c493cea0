"""Section trees of parsed documents, and their chunks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

MOST_WORDS, LEAST_WORDS = 400, 50
CHUNKS = (
    "file_path string, chunk_index int, section_path string, text string, file_refs array<string>, "
    "doc_refs array<string>, symbol_refs array<string>, error string"
)


@dataclass
class Refs:
    """What a passage refers to; each list holds a value once, in order of first sight."""

    files: list[str] = field(default_factory=list)
    docs: list[str] = field(default_factory=list)
    symbols: list[str] = field(default_factory=list)

    @staticmethod
    def union(parts: Iterable[Refs]) -> Refs:
        out = Refs()
        for p in parts:
            for name in ("files", "docs", "symbols"):
                setattr(out, name, list(dict.fromkeys([*getattr(out, name), *getattr(p, name)])))
        return out


@dataclass
class Block:
    """A passage that stays together; an atomic one is never cut, whatever its size."""

    text: str
    refs: Refs = field(default_factory=Refs)
    atomic: bool = False


@dataclass
class Section:
    title: str = ""
    blocks: list[Block] = field(default_factory=list)
    children: list[Section] = field(default_factory=list)


def _n(text: str) -> int:
    return len(text.split())


def subtree_words(section: Section) -> int:
    """Words of a section and all below it, with the titles below it."""
    return sum(_n(b.text) for b in section.blocks) + sum(_n(c.title) + subtree_words(c) for c in section.children)


def _rendered(section: Section) -> Block:
    own = [b.text for b in section.blocks if b.text]
    below = [(c.title, _rendered(c)) for c in section.children]
    parts = own + ["\n\n".join(x for x in (title, b.text) if x) for title, b in below]
    return Block("\n\n".join(p for p in parts if p), Refs.union([*(b.refs for b in section.blocks), *(b.refs for _, b in below)]))


def line_pieces(block: Block, most: int) -> list[Block]:
    """Whole lines put together up to ``most`` words; a longer line becomes windows of words. All pieces keep all refs."""
    out: list[Block] = []
    held: list[str] = []
    total = 0

    def close() -> None:
        nonlocal total
        if held:
            out.append(Block("\n".join(held), block.refs))
        held.clear()
        total = 0

    for line in block.text.splitlines():
        words = line.split()
        if held and total + len(words) > most:
            close()
        if len(words) > most:
            out += [Block(" ".join(words[k : k + most]), block.refs) for k in range(0, len(words), most)]
        else:
            held.append(line)
            total += len(words)
    close()
    return out


def packed(blocks: list[Block], most: int) -> list[Block]:
    """Blocks put together in order up to ``most`` words; larger ones stand alone, cut by lines unless atomic."""
    groups: list[list[Block]] = []
    room = 0  # of the last group; 0 closes it
    for b in blocks:
        n = _n(b.text)
        if n > most:
            groups += [[p] for p in ([b] if b.atomic else line_pieces(b, most))]
            room = -1
        elif groups and room >= n:
            groups[-1].append(b)
            room -= n
        else:
            groups.append([b])
            room = most - n
    return [Block("\n\n".join(b.text for b in g), Refs.union(b.refs for b in g)) for g in groups]


def chunks_of(root: Section, file_path: str, most: int = MOST_WORDS, least: int = LEAST_WORDS) -> list[dict]:
    """Chunks of a document, in order: a section with all below it where that fits, else its own blocks and then its children; small chunks join a neighbour."""
    found: list[tuple[list[str], Block]] = []
    waiting = [([root.title] if root.title else [], root)]
    while waiting:
        path, section = waiting.pop()
        if subtree_words(section) <= most:
            found.append((path, _rendered(section)))
        else:
            found += [(path, b) for b in packed(section.blocks, most)]
            waiting += [([*path, c.title], c) for c in reversed(section.children)]
    rows = []
    for path, block in found:
        if block.text.strip():
            crumb = " > ".join(path)
            rows.append((crumb, f"{crumb}\n\n{block.text}" if crumb else block.text, block.refs))
    out = merged(rows, least)
    return [
        {"file_path": file_path, "chunk_index": k, "section_path": crumb, "text": text, "file_refs": refs.files, "doc_refs": refs.docs, "symbol_refs": refs.symbols, "error": None}
        for k, (crumb, text, refs) in enumerate(out)
    ]


def merged(rows: list[tuple[str, str, Refs]], least: int) -> list[tuple[str, str, Refs]]:
    """Chunks under ``least`` content words join the one before; a small first one joins the one behind, whose path stays."""
    small = lambda r: _n(r[1]) - _n(r[0]) < least
    join = lambda a, b, crumb: (crumb, f"{a[1]}\n\n{b[1]}", Refs.union([a[2], b[2]]))
    out: list[tuple[str, str, Refs]] = []
    for r in rows:
        if out and small(r):
            out[-1] = join(out[-1], r, out[-1][0])
        else:
            out.append(r)
    if len(out) > 1 and small(out[0]):
        out[:2] = [join(out[0], out[1], out[1][0])]
    return out
