"""The best record of each group of rows that deliver one passage again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silexa.functions.totals import total_array
from silexa.session import cut

#: White space of Unicode in Java's notation (a class of its own is read far faster than ``(?U)\\s``).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = f"[{WHITE}]+"
#: Rounds of estimation at most, and the change of every quality below which it ends.
ROUNDS, SETTLED = 30, 1e-4
#: Sources that may be told apart: their qualities are held by every task.
MOST_SOURCES = 1_000_000
#: Pseudo-counts (hit, miss) of a source's sensitivity, of its false claims, and of a value's truth.
SENSITIVITY, FALSE_CLAIMS, TRUTH = (4.0, 2.0), (1.0, 9.0), (1.0, 1.0)


def page_key(path: Column) -> Column:
    """One spelling of a page's path: blanks, slashes, ``.`` parts, endings and letter case don't count; blank gives null."""
    key = F.lower(F.regexp_replace(path, BLANKS, ""))
    key = F.regexp_replace(F.translate(key, "\\", "/"), r"(^|/)(\.?/)+", "$1")
    key = F.regexp_replace(F.regexp_replace(key, r"^/+|/+$", ""), r"\.[a-z0-9]+$", "")
    return F.when(key != "", key)


def spaced(text: Column) -> Column:
    """The words of a text joined by single blanks."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def listed(values: Column) -> Column:
    """Distinct non-blank entries of a list; null gives none."""
    kept = F.filter(values, lambda v: F.coalesce(v.rlike(f"[^{WHITE}]"), F.lit(False)))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def _keyed(chunks: DataFrame, builds: DataFrame) -> DataFrame:
    """Rows that have a page and a word, with group key, recency and trust; written once, without texts."""
    about = builds.where(F.col("build_id").isNotNull()).groupBy("build_id").agg(F.max("built_at").alias("_built"), F.max("trust").alias("_trust"))
    rows = chunks.select("raw_id", "text", "file_path", "chips", "symbol_refs", "chunk_index", "build_id")
    # the filters look for one character; texts are rewritten once, for the key
    rows = rows.where(F.col("text").rlike(f"[^{WHITE}]") & page_key(F.col("file_path")).isNotNull())
    key = F.unhex(F.md5(F.concat_ws("\n", page_key(F.col("file_path")), spaced(F.col("text"))).cast("binary")))
    return cut(rows.withColumn("_key", key).drop("text").join(about, "build_id", "left"), "keyed")


def _best(field: str, *order: Column, given: Column | None = None, value: Column | None = None) -> Column:
    """The row of highest ``order``; nulls come last and the smallest raw_id breaks ties."""
    parts = [c.alias(f"o{k}") for k, c in enumerate(order)] + [(-F.col("raw_id")).alias("r")] + ([value.alias("v")] if value is not None else [])
    row = F.struct(*parts)
    return F.max(F.when(given, row) if given is not None else row).alias(field)


def survivors(chunks: DataFrame, builds: DataFrame) -> DataFrame:
    """One record for each group of two or more rows of one page with the same words in the same order.

    group_id (smallest raw_id), rows; chips_true and symbols_true, the (value, probability) of every
    value that the quality of the group's sources, as estimated over all groups, makes true (see
    ``true_values``), in the order of values; and for each field the row of highest standing:
    its raw_id (chips_from, index_from, symbols_from, path_from) and its values (chips,
    chunk_index, symbol_refs, file_path), by the rules of the project: the most distinct
    non-blank chips, then the most recent row; the most recent row that has a chunk_index; the
    most distinct non-blank symbol_refs, then the most trusted, then the most recent row; the
    most trusted, then the most recent row; the smallest raw_id breaks ties. A row is as recent
    and as trusted as its build; without a build or value it is the oldest or least trusted.

    Rows are reduced by aggregates that are combined before the shuffle, so a group of any size
    reaches a task as one row per input partition; texts are shuffled as 16-byte keys.

    Defined results: rows with a null or blank path or without a word form no group; null lists
    have no entry, and a group without entries has empty lists of true values; a group without any
    chunk_index has a null index_from; builds given twice count with their greatest values;
    columns of other names are ignored.
    """
    rows = _keyed(chunks, builds)
    recent, trusted = F.col("_built"), F.col("_trust")
    out = rows.groupBy("_key").agg(
        F.count("*").alias("rows"),
        F.min("raw_id").alias("group_id"),
        _best("_c", F.size(listed(F.col("chips"))), recent, value=F.col("chips")),
        _best("_i", recent, given=F.col("chunk_index").isNotNull(), value=F.col("chunk_index")),
        _best("_s", F.size(listed(F.col("symbol_refs"))), trusted, recent, value=F.col("symbol_refs")),
        _best("_p", trusted, recent, value=F.col("file_path")),
    )
    out = out.where(F.col("rows") > 1)
    named = {"_c": ("chips_from", "chips"), "_i": ("index_from", "chunk_index"), "_s": ("symbols_from", "symbol_refs"), "_p": ("path_from", "file_path")}
    columns = [(-F.col(f"{k}.r")).alias(a) for k, (a, _) in named.items()] + [F.col(f"{k}.v").alias(b) for k, (_, b) in named.items()]
    kept = _judged(_claims(rows)).where("kept").groupBy("group_id").pivot("field", ["chips", "symbol_refs"]).agg(F.array_sort(F.collect_list(F.struct("value", "probability"))))
    kept = kept.select("group_id", F.col("chips").alias("chips_true"), F.col("symbol_refs").alias("symbols_true"))
    none = F.array().cast("array<struct<value:string,probability:double>>")
    both = out.select("group_id", "rows", *columns).join(kept, "group_id", "left")
    return both.withColumns({c: F.coalesce(c, none) for c in ("chips_true", "symbols_true")})


def _claims(keyed: DataFrame) -> DataFrame:
    """(group_id, field, value, yes, no): the builds that give a value to a group and those that deliver the group without it.

    Both lists hold each build once, however many rows the group has.
    """
    rows = keyed.select("_key", "raw_id", F.coalesce("build_id", F.lit(-1)).alias("source"), listed(F.col("chips")).alias("chips"), listed(F.col("symbol_refs")).alias("symbols"))
    several = rows.groupBy("_key").agg(F.min("raw_id").alias("group_id"), F.count("*").alias("n"), F.collect_set("source").alias("sources")).where("n > 1")
    bare = lambda s: F.regexp_replace(F.trim(s), r"\(\)$", "")
    fields = F.array(F.struct(F.lit("chips").alias("field"), F.col("chips").alias("values")), F.struct(F.lit("symbol_refs").alias("field"), F.transform("symbols", bare).alias("values")))
    told = rows.select("_key", "source", F.explode(fields).alias("f")).select("_key", "source", "f.field", F.explode("f.values").alias("value"))
    said = told.groupBy("_key", "field", "value").agg(F.collect_set("source").alias("yes"))
    joined = said.join(several, "_key").select("group_id", "field", "value", F.array_sort("yes").alias("yes"), F.array_sort(F.array_except("sources", "yes")).alias("no"))
    return cut(joined, "claims")


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


class _Quality:
    """Per field and source: probability to list a true value and to list a false one; per field: share of true values."""

    def __init__(self, sources: list[int]) -> None:
        self.at = {s: k for k, s in enumerate(sources)}
        self.keys = np.array(sources, np.int64)
        self.hit = np.full((2, len(sources)), SENSITIVITY[0] / sum(SENSITIVITY))
        self.false = np.full((2, len(sources)), FALSE_CLAIMS[0] / sum(FALSE_CLAIMS))
        self.true = np.full(2, 0.5)

    def posterior(self, batch: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Probability that each value is true, and (source, row) of the claims for and against."""
        field = (np.array(batch.column("field").to_pylist(), object) == "symbol_refs").astype(np.int64)
        odds = np.log(self.true[field] / (1 - self.true[field]))
        sides = []
        for name, yes in (("yes", True), ("no", False)):
            values, counts = _ragged(batch.column(name))
            row = np.repeat(np.arange(len(field)), counts)
            source = np.searchsorted(self.keys, values)
            hit, false = self.hit[field[row], source], self.false[field[row], source]
            np.add.at(odds, row, np.log(hit / false) if yes else np.log((1 - hit) / (1 - false)))
            sides.append((source, row))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500))), sides


def _expect(quality: _Quality):
    def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((2, len(quality.keys), 4))
        share = np.zeros((2, 2))
        for batch in batches:
            p, sides = quality.posterior(batch)
            field = (np.array(batch.column("field").to_pylist(), object) == "symbol_refs").astype(np.int64)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            np.add.at(share, (field, 0), n * p)
            np.add.at(share, (field, 1), n * (1 - p))
            for k, (source, row) in enumerate(sides):
                np.add.at(total, (field[row], source, k), (n * p)[row])
                np.add.at(total, (field[row], source, 2 + k), (n * (1 - p))[row])
        return np.concatenate([total.ravel(), share.ravel()])

    return fill


def _judge(quality: _Quality):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, _ = quality.posterior(batch)
            yield batch.select(["group_id", "field", "value"]).append_column("probability", pa.array(np.round(p, 6)))

    return run


def true_values(chunks: DataFrame, builds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(group_id, field, value, probability, kept): which chips and symbol_refs of a group are true.

    Latent truth with two-sided source quality: each build has a sensitivity (it lists a true
    value) and a rate of false claims (it lists a false one), per field; expectation-maximisation
    alternates the probability of every value and the qualities of the builds until these settle.
    A list may have any number of true values; those of at least one half are kept. Symbols count
    without blanks and a closing ``()``.

    Claims of the same builds for and against are alike, so rounds go over the distinct patterns
    and their numbers. What a task holds and sends are the sums of the sources, of which more than
    MOST_SOURCES raise ValueError. Rows without a build are one source (-1).

    Defined results: as in ``survivors``; a group whose rows list no value has no row here.
    """
    return _judged(_claims(_keyed(chunks, builds)), rounds)


def _judged(claims: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    patterns = cut(claims.groupBy("field", "yes", "no").agg(F.count("*").alias("n")), "patterns")
    told = patterns.select(F.explode(F.array_union("yes", "no")).alias("source")).distinct().limit(MOST_SOURCES + 1).toArrow()["source"].to_numpy()
    if len(told) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    quality = _Quality(sorted(told.tolist()))
    n = len(told)
    for _ in range(rounds if n else 0):
        total = total_array(patterns, _expect(quality), 8 * n + 4)
        before = np.concatenate([quality.hit.ravel(), quality.false.ravel(), quality.true])
        t, share = total[: 8 * n].reshape(2, n, 4), total[8 * n :].reshape(2, 2)
        quality.hit = (t[:, :, 0] + SENSITIVITY[0]) / (t[:, :, 0] + t[:, :, 1] + sum(SENSITIVITY))
        quality.false = (t[:, :, 2] + FALSE_CLAIMS[0]) / (t[:, :, 2] + t[:, :, 3] + sum(FALSE_CLAIMS))
        quality.true = (share[:, 0] + TRUTH[0]) / (share.sum(axis=1) + sum(TRUTH))
        if np.abs(np.concatenate([quality.hit.ravel(), quality.false.ravel(), quality.true]) - before).max() < SETTLED:
            break
    judged = claims.mapInArrow(_judge(quality), "group_id bigint, field string, value string, probability double")
    return judged.withColumn("kept", F.col("probability") >= 0.5)
