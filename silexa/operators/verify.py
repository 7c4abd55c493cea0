"""Audits: was anything lost on the way, and what would embedding cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silexa.functions.arrays import listed
from silexa.functions.symbols import bare_symbol, register_symbols, tokens
from silexa.functions.text import content_words, squashed, unescaped, word_count
from silexa.operators.ordering import global_position

LEAST_SOURCE_WORDS = 50


def file_stats(chunks: DataFrame) -> DataFrame:
    """Chunks, characters and content words by file."""
    words = content_words(F.col("text"), F.col("section_path"))
    return chunks.groupBy("file_path").agg(F.count("*").alias("chunks"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.sum(words).alias("words"))


def capture_rates(stats: DataFrame, sources: DataFrame, ending: str | None = None) -> DataFrame:
    """Words of a file's chunks in percent of the words of its source; null below LEAST_SOURCE_WORDS.

    ``sources``: file_path, source_words. Files without a source come out with ``missing``. With
    ``ending`` (such as .tex), a path without a source of its own takes that of the path with the
    ending or, if it has the ending, of the path without it.
    """
    both = stats.join(sources, "file_path", "left")
    if ending:
        path = F.col("file_path")
        bare = F.when(path.endswith(ending), F.substring(path, F.lit(1), F.length(path) - len(ending)))
        for n, other in enumerate((F.concat(path, F.lit(ending)), bare)):
            told = sources.select(F.col("file_path").alias(f"_path{n}"), F.col("source_words").alias(f"_words{n}"))
            both = both.join(told, other == F.col(f"_path{n}"), "left")
        both = both.withColumn("source_words", F.coalesce("source_words", "_words0", "_words1"))
    rate = F.when(F.col("source_words") >= LEAST_SOURCE_WORDS, 100 * F.col("words") / F.col("source_words"))
    return both.select("file_path", "chunks", "words", "source_words", F.round(rate, 4).alias("capture"), F.col("source_words").isNull().alias("missing"))


def thin_files(rates: DataFrame, least: float = 80.0) -> DataFrame:
    """Files that capture less than ``least`` percent, or less than half of the median."""
    floor = rates.where(F.col("capture").isNotNull()).agg((F.median("capture") / 2).alias("floor"))
    flagged = rates.crossJoin(F.broadcast(floor)).where((F.col("capture") < least) | (F.col("capture") < F.col("floor")))  # floor is one row
    return flagged.select("file_path", "capture", F.round("floor", 4).alias("floor"))


def heavy_files(stats: DataFrame, sizes: DataFrame, most: float = 20_000.0) -> DataFrame:
    """Files with more source characters per chunk than ``most``; sizes: file_path, source_chars."""
    ratio = F.col("source_chars") / F.greatest("chunks", F.lit(1))
    return stats.join(sizes, "file_path").withColumn("chars_per_chunk", F.round(ratio, 4)).where(ratio > most).select("file_path", "chunks", "source_chars", "chars_per_chunk")


def census(registers: DataFrame) -> DataFrame:
    """Definitions of registers, one per chip, chapter and plain name, with whether the name has placeholders."""
    rows = registers.where(F.col("name").isNotNull() & (F.trim("name") != ""))
    bank = F.col("parameterised") | F.col("name").rlike(r"[{$]")
    return rows.select("chip", "chapter", unescaped(F.col("name")).alias("name"), bank.alias("bank")).distinct()


def census_totals(registers: DataFrame) -> DataFrame:
    """Rows as delivered, checkable names and banks by chip, and their TOTAL: the sum of the chips, not of distinct names."""
    by = registers.groupBy("chip").agg(F.count("*").alias("rows"), F.sum(F.when(F.col("name").isNull() | (F.trim("name") == ""), 1).otherwise(0)).alias("unreadable"))
    names = census(registers).select("chip", "name", "bank").distinct().groupBy("chip").agg(F.sum((~F.col("bank")).cast("int")).alias("checkable"), F.sum(F.col("bank").cast("int")).alias("banks"))
    per = by.join(names, "chip", "left").na.fill(0, ["checkable", "banks"])
    sums = [F.sum(c).alias(c) for c in ("rows", "unreadable", "checkable", "banks")]
    return per.rollup("chip").agg(*sums, F.grouping("chip").alias("total")).select(F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("chip")).alias("chip"), "rows", "unreadable", "checkable", "banks")


def chip_tokens(chunks: DataFrame) -> DataFrame:
    """(key, token): the identifiers in the chunks of each chip; key is the squashed chip."""
    rows = chunks.select(squashed(F.coalesce("chip", F.lit(""))).alias("key"), F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    return rows.distinct()


def census_check(registers: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chip, chapter, name, present) of every checkable name.

    A name is present if the chunks of its chip hold it as an identifier; a chip without any
    chunk is looked up in all of them. Names with blanks can't be identifiers and are looked for
    in the texts, a few names against the texts of their chip.
    """
    names = census(registers).where(~F.col("bank")).withColumn("key", squashed(F.col("chip"))).drop("bank")
    have = chip_tokens(chunks)
    known = have.select("key").distinct().withColumn("known", F.lit(True))
    spaced = F.col("name").contains(" ")
    names = names.join(known, "key", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    plain = names.where(~spaced)
    own = have.withColumnRenamed("token", "name").withColumn("hit", F.lit(True))
    pool = have.select(F.col("token").alias("name")).distinct().withColumn("any", F.lit(True))
    plain = plain.join(own, ["key", "name"], "left").join(pool, "name", "left")
    plain = plain.withColumn("present", F.coalesce(F.when(F.col("known"), F.col("hit")).otherwise(F.col("any")), F.lit(False)))
    texts = chunks.select(squashed(F.coalesce("chip", F.lit(""))).alias("text_key"), "text").where(F.col("text").isNotNull())
    odd = names.where(spaced).select("key", "known", "name").distinct()
    seen = odd.join(texts, (F.col("key") == F.col("text_key")) & F.col("known") & F.col("text").contains(F.col("name")), "left_semi").select("key", "name").withColumn("present", F.lit(True))
    odd = names.where(spaced).join(seen, ["key", "name"], "left").withColumn("present", F.coalesce("present", F.lit(False)))
    columns = ["chip", "chapter", "name", "present"]
    return plain.select(columns).unionByName(odd.select(columns))


def census_rates(checked: DataFrame) -> DataFrame:
    """Names, found ones and their percentage by chip and in total (100 where there are no names)."""
    per = checked.groupBy("chip", "name").agg(F.max("present").alias("present")).groupBy("chip").agg(F.count("*").alias("names"), F.count_if("present").alias("found"))
    both = per.rollup("chip").agg(F.sum("names").alias("names"), F.sum("found").alias("found"), F.grouping("chip").alias("total"))
    percent = F.when(F.coalesce("names", F.lit(0)) == 0, 100.0).otherwise(F.round(100 * F.col("found") / F.col("names"), 4))
    return both.select(F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("chip")).alias("chip"), "names", "found", percent.alias("percent"))


def chapter_hits(checked: DataFrame) -> DataFrame:
    """Names and found ones of each chapter."""
    names = checked.groupBy("chip", "chapter", "name").agg(F.max("present").alias("present"))
    out = names.groupBy("chip", "chapter").agg(F.count("*").alias("names"), F.count_if("present").alias("found"))
    return out.withColumn("percent", F.round(100 * F.col("found") / F.col("names"), 4))


def worst_chapters(hits: DataFrame, n: int = 20) -> DataFrame:
    """The report of the ``n`` chapters that miss most."""
    return hits.where("percent < 100").orderBy("percent", "chip", "chapter").limit(n)


def missing_names(checked: DataFrame, per_chip: int = 20, most: int | None = None) -> DataFrame:
    """The report of the first missing names of each chip; of these the first ``most`` by chip and name, if given."""
    order = Window.partitionBy("chip").orderBy("name")
    gone = checked.groupBy("chip", "name").agg(F.max("present").alias("present")).where(~F.col("present"))
    first = gone.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_chip).select("chip", "name", "n")
    return first if most is None else first.orderBy("chip", "n").limit(most)


def gate(checked: DataFrame, most_missing: float = 2.0) -> DataFrame:
    """One row: the share of missing names in percent and whether it is within the bound."""
    per = checked.groupBy("chip", "name").agg(F.max("present").alias("present"))
    missing = F.coalesce(100 * (1 - F.count_if("present") / F.nullif(F.count("*"), F.lit(0))), F.lit(0.0))
    return per.agg(F.round(missing, 4).alias("shortfall")).withColumn("passed", F.col("shortfall") <= most_missing)


def cross_resolution(registers: DataFrame, chunks: DataFrame) -> DataFrame:
    """Names of the manuals that the headers of the same chip declare, by chip and in total."""
    named = census(registers).select("chip", F.explode(register_symbols(F.col("name"))).alias("symbol")).distinct()
    declared = chunks.where("doc_type = 'src'").select(F.explode("chips").alias("chip"), listed(F.col("symbol_refs")).alias("s")).select("chip", F.explode("s").alias("s"))
    declared = declared.select("chip", bare_symbol(F.col("s")).alias("symbol")).where("chip IS NOT NULL AND symbol <> ''").distinct().withColumn("hit", F.lit(1))
    both = named.join(declared, ["chip", "symbol"], "left").rollup("chip").agg(F.count("*").alias("names"), F.count("hit").alias("declared"), F.grouping("chip").alias("total"))
    return both.select(F.when(F.col("total") == 1, "TOTAL").otherwise(F.col("chip")).alias("chip"), "names", "declared", F.round(100 * F.col("declared") / F.greatest("names", F.lit(1)), 4).alias("percent"))


def unknown_tokens(docs: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Identifiers in upper case that no known name is, how often each occurs, and the first document with it."""
    found = docs.select(F.col(key), F.explode(tokens(F.col("text"))).alias("token")).where(F.col("token").rlike("^[A-Z]+_[A-Z0-9_]+$"))
    counted = found.groupBy("token").agg(F.count("*").alias("n"), F.min(key).alias("example"))
    return counted.join(known.select(unescaped(F.col("name")).alias("token")).distinct(), "token", "left_anti")


def length_batches(docs: DataFrame, key: str, size: int = 32) -> DataFrame:
    """Batches of ``size`` texts in order of length: (key, length, position, batch)."""
    rows = docs.select(key, F.coalesce(F.length("text"), F.lit(0)).alias("length"))
    placed = global_position(rows, [F.col("length"), F.col(key)])
    return placed.withColumn("batch", F.floor(F.col("position") / size))


def padding_tax(batches: DataFrame) -> DataFrame:
    """What padding every batch to its longest text costs: padded and real lengths, and their ratio."""
    per = batches.groupBy("batch").agg((F.max("length") * F.count("*")).alias("padded"), F.sum("length").alias("real"))
    return per.agg(F.sum("padded").alias("padded"), F.sum("real").alias("real"), F.round(F.sum("padded") / F.greatest(F.sum("real"), F.lit(1)), 4).alias("tax"))


def store_summary(chunks: DataFrame) -> DataFrame:
    """Rows, files, vectors of the right length and rows with symbols and revisions, by collection."""
    return chunks.groupBy("doc_type").agg(
        F.count("*").alias("rows"),
        F.count_distinct("file_path").alias("files"),
        F.count_if(F.size("vector") == 64).alias("full_vectors"),
        F.count_if(F.size(listed(F.col("symbol_refs"))) > 0).alias("with_symbols"),
        F.count_if(F.size(listed(F.col("revisions"))) > 0).alias("with_revisions"),
    )


def missing_columns(rows: DataFrame, wanted: dict[str, str]) -> list[str]:
    """Columns that a table lacks or has in another type."""
    have = dict(rows.dtypes)
    return sorted(c for c, t in wanted.items() if have.get(c) != t)


def chip_drift(chunks: DataFrame, chips: DataFrame) -> DataFrame:
    """Revisions that chunks of a chip have but the catalogue lacks (extra), or the other way round (absent)."""
    seen = chunks.where("coalesce(chip, '') <> ''").select("chip", F.explode("revisions").alias("revision")).where("revision IS NOT NULL").distinct().withColumn("seen", F.lit(True))
    told = chips.select("chip", F.explode("revisions").alias("revision")).distinct().withColumn("told", F.lit(True))
    both = seen.join(told, ["chip", "revision"], "full").where("seen IS NULL OR told IS NULL")
    return both.select("chip", "revision", F.when(F.col("seen").isNull(), "absent").otherwise("extra").alias("drift"))


def self_search(chunks: DataFrame, sample: DataFrame) -> DataFrame:
    """For each chunk of ``sample`` (chunk_id; a few rows) the smallest id at distance 0 from it, which has to be its own or a copy's."""
    from silexa.operators.search import squared_distance

    asked = sample.join(chunks, "chunk_id").select(F.col("chunk_id").alias("query_id"), F.col("vector").alias("q"))
    both = chunks.select("chunk_id", "vector").crossJoin(F.broadcast(asked)).withColumn("d", squared_distance(F.col("vector"), F.col("q")))  # a few queries by all rows
    return both.where("d IS NOT NULL AND NOT isnan(d)").groupBy("query_id").agg(F.min(F.struct("d", "chunk_id")).alias("m")).select("query_id", F.col("m.chunk_id").alias("nearest_id"), F.round("m.d", 4).alias("distance"))


def sample_rows(chunks: DataFrame, key: str = "chunk_id", n: int = 5, seed: int = 0) -> DataFrame:
    """Up to ``n`` rows to look at, the same ones for the same rows and seed."""
    return chunks.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def symbols_gained(refreshed: DataFrame) -> DataFrame:
    """One row: how many rows of a backfill have symbols, and how many distinct names these are."""
    have = refreshed.agg(F.count_if(F.size(listed(F.col("symbol_refs"))) > 0).alias("rows"))
    names = refreshed.select(F.explode("symbol_refs").alias("s")).agg(F.count_distinct("s").alias("names"))
    return have.crossJoin(names)  # one row each


def word_totals(docs: DataFrame) -> DataFrame:
    return docs.agg(F.sum(word_count(F.col("text"))).alias("words"))
