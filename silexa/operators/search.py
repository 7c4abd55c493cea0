"""Queries of the chunk store: scope filters, vector top-k, exact symbol lookup, catalogue."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silexa.functions.arrays import listed
from silexa.functions.symbols import bare_symbol, mentions, revision_scope

DOC_TYPES = ("idf", "src", "trm")


@dataclass(frozen=True)
class Scope:
    """What a query is limited to; None leaves an axis open."""

    doc_type: str | None = None
    chip: str | None = None
    revision: str | None = None

    def check(self, known: DataFrame) -> Scope:
        """Raises ValueError for names that the chip table (13 rows in the tests) doesn't have."""
        if self.doc_type is not None and self.doc_type not in DOC_TYPES:
            raise ValueError(f"doc_type is one of {', '.join(DOC_TYPES)}")
        if self.chip is not None and known.where(F.col("chip") == self.chip).isEmpty():
            raise ValueError(f"unknown chip {self.chip!r}")
        if self.revision is not None and known.where(F.array_contains("revisions", self.revision)).isEmpty():
            raise ValueError(f"unknown revision {self.revision!r}")
        return self


def scope_filter(scope: Scope) -> Column:
    """Rows in scope. Manuals apply to their ``chip``, other collections to all of ``chips``; rows without revisions apply to every revision."""
    parts = []
    if scope.chip is not None:
        manual = (F.col("doc_type") == "trm") & (F.col("chip") == scope.chip)
        other = F.col("doc_type").isin("idf", "src") & F.array_contains(listed(F.col("chips")), scope.chip)
        parts.append(manual | other)
    if scope.doc_type is not None:
        parts.append(F.col("doc_type") == scope.doc_type)
    if scope.revision is not None:
        parts.append((F.size(listed(F.col("revisions"))) == 0) | F.array_contains(listed(F.col("revisions")), scope.revision))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def top_k(k: int, most: int) -> int:
    if not 1 <= k <= most:
        raise ValueError(f"k is between 1 and {most}")
    return k


def squared_distance(vector: Column, query: list[float] | Column) -> Column:
    """Squared Euclidean distance in double precision; null for vectors of another length."""
    q = query if isinstance(query, Column) else F.array(*map(F.lit, map(float, query)))
    zipped = F.zip_with(vector, q, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    return F.when(F.size(vector) == F.size(q), F.aggregate(zipped, F.lit(0.0), lambda x, y: x + y))


def nearest(chunks: DataFrame, query: list[float], k: int = 5, scope: Scope = Scope()) -> DataFrame:
    """The ``k`` rows in scope nearest to a vector, with ``distance``; ties go to the smaller id.

    The filter comes before the top-k, which every partition takes for itself before the last
    few rows meet: no sort of the table. Vectors that are null, of another length or not finite
    have no distance and are left out.
    """
    far = chunks.where(scope_filter(scope)).withColumn("distance", squared_distance(F.col("vector"), query))
    return far.where(F.col("distance").isNotNull() & ~F.isnan("distance")).orderBy("distance", "chunk_id").limit(top_k(k, 20))


def symbol_matches(chunks: DataFrame, symbol: str, scope: Scope = Scope()) -> DataFrame:
    """Rows in scope that refer to a symbol in either spelling."""
    if not 0 < len(symbol.strip()) <= 256:
        raise ValueError("a symbol has 1 to 256 characters")
    return chunks.where(mentions(F.col("symbol_refs"), F.lit(symbol)) & scope_filter(scope))


def interleaved(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows taken in turn from the collections, so that none is lost.

    Within a collection rows go by chip, path, position and id.
    """
    order = Window.partitionBy("doc_type").orderBy(F.coalesce("chip", F.lit("")), F.coalesce("file_path", F.lit("")), F.coalesce("chunk_index", F.lit(0)), "chunk_id")
    return rows.withColumn("tier", F.row_number().over(order)).where(F.col("tier") <= k).orderBy("tier", "doc_type").limit(k)


def find_symbol(chunks: DataFrame, symbol: str, k: int = 10, scope: Scope = Scope()) -> tuple[DataFrame, DataFrame]:
    """(totals by collection, the first rows in turn). Totals are of all matches."""
    found = symbol_matches(chunks, symbol, scope)
    return found.groupBy("doc_type").agg(F.count("*").alias("matches")), interleaved(found, top_k(k, 50))


def symbol_index(chunks: DataFrame) -> DataFrame:
    """(symbol, doc_type, chunk_id): the inverted index; written partitioned by symbol it makes lookups selective."""
    flat = chunks.select("chunk_id", "doc_type", F.explode("symbol_refs").alias("s")).where("s IS NOT NULL")
    return flat.select(bare_symbol(F.col("s")).alias("symbol"), "doc_type", "chunk_id").where("symbol <> ''").distinct()


def definitions_and_descriptions(chunks: DataFrame) -> DataFrame:
    """Symbols that several collections have, with the chunks of each: counts instead of pairs, so that common symbols don't multiply."""
    counts = symbol_index(chunks).groupBy("symbol").pivot("doc_type", list(DOC_TYPES)).agg(F.count("chunk_id"))
    counts = counts.na.fill(0, list(DOC_TYPES))
    several = sum((F.col(t) > 0).cast("int") for t in DOC_TYPES)
    return counts.withColumn("collections", several).where("collections > 1")


def published_revisions(rows: DataFrame, chips: DataFrame) -> DataFrame:
    """Adds ``published``: the revisions of the row's chip, or of its only entry of chips."""
    one = F.when(F.size(listed(F.col("chips"))) == 1, F.element_at("chips", 1))
    known = chips.groupBy("chip").agg(F.first("revisions").alias("published")).withColumnRenamed("chip", "_chip")
    return rows.withColumn("_chip", F.coalesce(F.nullif("chip", F.lit("")), one)).join(known, "_chip", "left").drop("_chip")


def results(rows: DataFrame, chips: DataFrame) -> DataFrame:
    """Rows as they are returned: no vector, blanks as null, null lists as empty, the scope in words, the distance to four places."""
    rows = rows if "distance" in rows.columns else rows.withColumn("distance", F.lit(None).cast("double"))
    rows = published_revisions(rows, chips)
    blank = lambda c: F.nullif(c, F.lit("")).alias(c)
    lists = [listed(F.col(c)).alias(c) for c in ("chips", "revisions", "file_refs", "doc_refs", "symbol_refs")]
    label = revision_scope(F.col("doc_type"), F.col("revisions"), F.col("published")).alias("revision_scope")
    return rows.select("chunk_id", "text", "source_doc", "doc_type", blank("chip"), *lists, label, blank("section_path"), "file_path", "chunk_index", blank("source_version"), F.round("distance", 4).alias("relevance_distance"))


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text, nulls included."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def list_chips(chips: DataFrame) -> DataFrame:
    """The catalogue: chip, has_trm, has_idf_docs, revisions, in order of chip."""
    return chips.select("chip", F.col("trm_folder").isNotNull().alias("has_trm"), F.col("idf_docs").alias("has_idf_docs"), listed(F.col("revisions")).alias("revisions")).orderBy("chip")


def chip_of_folder(chips: DataFrame, folder: str) -> str | None:
    """The first chip whose manual lies in a folder."""
    row = chips.where(F.col("trm_folder") == folder).orderBy("chip").first()
    return row["chip"] if row else None


def search(chunks: DataFrame, chips: DataFrame, query: list[float], scope: Scope = Scope(), k: int = 5) -> DataFrame:
    """Vector search from checked parameters to shaped rows."""
    return results(nearest(chunks, query, k, scope.check(chips)), chips).orderBy("relevance_distance", "chunk_id")
