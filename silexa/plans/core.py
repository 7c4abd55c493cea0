"""Queries of the core operators by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silexa.functions import arrays, symbols, text
from silexa.operators import chunking, dedup, search, store, verify
from silexa.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function as a query, with its SQL twin if SQL can say it."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def joined(c: str) -> F.Column:
    """A list as one text, so that results compare."""
    return F.array_join(F.col(c), "|").alias(c)


#: White space of Unicode, and U+001C to U+001F, for DuckDB's regular expressions.
_WS = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _words(c: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({c}, ''), '{_WS}+'), lambda w: w <> ''))"


def _union(c: str) -> str:
    """Ordered union of a list column of ``g`` by (path, text)."""
    return f"""(SELECT k, string_agg(v, '|' ORDER BY o, p) AS {c} FROM (
        SELECT k, v, arg_min(raw_id, (raw_id, p)) AS o, arg_min(p, (raw_id, p)) AS p FROM (
            SELECT {_KEY} AS k, raw_id, unnest({c}) AS v, generate_subscripts({c}, 1) AS p FROM raw_chunks) u
        WHERE v IS NOT NULL GROUP BY k, v) f GROUP BY k)"""


_KEY = "md5((file_path IS NULL)::VARCHAR || coalesce(file_path, '') || chr(1) || (text IS NULL)::VARCHAR || coalesce(text, ''))"


# ---- duplicates ----


@query(
    f"""WITH h AS (SELECT {_KEY} AS k, min(raw_id) AS first_seen, min(chunk_index) AS chunk_index, count(*) AS copies FROM raw_chunks GROUP BY 1),
    c AS (SELECT k, string_agg(v, '|' ORDER BY v) AS chips FROM (SELECT DISTINCT {_KEY} AS k, unnest(chips) AS v FROM raw_chunks) u WHERE v IS NOT NULL GROUP BY k)
    SELECT first_seen, r.file_path, md5(r.text) AS text_md5, r.section_path, h.chunk_index::VARCHAR AS chunk_index, copies, coalesce(c.chips, '') AS chips,
        coalesce(a.file_refs, '') AS file_refs, coalesce(b.doc_refs, '') AS doc_refs, coalesce(s.symbol_refs, '') AS symbol_refs
    FROM h JOIN raw_chunks r ON r.raw_id = first_seen LEFT JOIN c USING (k)
    LEFT JOIN {_union("file_refs")} a USING (k) LEFT JOIN {_union("doc_refs")} b USING (k) LEFT JOIN {_union("symbol_refs")} s USING (k)"""
)
def dedup_targets(spark: SparkSession, sf: str) -> DataFrame:
    out = dedup.dedup_targets(table(spark, sf, "raw_chunks"))
    return out.select("first_seen", "file_path", F.md5(F.col("text").cast("binary")).alias("text_md5"), "section_path", F.col("chunk_index").cast("string").alias("chunk_index"), "copies", joined("chips"), joined("file_refs"), joined("doc_refs"), joined("symbol_refs"))


@query(f"""SELECT n AS "values", count(*) AS "rows" FROM (SELECT k, count(v) AS n FROM (
    SELECT {_KEY} AS k, NULL AS v FROM raw_chunks UNION SELECT {_KEY}, unnest(chips) FROM raw_chunks) u GROUP BY k) g GROUP BY n""")
def dedup_spread(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.spread(dedup.dedup_targets(table(spark, sf, "raw_chunks"))).select(F.col("values").cast("bigint").alias("values"), "rows")


@query(f"""SELECT sum(n)::BIGINT AS rows_read, count(*) AS rows_kept, round(100 * (1 - count(*) / greatest(sum(n), 1)::DOUBLE), 4) AS collapsed_percent
    FROM (SELECT {_KEY} AS k, count(*) AS n FROM raw_chunks GROUP BY 1) g""")
def dedup_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.collapse(dedup.dedup_targets(table(spark, sf, "raw_chunks")))


@query(
    """WITH u AS (SELECT *, unnest(revisions) AS revision FROM raw_chunks),
    g AS (SELECT arg_min(raw_id, (revision, raw_id)) AS first_seen, min(revision) AS first_revision, string_agg(DISTINCT revision, '|' ORDER BY revision) AS revisions
        FROM u WHERE revision IS NOT NULL GROUP BY chip, file_path, text)
    SELECT first_seen, r.chip, r.file_path, md5(r.text) AS text_md5, r.section_path, r.chunk_index::VARCHAR AS chunk_index, first_revision, g.revisions, coalesce(array_to_string(r.symbol_refs, '|'), '') AS symbol_refs
    FROM g JOIN raw_chunks r ON r.raw_id = first_seen"""
)
def dedup_revisions(spark: SparkSession, sf: str) -> DataFrame:
    out = dedup.dedup_revisions(table(spark, sf, "raw_chunks"))
    return out.select("first_seen", "chip", "file_path", F.md5(F.col("text").cast("binary")).alias("text_md5"), "section_path", F.col("chunk_index").cast("string").alias("chunk_index"), "first_revision", joined("revisions"), joined("symbol_refs"))


@query(
    """SELECT raw_id, string_agg(v, '|' ORDER BY p) AS refs FROM (SELECT raw_id, v, min(p) AS p FROM (
        SELECT raw_id, unnest(file_refs) AS v, generate_subscripts(file_refs, 1) AS p FROM raw_chunks
        UNION ALL SELECT raw_id, unnest(doc_refs), 1000000 + generate_subscripts(doc_refs, 1) FROM raw_chunks
        UNION ALL SELECT raw_id, unnest(symbol_refs), 2000000 + generate_subscripts(symbol_refs, 1) FROM raw_chunks) u
    WHERE v IS NOT NULL GROUP BY raw_id, v) g GROUP BY raw_id"""
)
def ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    refs = arrays.ordered_union(*(F.col(c) for c in dedup.REFS))
    return table(spark, sf, "raw_chunks").select("raw_id", refs.alias("refs")).where(F.size("refs") > 0).select("raw_id", joined("refs"))


@query(
    """SELECT origin, count(*) AS "rows", count(text) AS texts, sum(length(coalesce(text, '')))::BIGINT AS chars FROM (
    SELECT 'raw' AS origin, text FROM raw_chunks UNION ALL SELECT 'store', text FROM chunks UNION ALL SELECT 'documents', text FROM documents UNION ALL SELECT 'items', text FROM eval_items) u GROUP BY origin"""
)
def corpus_union(spark: SparkSession, sf: str) -> DataFrame:
    names = {"raw": "raw_chunks", "store": "chunks", "documents": "documents", "items": "eval_items"}
    parts = [table(spark, sf, t).select(F.lit(o).alias("origin"), "text") for o, t in names.items()]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return both.groupBy("origin").agg(F.count("*").alias("rows"), F.count("text").alias("texts"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


# ---- search ----

_CHIP, _REVISION = "vela2", "r1.4"


def _scoped(scope: search.Scope) -> Query:
    return lambda spark, sf: table(spark, sf, "chunks").where(search.scope_filter(scope)).select("chunk_id", "doc_type", "chip", joined("chips"), joined("revisions"))


_SCOPED = "SELECT chunk_id, doc_type, chip, coalesce(array_to_string(chips, '|'), '') AS chips, coalesce(array_to_string(revisions, '|'), '') AS revisions FROM chunks WHERE "
_CHIP_SQL = f"((doc_type = 'trm' AND chip = '{_CHIP}') OR (doc_type IN ('idf', 'src') AND list_contains(chips, '{_CHIP}')))"
_REVISION_SQL = f"(coalesce(len(revisions), 0) = 0 OR list_contains(revisions, '{_REVISION}'))"
for _name, _scope, _sql in (
    ("scope_filter_chip", search.Scope(chip=_CHIP), _CHIP_SQL),
    ("scope_filter_doc_type", search.Scope(doc_type="src"), "doc_type = 'src'"),
    ("scope_filter_revision", search.Scope(revision=_REVISION), _REVISION_SQL),
    ("scope_filter_all", search.Scope("trm", _CHIP, "base"), f"{_CHIP_SQL} AND doc_type = 'trm' AND {_REVISION_SQL}".replace(_REVISION, "base")),
):
    QUERIES[_name], SQL[_name] = _scoped(_scope), _SCOPED + _sql


@query(
    r"""WITH u AS (SELECT chunk_id, doc_type, regexp_replace(trim(s), '\(\)$', '') AS symbol FROM (SELECT chunk_id, doc_type, unnest(symbol_refs) AS s FROM chunks) x WHERE s IS NOT NULL)
    SELECT symbol, doc_type, count(DISTINCT chunk_id) AS chunks FROM u WHERE symbol <> '' GROUP BY ALL"""
)
def symbol_totals(spark: SparkSession, sf: str) -> DataFrame:
    return search.symbol_index(table(spark, sf, "chunks")).groupBy("symbol", "doc_type").agg(F.count("*").alias("chunks"))


_COMMON = r"""WITH top AS (SELECT s FROM (SELECT regexp_replace(trim(s), '\(\)$', '') AS s FROM (SELECT unnest(symbol_refs) AS s FROM chunks) x WHERE s IS NOT NULL) y
    WHERE s <> '' GROUP BY s ORDER BY count(*) DESC, s LIMIT 1),
    m AS (SELECT c.* FROM chunks c, top WHERE list_contains(symbol_refs, s) OR list_contains(symbol_refs, s || '()'))"""


def _common_symbol(chunks: DataFrame) -> str:
    flat = chunks.select(F.explode("symbol_refs").alias("s")).where("s IS NOT NULL").select(symbols.bare_symbol(F.col("s")).alias("s")).where("s <> ''")
    return flat.groupBy("s").count().orderBy(F.desc("count"), "s").first()["s"]


@query(_COMMON + " SELECT chunk_id, doc_type, chip, file_path, chunk_index FROM m")
def symbol_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The symbol with most references, in both spellings."""
    chunks = table(spark, sf, "chunks")
    return search.symbol_matches(chunks, _common_symbol(chunks)).select("chunk_id", "doc_type", "chip", "file_path", "chunk_index")


@query(
    _COMMON
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY coalesce(chip, ''), coalesce(file_path, ''), coalesce(chunk_index, 0), chunk_id) AS tier FROM m)
    SELECT chunk_id, doc_type, chip, file_path, tier::BIGINT AS tier FROM r ORDER BY tier, doc_type LIMIT 10"""
)
def interleave_symbol(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks")
    return search.find_symbol(chunks, _common_symbol(chunks))[1].select("chunk_id", "doc_type", "chip", "file_path", F.col("tier").cast("bigint").alias("tier"))


@query(
    f"""WITH d AS (SELECT min(raw_id) AS raw_id FROM raw_chunks GROUP BY {_KEY}),
    r AS (SELECT r.raw_id, doc_type, row_number() OVER (PARTITION BY doc_type ORDER BY coalesce(chip, ''), coalesce(file_path, ''), coalesce(chunk_index, 0), r.raw_id) AS tier FROM raw_chunks r JOIN d USING (raw_id))
    SELECT raw_id, doc_type, tier::BIGINT AS tier FROM r ORDER BY tier, doc_type LIMIT 50"""
)
def interleave_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the deduplicated corpus, collections in turn."""
    raw = table(spark, sf, "raw_chunks")
    heads = dedup.dedup_targets(raw).select(F.col("first_seen").alias("raw_id"))
    rows = raw.join(heads, "raw_id").withColumnRenamed("raw_id", "chunk_id")
    return search.interleaved(rows, 50).select(F.col("chunk_id").alias("raw_id"), "doc_type", F.col("tier").cast("bigint").alias("tier"))


@query(
    r"""WITH u AS (SELECT DISTINCT raw_id, doc_type, regexp_replace(trim(s), '\(\)$', '') AS symbol FROM (SELECT raw_id, doc_type, unnest(symbol_refs) AS s FROM raw_chunks) x WHERE s IS NOT NULL)
    SELECT symbol, count_if(doc_type = 'idf')::BIGINT AS idf, count_if(doc_type = 'src')::BIGINT AS src, count_if(doc_type = 'trm')::BIGINT AS trm, count(DISTINCT doc_type) AS collections
    FROM u WHERE symbol <> '' GROUP BY symbol HAVING count(DISTINCT doc_type) > 1"""
)
def symbol_cross_corpus(spark: SparkSession, sf: str) -> DataFrame:
    out = search.definitions_and_descriptions(table(spark, sf, "raw_chunks").withColumnRenamed("raw_id", "chunk_id"))
    return out.select("symbol", *[F.col(c).cast("bigint").alias(c) for c in (*search.DOC_TYPES, "collections")])


_GOOD = "len(vector) = 64 AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x))) = 0"
_DISTANCE = "list_sum(list_transform(range(1, 65), lambda i: (c.vector[i]::DOUBLE - q.v[i]::DOUBLE) * (c.vector[i]::DOUBLE - q.v[i]::DOUBLE)))"
_KNN = f"""WITH q AS (SELECT vector AS v FROM chunks WHERE {_GOOD} ORDER BY chunk_id LIMIT 1)
    SELECT chunk_id, doc_type, round(d, 4) AS distance FROM (SELECT chunk_id, doc_type, {_DISTANCE} AS d FROM chunks c, q WHERE {_GOOD} AND %s) x ORDER BY d, chunk_id LIMIT %d"""


def _good() -> F.Column:
    return (F.size("vector") == 64) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x))


def _first_vector(chunks: DataFrame) -> list[float]:
    return chunks.where(_good()).orderBy("chunk_id").first()["vector"]


@query(_KNN % ("true", 5))
def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks")
    return search.nearest(chunks, _first_vector(chunks)).select("chunk_id", "doc_type", F.round("distance", 4).alias("distance"))


@query(_KNN % (_CHIP_SQL, 20))
def knn_filtered(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks")
    return search.nearest(chunks, _first_vector(chunks), 20, search.Scope(chip=_CHIP)).select("chunk_id", "doc_type", F.round("distance", 4).alias("distance"))


@query(
    f"""WITH q AS (SELECT vector AS v FROM chunks WHERE {_GOOD} ORDER BY chunk_id LIMIT 1),
    d AS (SELECT chunk_id, doc_type, chip, {_DISTANCE} AS d FROM chunks c, q WHERE {_GOOD})
    SELECT doc_type, chip, chunk_id, round(d, 4) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY doc_type, chip ORDER BY d, chunk_id) <= 3"""
)
def knn_per_chip(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    chunks = table(spark, sf, "chunks").where(_good())
    near = chunks.withColumn("d", search.squared_distance(F.col("vector"), _first_vector(chunks)))
    order = Window.partitionBy("doc_type", "chip").orderBy("d", "chunk_id")
    return near.withColumn("n", F.row_number().over(order)).where("n <= 3").select("doc_type", "chip", "chunk_id", F.round("d", 4).alias("distance"))


@query(
    f"""WITH q AS (SELECT chunk_id AS query_id, vector AS v FROM chunks WHERE {_GOOD} ORDER BY chunk_id LIMIT 5)
    SELECT query_id, arg_min(chunk_id, (d, chunk_id)) AS nearest_id, round(min(d), 4) AS distance FROM (
        SELECT query_id, chunk_id, {_DISTANCE} AS d FROM chunks c, q WHERE {_GOOD}) x GROUP BY query_id"""
)
def knn_self(spark: SparkSession, sf: str) -> DataFrame:
    """Store check: the vectors of the first five good chunks lead back to themselves or a copy."""
    chunks = table(spark, sf, "chunks")
    good = chunks.where(_good())
    return verify.self_search(good, good.select("chunk_id").orderBy("chunk_id").limit(5))


@query(
    """WITH c AS (SELECT *, CASE WHEN coalesce(chip, '') <> '' THEN chip WHEN len(chips) = 1 THEN chips[1] END AS one FROM chunks),
    p AS (SELECT c.chunk_id, doc_type, coalesce(c.revisions, []) AS r, coalesce(i.revisions, []) AS pub FROM c LEFT JOIN chip_info i ON i.chip = one)
    SELECT chunk_id, CASE WHEN len(r) = 0 THEN CASE WHEN doc_type = 'trm' THEN 'unknown revision coverage' END
        WHEN len(pub) > 0 AND list_has_all(r, pub) THEN 'all published revisions (' || array_to_string(list_sort(r), ', ') || ')'
        ELSE 'ONLY revision ' || array_to_string(list_sort(r), ', ') || ' -- does not apply to other silicon revisions' END AS revision_scope FROM p"""
)
def revision_scope(spark: SparkSession, sf: str) -> DataFrame:
    rows = search.published_revisions(table(spark, sf, "chunks"), table(spark, sf, "chip_info"))
    return rows.select("chunk_id", symbols.revision_scope(F.col("doc_type"), F.col("revisions"), F.col("published")).alias("revision_scope"))


@query(
    """SELECT chunk_id, md5(text) AS text_md5, source_doc, nullif(chip, '') AS chip, coalesce(array_to_string(symbol_refs, '|'), '') AS symbol_refs, nullif(section_path, '') AS section_path, file_path, chunk_index,
    nullif(source_version, '') AS source_version FROM chunks"""
)
def result_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = search.results(table(spark, sf, "chunks"), table(spark, sf, "chip_info"))
    return out.select("chunk_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "source_doc", "chip", joined("symbol_refs"), "section_path", "file_path", "chunk_index", "source_version")


@query("SELECT chip, trm_folder IS NOT NULL AS has_trm, idf_docs AS has_idf_docs, coalesce(array_to_string(revisions, '|'), '') AS revisions FROM chip_info ORDER BY chip")
def list_chips(spark: SparkSession, sf: str) -> DataFrame:
    return search.list_chips(table(spark, sf, "chip_info")).select("chip", "has_trm", "has_idf_docs", joined("revisions"))


@query(
    """SELECT i.chip, (trm_folder IS NOT NULL) AS has_trm, idf_docs AS has_idf_docs, count(c.chunk_id) AS chunks FROM chip_info i LEFT JOIN
    (SELECT chunk_id, unnest(CASE WHEN doc_type = 'trm' THEN [chip] ELSE chips END) AS chip FROM chunks) c ON c.chip = i.chip GROUP BY ALL"""
)
def catalog_coverage(spark: SparkSession, sf: str) -> DataFrame:
    applies = F.when(F.col("doc_type") == "trm", F.array("chip")).otherwise(F.col("chips"))
    counts = table(spark, sf, "chunks").select(F.explode(applies).alias("chip")).groupBy("chip").agg(F.count("*").alias("chunks"))
    out = search.list_chips(table(spark, sf, "chip_info")).join(counts, "chip", "left")
    return out.select("chip", "has_trm", "has_idf_docs", F.coalesce("chunks", F.lit(0)).alias("chunks"))


# ---- text ----


@query(f"SELECT raw_id, {_words('text')}::INT AS words, ({_words('text')} - {_words('section_path')})::INT AS content_words FROM raw_chunks")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_chunks").select("raw_id", text.word_count(F.col("text")).alias("words"), text.content_words(F.col("text"), F.col("section_path")).alias("content_words"))


@query(
    """SELECT raw_id, coalesce(nullif(list_filter(regexp_split_to_array(coalesce(section_path, ''), '\\s*>\\s*'), lambda h: trim(h) <> '')[1], ''),
    nullif(trim(regexp_split_to_array(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]')[1]), ''),
    regexp_replace(string_split(file_path, '/')[-1], '(.)\\.[^.]*$', '\\1')) AS title FROM raw_chunks""".replace("\\\\", "\\")
)
def source_doc(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_chunks").select("raw_id", text.source_title(F.col("section_path"), F.col("text"), F.col("file_path")).alias("title"))


@query("""SELECT raw_id, array_to_string(list_filter(regexp_split_to_array(coalesce(section_path, ''), '\\s*>\\s*'), lambda h: trim(h) <> ''), ' > ') AS crumb,
    md5(CASE WHEN coalesce(section_path, '') = '' THEN text ELSE section_path || chr(10) || chr(10) || text END) AS prefixed_md5 FROM raw_chunks""")
def breadcrumb(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("section_path")
    return table(spark, sf, "raw_chunks").select("raw_id", text.breadcrumb(text.headings(path)).alias("crumb"), F.md5(text.with_breadcrumb(path, F.col("text")).cast("binary")).alias("prefixed_md5"))


@query(
    f"""WITH w AS (SELECT raw_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') AS w FROM raw_chunks)
    SELECT raw_id, i::INT AS "window", md5(array_to_string(w[i * 350 + 1 : i * 350 + 350], ' ')) AS text_md5 FROM (SELECT raw_id, w, unnest(range(greatest(1, ceil(len(w) / 350.0)::BIGINT))) AS i FROM w) x"""
)
def word_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = chunking.word_windows(table(spark, sf, "raw_chunks"), "raw_id", "text")
    return out.select("raw_id", "window", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(r"SELECT doc_id, string_agg(s, '|' ORDER BY p) AS links FROM (SELECT doc_id, s, min(p) AS p FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS p FROM (SELECT doc_id, regexp_extract_all(text, '\]\(([^)\s]+)\)', 1) AS l FROM documents) x) y GROUP BY doc_id, s) z GROUP BY doc_id")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"\]\(([^)\s]+)\)"), F.lit(1)))
    return table(spark, sf, "documents").select("doc_id", found.alias("links")).where(F.size("links") > 0).select("doc_id", joined("links"))


@query(r"""SELECT doc_id, string_agg(concat_ws(' | ', 'Field: ' || trim(f[1]), 'Bits: ' || trim(f[2]), 'Access: ' || trim(f[3]), 'Reset: ' || trim(f[4])), chr(10) ORDER BY p) AS rows FROM (
    SELECT doc_id, p, string_split(l, '|') AS f FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) x) y
    WHERE regexp_matches(l, '^[A-Z0-9_]+ \| \d+ \| [A-Z/]+ \| 0x[0-9A-F]+ \|')) z GROUP BY doc_id""".replace("AS rows", 'AS "rows"'))
def table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of register tables as ``Header: cell`` pairs."""
    rows = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^[A-Z0-9_]+ \| \d+ \| [A-Z/]+ \| 0x[0-9A-F]+ \|"))
    cell = lambda x, k: F.trim(F.element_at(F.split(x, r"\|"), k))
    named = F.transform(rows, lambda x: F.concat_ws(" | ", *[F.concat(F.lit(f"{h}: "), cell(x, k + 1)) for k, h in enumerate(("Field", "Bits", "Access", "Reset"))]))
    return table(spark, sf, "documents").select("doc_id", F.array_join(named, "\n").alias("rows")).where("rows <> ''")


_UNESCAPED = r"trim(replace(replace(replace(name, '\_', '_'), '\%', '%'), '\&', '&'))"


@query(rf"SELECT reg_id, {_UNESCAPED} AS plain, lower(translate(coalesce(chip, ''), '-_', '')) AS key, ({_UNESCAPED} <> '' AND NOT coalesce(name = 'unknown', false)) AS named FROM registers WHERE name IS NOT NULL")
def register_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "registers").where("name IS NOT NULL")
    plain = text.unescaped(F.col("name"))
    return rows.select("reg_id", plain.alias("plain"), text.squashed(F.coalesce("chip", F.lit(""))).alias("key"), ((plain != "") & (F.col("name") != "unknown")).alias("named"))


@query(
    r"""WITH b AS (SELECT reg_id, replace(replace(trim(replace(name, '\_', '_')), '{n}', 'n'), '$n', 'n') AS base FROM registers WHERE parameterised AND name IS NOT NULL),
    e AS (SELECT reg_id, base, 0 AS p, base AS s FROM b UNION ALL SELECT reg_id, base, i + 1, substr(base, 1, instr(base, 'n') - 1) || i || substr(base, instr(base, 'n') + 1) FROM b, range(0, 4) r(i) WHERE instr(base, 'n') > 0)
    SELECT reg_id, string_agg(s, '|' ORDER BY p) AS symbols FROM e GROUP BY reg_id"""
)
def register_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Banks of registers spelled out for four members."""
    rows = table(spark, sf, "registers").where("parameterised AND name IS NOT NULL")
    base = F.replace(F.replace(F.trim(F.replace(F.col("name"), F.lit("\\_"), F.lit("_"))), F.lit("{n}"), F.lit("n")), F.lit("$n"), F.lit("n"))
    return rows.select("reg_id", symbols.register_symbols(F.concat(base, F.lit(" (n: 0-3)"))).alias("symbols")).select("reg_id", joined("symbols"))


# ---- chunking ----

_LINES = r"CASE WHEN text IS NULL OR text = '' THEN [] ELSE CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END END"
_SPLIT = r"regexp_split_to_array(coalesce(text, ''), '\r\n|[\n\r\x0b\x0c\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]')"


@query(
    rf"""WITH s AS (SELECT raw_id, text, {_SPLIT} AS l FROM raw_chunks), t AS (SELECT raw_id, {_LINES} AS l FROM s),
    u AS (SELECT raw_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM t),
    b AS (SELECT *, regexp_matches(x, '[^\s\x0b\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]') AS filled FROM u),
    r AS (SELECT raw_id, i, i - row_number() OVER (PARTITION BY raw_id ORDER BY i) AS k FROM b WHERE filled),
    g AS (SELECT raw_id, k, min(i) AS first_line, count(*) AS n_lines FROM r GROUP BY ALL)
    SELECT raw_id, row_number() OVER (PARTITION BY raw_id ORDER BY first_line)::INT AS run, (first_line - 1)::INT AS first_line, n_lines FROM g"""
)
def line_runs(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.line_runs(table(spark, sf, "raw_chunks"), "raw_id", "text")


@query(
    rf"""WITH RECURSIVE t AS (SELECT raw_id, {_SPLIT} AS l FROM raw_chunks WHERE text <> ''),
    u AS (SELECT raw_id, CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM t), x AS (SELECT raw_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM u),
    b AS (SELECT *, {_words("line")} AS n FROM x),
    p AS (SELECT raw_id, i, line, n, 1 AS g, CASE WHEN n > 400 THEN 401 ELSE n END AS open FROM b WHERE i = 1
        UNION ALL SELECT b.raw_id, b.i, b.line, b.n, CASE WHEN p.open + b.n <= 400 THEN p.g ELSE p.g + 1 END, CASE WHEN b.n > 400 THEN 401 WHEN p.open + b.n <= 400 THEN p.open + b.n ELSE b.n END
        FROM p JOIN b ON b.raw_id = p.raw_id AND b.i = p.i + 1),
    f AS (SELECT raw_id, g, count(*) AS n_lines, sum(n) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM p GROUP BY ALL),
    w AS (SELECT raw_id, g, n_lines, n, text, list_filter(regexp_split_to_array(text, '{_WS}+'), lambda v: v <> '') AS v FROM f),
    o AS (SELECT raw_id, g, 0 AS k, n_lines, n, text FROM w WHERE n <= 400
        UNION ALL SELECT raw_id, g, k, n_lines, len(v[400 * k + 1 : 400 * k + 400]), array_to_string(v[400 * k + 1 : 400 * k + 400], ' ') FROM (SELECT *, unnest(range((n + 399)::BIGINT // 400)) AS k FROM w WHERE n > 400))
    SELECT raw_id, (row_number() OVER (PARTITION BY raw_id ORDER BY g, k) - 1)::INT AS piece, n_lines::INT AS n_lines, n::INT AS n_words, md5(text) AS text_md5 FROM o"""
)
def line_pack(spark: SparkSession, sf: str) -> DataFrame:
    out = chunking.pack_lines(table(spark, sf, "raw_chunks"), "raw_id", "text")
    return out.select("raw_id", "piece", "n_lines", "n_words", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(
    f"""WITH RECURSIVE b AS (SELECT file_path, raw_id, {_words("text")} AS n, row_number() OVER (PARTITION BY file_path ORDER BY raw_id) AS i FROM raw_chunks),
    p AS (SELECT file_path, raw_id, n, i, 0 AS piece, CASE WHEN n > 400 THEN 401 ELSE n END AS open FROM b WHERE i = 1
        UNION ALL SELECT b.file_path, b.raw_id, b.n, b.i, CASE WHEN p.open + b.n <= 400 THEN p.piece ELSE p.piece + 1 END, CASE WHEN b.n > 400 THEN 401 WHEN p.open + b.n <= 400 THEN p.open + b.n ELSE b.n END
        FROM p JOIN b ON b.file_path IS NOT DISTINCT FROM p.file_path AND b.i = p.i + 1)
    SELECT file_path, raw_id, n::INT AS n_words, piece FROM p"""
)
def greedy_pack(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of each page packed as blocks; those without a page are one document."""
    rows = table(spark, sf, "raw_chunks").withColumn("n", text.word_count(F.col("text")))
    return chunking.pack_blocks(rows, "file_path", "raw_id", "n")


@query(
    rf"""WITH r AS (SELECT raw_id, file_path, section_path, coalesce(text, '') AS text, {_words("text")} AS w, {_words("text")} - {_words("section_path")} AS c, row_number() OVER (PARTITION BY file_path ORDER BY raw_id) AS i FROM raw_chunks),
    g AS (SELECT *, sum(CASE WHEN i = 1 OR c >= 50 THEN 1 ELSE 0 END) OVER (PARTITION BY file_path ORDER BY raw_id ROWS UNBOUNDED PRECEDING) AS g FROM r),
    h AS (SELECT *, sum(CASE WHEN g = 1 THEN CASE WHEN i = 1 THEN c ELSE w END END) OVER (PARTITION BY file_path) AS head, max(g) OVER (PARTITION BY file_path) AS last FROM g),
    m AS (SELECT *, CASE WHEN head < 50 AND last > 1 THEN greatest(g, 2) ELSE g END AS m FROM h),
    f AS (SELECT file_path, m, min(raw_id) AS first, count(*) AS n, arg_max(section_path, (g, -i)) AS p0, sum(w) AS w, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text, max((g, -i)) AS x FROM m GROUP BY ALL),
    k AS (SELECT f.*, s.section_path FROM f JOIN m s ON s.file_path IS NOT DISTINCT FROM f.file_path AND s.m = f.m AND s.g = f.x[1] AND s.i = -f.x[2])
    SELECT file_path, (row_number() OVER (PARTITION BY file_path ORDER BY m) - 1)::INT AS chunk_index, first, n AS "rows", (w - {_words("section_path")})::BIGINT AS n_words, section_path, md5(text) AS text_md5 FROM k""".replace("f.x[1]", "struct_extract_at(f.x, 1)").replace("f.x[2]", "struct_extract_at(f.x, 2)")
)
def merge_small(spark: SparkSession, sf: str) -> DataFrame:
    out = chunking.merge_small(table(spark, sf, "raw_chunks"), "file_path", "raw_id")
    return out.select("file_path", "chunk_index", "first", "rows", "n_words", "section_path", F.md5(F.col("text").cast("binary")).alias("text_md5"))


_NODES = rf"""r AS (SELECT file_path AS doc, list_filter(regexp_split_to_array(coalesce(section_path, ''), '\s*>\s*'), lambda h: trim(h) <> '') AS path, greatest({_words("text")} - {_words("section_path")}, 0) AS n FROM raw_chunks),
    n AS (SELECT doc, path, sum(n)::BIGINT AS n_words, {_words("path[-1]")} AS t FROM (SELECT doc, path[:d] AS path, CASE WHEN d = len(path) THEN n ELSE 0 END AS n FROM (SELECT *, unnest(range(1, len(path) + 1)) AS d FROM r) x) y GROUP BY doc, path),
    s AS (SELECT doc, path, sum(w)::BIGINT AS subtree FROM (SELECT doc, own[:d] AS path, n_words + CASE WHEN len(own) > d THEN t ELSE 0 END AS w FROM (SELECT doc, path AS own, n_words, t, unnest(range(1, len(path) + 1)) AS d FROM n WHERE doc IS NOT NULL) x) y GROUP BY doc, path),
    z AS (SELECT n.doc, n.path, n.n_words, s.subtree FROM n JOIN s ON n.doc = s.doc AND n.path = s.path)"""


@query("WITH " + _NODES + " SELECT doc, array_to_string(path, ' > ') AS path, n_words, subtree FROM z")
def subtree_words(spark: SparkSession, sf: str) -> DataFrame:
    nodes = chunking.section_nodes(table(spark, sf, "raw_chunks"), "file_path")
    return chunking.subtree_words(nodes).select("doc", F.array_join("path", " > ").alias("path"), "n_words", "subtree")


@query(
    "WITH " + _NODES + """ SELECT z.doc, array_to_string(z.path, ' > ') AS path, z.n_words, z.subtree,
    CASE WHEN z.subtree <= 400 AND coalesce(p.subtree > 400, true) THEN 'whole' WHEN z.subtree <= 400 THEN 'inside' ELSE 'own' END AS emitted
    FROM z LEFT JOIN z p ON p.doc = z.doc AND len(z.path) > 1 AND p.path = z.path[:-2]"""
)
def tree_chunks(spark: SparkSession, sf: str) -> DataFrame:
    nodes = chunking.section_nodes(table(spark, sf, "raw_chunks"), "file_path")
    return chunking.tree_chunks(nodes).select("doc", F.array_join("path", " > ").alias("path"), "n_words", "subtree", "emitted")


@query("SELECT raw_id, file_path, (row_number() OVER (PARTITION BY file_path ORDER BY raw_id) - 1)::INT AS position FROM raw_chunks")
def renumber(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.renumber(table(spark, sf, "raw_chunks").select("raw_id", "file_path"), "file_path", "raw_id")


_BATCHES = "(SELECT doc_id, coalesce(length(text), 0) AS length, row_number() OVER (ORDER BY coalesce(length(text), 0), doc_id) - 1 AS position FROM documents)"


@query(f"SELECT doc_id, length::INT AS length, position, (position // 32)::BIGINT AS batch FROM {_BATCHES} x")
def length_batches(spark: SparkSession, sf: str) -> DataFrame:
    return verify.length_batches(table(spark, sf, "documents"), "doc_id")


@query(f"SELECT sum(p)::BIGINT AS padded, sum(r)::BIGINT AS real, round(sum(p) / greatest(sum(r), 1)::DOUBLE, 4) AS tax FROM (SELECT max(length) * count(*) AS p, sum(length) AS r FROM {_BATCHES} x GROUP BY position // 32) y")
def padding_tax(spark: SparkSession, sf: str) -> DataFrame:
    return verify.padding_tax(verify.length_batches(table(spark, sf, "documents"), "doc_id"))


# ---- audits ----

_STATS = f"(SELECT file_path, count(*) AS chunks, sum(coalesce(length(text), 0))::BIGINT AS chars, sum({_words('text')} - {_words('section_path')})::BIGINT AS words FROM raw_chunks GROUP BY file_path)"
_SOURCES = f"(SELECT file_path, sum({_words('text')})::BIGINT AS source_words FROM chunks WHERE file_path IS NOT NULL GROUP BY file_path)"
_RATES = f"(SELECT s.file_path, chunks, words, source_words, CASE WHEN source_words >= 50 THEN round(100 * words / source_words::DOUBLE, 4) END AS capture, source_words IS NULL AS missing FROM {_STATS} s LEFT JOIN {_SOURCES} q USING (file_path))"


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    stored = table(spark, sf, "chunks").where("file_path IS NOT NULL").groupBy("file_path").agg(F.sum(text.word_count(F.col("text"))).alias("source_words"))
    return verify.capture_rates(verify.file_stats(table(spark, sf, "raw_chunks")), stored)


@query(f"SELECT * FROM {_STATS} x")
def file_stats(spark: SparkSession, sf: str) -> DataFrame:
    return verify.file_stats(table(spark, sf, "raw_chunks"))


@query(f"SELECT * REPLACE (source_words::VARCHAR AS source_words) FROM {_RATES} x")
def capture_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Words delivered against words stored, by file."""
    return _rates(spark, sf).withColumn("source_words", F.col("source_words").cast("string"))


@query(f"WITH r AS (SELECT * FROM {_RATES} x), m AS (SELECT median(capture) / 2 AS floor FROM r) SELECT file_path, capture, round(floor, 4) AS floor FROM r, m WHERE capture < 80 OR capture < floor")
def thin_files(spark: SparkSession, sf: str) -> DataFrame:
    return verify.thin_files(_rates(spark, sf))


@query("""SELECT s.file_path, chunks, source_chars, round(source_chars / greatest(chunks, 1)::DOUBLE, 4) AS chars_per_chunk FROM (SELECT file_path, count(*) AS chunks FROM raw_chunks GROUP BY 1) s
    JOIN (SELECT file_path, sum(length(text))::BIGINT AS source_chars FROM chunks GROUP BY 1) c USING (file_path) WHERE source_chars / greatest(chunks, 1)::DOUBLE > 2000""")
def heavy_files(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "chunks").groupBy("file_path").agg(F.sum(F.length("text")).alias("source_chars"))
    return verify.heavy_files(verify.file_stats(table(spark, sf, "raw_chunks")), sizes, 2000)


_TOKENS = "(SELECT DISTINCT lower(translate(coalesce(chip, ''), '-_', '')) AS key, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z][A-Za-z0-9_]{2,}')) AS token FROM raw_chunks)"
_CENSUS = rf"(SELECT DISTINCT chip, chapter, {_UNESCAPED} AS name, parameterised OR regexp_matches(name, '[{{$]') AS bank FROM registers WHERE name IS NOT NULL AND trim(name) <> '')"
_CHECK = f"""tok AS (SELECT * FROM {_TOKENS} x), n AS (SELECT *, lower(translate(chip, '-_', '')) AS key FROM {_CENSUS} x WHERE NOT bank),
    k AS (SELECT DISTINCT key FROM tok), c AS (SELECT chip, chapter, name, CASE WHEN contains(name, ' ') THEN EXISTS (SELECT 1 FROM raw_chunks r WHERE lower(translate(coalesce(r.chip, ''), '-_', '')) = n.key AND contains(r.text, n.name))
    WHEN n.key IN (SELECT key FROM k) THEN (n.key, n.name) IN (SELECT (key, token) FROM tok) ELSE n.name IN (SELECT token FROM tok) END AS present FROM n)"""


@query(f"SELECT key, count(*) AS tokens, min(token) AS first_token, max(token) AS last_token FROM {_TOKENS} x GROUP BY key")
def token_sets(spark: SparkSession, sf: str) -> DataFrame:
    out = verify.chip_tokens(table(spark, sf, "raw_chunks")).groupBy("key")
    return out.agg(F.count("*").alias("tokens"), F.min("token").alias("first_token"), F.max("token").alias("last_token"))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return verify.census_check(table(spark, sf, "registers"), table(spark, sf, "raw_chunks"))


@query(f"WITH {_CHECK} SELECT * FROM c")
def census_check(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(spark, sf)


@query(
    f"""WITH b AS (SELECT chip, count(*) AS "rows", count_if(name IS NULL OR trim(name) = '')::BIGINT AS unreadable FROM registers GROUP BY chip),
    n AS (SELECT chip, count_if(NOT bank)::BIGINT AS checkable, count_if(bank)::BIGINT AS banks FROM (SELECT DISTINCT chip, name, bank FROM {_CENSUS} x) y GROUP BY chip),
    p AS (SELECT chip, "rows", unreadable, coalesce(checkable, 0) AS checkable, coalesce(banks, 0) AS banks FROM b LEFT JOIN n USING (chip))
    SELECT CASE WHEN grouping(chip) = 1 THEN 'TOTAL' ELSE chip END AS chip, sum("rows")::BIGINT AS "rows", sum(unreadable)::BIGINT AS unreadable, sum(checkable)::BIGINT AS checkable, sum(banks)::BIGINT AS banks FROM p GROUP BY ROLLUP (chip)"""
)
def census_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return verify.census_totals(table(spark, sf, "registers"))


@query(f"""WITH {_CHECK}, p AS (SELECT chip, name, bool_or(present) AS present FROM c GROUP BY ALL), q AS (SELECT chip, count(*) AS names, count_if(present)::BIGINT AS found FROM p GROUP BY chip)
    SELECT CASE WHEN grouping(chip) = 1 THEN 'TOTAL' ELSE chip END AS chip, sum(names)::BIGINT AS names, sum(found)::BIGINT AS found, CASE WHEN coalesce(sum(names), 0) = 0 THEN 100.0 ELSE round(100 * sum(found) / sum(names)::DOUBLE, 4) END AS percent FROM q GROUP BY ROLLUP (chip)""")
def census_rates(spark: SparkSession, sf: str) -> DataFrame:
    return verify.census_rates(_checked(spark, sf))


_HITS = "h AS (SELECT chip, chapter, count(*) AS names, count_if(present)::BIGINT AS found, round(100 * count_if(present)::BIGINT / count(*)::DOUBLE, 4) AS percent FROM c GROUP BY chip, chapter)"


@query(f"WITH {_CHECK}, {_HITS} SELECT * FROM h")
def chapter_hits(spark: SparkSession, sf: str) -> DataFrame:
    return verify.chapter_hits(_checked(spark, sf))


@query(f"WITH {_CHECK}, {_HITS} SELECT * FROM h WHERE percent < 100 ORDER BY percent, chip, chapter LIMIT 20")
def worst_chapters(spark: SparkSession, sf: str) -> DataFrame:
    return verify.worst_chapters(verify.chapter_hits(_checked(spark, sf)))


@query(f"WITH {_CHECK}, p AS (SELECT chip, name, bool_or(present) AS present FROM c GROUP BY ALL) SELECT chip, name, n::INT AS n FROM (SELECT chip, name, row_number() OVER (PARTITION BY chip ORDER BY name) AS n FROM p WHERE NOT present) x WHERE n <= 20")
def census_missing(spark: SparkSession, sf: str) -> DataFrame:
    return verify.missing_names(_checked(spark, sf))


@query(f"WITH {_CHECK}, p AS (SELECT chip, name, bool_or(present) AS present FROM c GROUP BY ALL), s AS (SELECT round(coalesce(100 * (1 - count_if(present)::BIGINT / nullif(count(*), 0)::DOUBLE), 0), 4) AS shortfall FROM p) SELECT shortfall, shortfall <= 2 AS passed FROM s")
def census_gate(spark: SparkSession, sf: str) -> DataFrame:
    return verify.gate(_checked(spark, sf))


@query(
    rf"""WITH n AS (SELECT DISTINCT chip, name AS symbol FROM {_CENSUS} x WHERE name <> 'unknown'),
    d AS (SELECT DISTINCT chip, regexp_replace(trim(s), '\(\)$', '') AS symbol FROM (SELECT chip, unnest(symbol_refs) AS s FROM (SELECT symbol_refs, unnest(chips) AS chip FROM raw_chunks WHERE doc_type = 'src') x) y WHERE s IS NOT NULL AND chip IS NOT NULL),
    j AS (SELECT n.chip, d.symbol FROM n LEFT JOIN d ON d.chip = n.chip AND d.symbol = n.symbol)
    SELECT CASE WHEN grouping(chip) = 1 THEN 'TOTAL' ELSE chip END AS chip, count(*) AS names, count(symbol) AS declared, round(100 * count(symbol) / greatest(count(*), 1)::DOUBLE, 4) AS percent FROM j GROUP BY ROLLUP (chip)"""
)
def cross_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return verify.cross_resolution(table(spark, sf, "registers"), table(spark, sf, "raw_chunks"))


@query(
    rf"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z][A-Za-z0-9_]{{2,}}')) AS token FROM documents)
    SELECT token, count(*) AS n, min(doc_id) AS example FROM t WHERE regexp_matches(token, '^[A-Z]+_[A-Z0-9_]+$') AND token NOT IN (SELECT {_UNESCAPED} FROM registers WHERE name IS NOT NULL) GROUP BY token"""
)
def unknown_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return verify.unknown_tokens(table(spark, sf, "documents"), "doc_id", table(spark, sf, "registers"))


@query(
    """SELECT doc_type, count(*) AS "rows", count(DISTINCT file_path) AS files, count_if(len(vector) = 64)::BIGINT AS full_vectors, count_if(coalesce(len(symbol_refs), 0) > 0)::BIGINT AS with_symbols,
    count_if(coalesce(len(revisions), 0) > 0)::BIGINT AS with_revisions FROM chunks GROUP BY doc_type"""
)
def store_summary(spark: SparkSession, sf: str) -> DataFrame:
    return verify.store_summary(table(spark, sf, "chunks"))


@query(
    """SELECT CASE WHEN len(chips) = 1 THEN chips[1] ELSE '(all chips)' END AS label, count_if(doc_type = 'idf')::BIGINT AS idf, count_if(doc_type = 'src')::BIGINT AS src, count_if(doc_type = 'trm')::BIGINT AS trm,
    count_if(coalesce(len(symbol_refs), 0) > 0)::BIGINT AS with_symbols FROM raw_chunks GROUP BY 1"""
)
def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.size("chips") == 1, F.element_at("chips", 1)).otherwise("(all chips)").alias("label")
    counts = [F.count_if(F.col("doc_type") == t).alias(t) for t in store.DOC_TYPES]
    return table(spark, sf, "raw_chunks").groupBy(label).agg(*counts, F.count_if(F.size(arrays.listed(F.col("symbol_refs"))) > 0).alias("with_symbols"))


@query(
    """WITH s AS (SELECT DISTINCT chip, revision FROM (SELECT chip, unnest(revisions) AS revision FROM raw_chunks WHERE coalesce(chip, '') <> '') x WHERE revision IS NOT NULL),
    t AS (SELECT DISTINCT chip, unnest(revisions) AS revision FROM chip_info)
    SELECT coalesce(s.chip, t.chip) AS chip, coalesce(s.revision, t.revision) AS revision, CASE WHEN s.chip IS NULL THEN 'absent' ELSE 'extra' END AS drift
    FROM s FULL JOIN t ON s.chip = t.chip AND s.revision = t.revision WHERE s.chip IS NULL OR t.chip IS NULL"""
)
def chip_drift(spark: SparkSession, sf: str) -> DataFrame:
    return verify.chip_drift(table(spark, sf, "raw_chunks"), table(spark, sf, "chip_info"))


@query("SELECT DISTINCT unnest(revisions) AS revision FROM chip_info")
def known_revisions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chip_info").select(F.explode("revisions").alias("revision")).distinct()


@query(
    """WITH n AS (SELECT count(DISTINCT chip) AS n FROM chunks WHERE doc_type = 'trm'), c AS (SELECT DISTINCT chip, unnest(symbol_refs) AS tag FROM chunks WHERE doc_type = 'trm')
    SELECT tag, count(*) AS chips, count(*) = (SELECT n FROM n) AS always FROM c WHERE tag IS NOT NULL GROUP BY tag"""
)
def tag_states(spark: SparkSession, sf: str) -> DataFrame:
    """Which symbols all manuals have, and which only some."""
    manuals = table(spark, sf, "chunks").where("doc_type = 'trm'")
    n = manuals.agg(F.count_distinct("chip").alias("n"))
    tags = manuals.select("chip", F.explode("symbol_refs").alias("tag")).where("tag IS NOT NULL").distinct().groupBy("tag").agg(F.count("*").alias("chips"))
    return tags.crossJoin(F.broadcast(n)).select("tag", "chips", (F.col("chips") == F.col("n")).alias("always"))  # n is one row


@query(
    """WITH r AS (SELECT chunk_id, unnest(doc_refs) AS target FROM chunks), p AS (SELECT DISTINCT file_path FROM chunks WHERE file_path IS NOT NULL),
    h AS (SELECT chunk_id, count(*) AS n FROM r JOIN p ON target = p.file_path GROUP BY chunk_id)
    SELECT c.chunk_id, c.file_path, coalesce(len(doc_refs), 0)::INT AS refs, coalesce(h.n, 0)::INT AS resolved FROM chunks c LEFT JOIN h USING (chunk_id)"""
)
def doc_ref_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the pages a chunk refers to are in the store."""
    chunks = table(spark, sf, "chunks")
    pages = chunks.select(F.col("file_path").alias("target")).where("target IS NOT NULL").distinct().withColumn("hit", F.lit(1))
    hits = chunking.refs_of(chunks, "doc_refs").join(pages, "target").groupBy(F.col("chunk_id")).agg(F.count("*").alias("resolved"))
    out = chunks.select("chunk_id", "file_path", F.size(arrays.listed(F.col("doc_refs"))).alias("refs")).join(hits, "chunk_id", "left")
    return out.select("chunk_id", "file_path", "refs", F.coalesce("resolved", F.lit(0)).cast("int").alias("resolved"))


# ---- store ----


@query("SELECT doc_type, count(*) AS rows FROM chunks WHERE doc_type IS DISTINCT FROM 'src' GROUP BY doc_type".replace("AS rows", 'AS "rows"'))
def delete_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return store.without_collection(table(spark, sf, "chunks"), "src").groupBy("doc_type").agg(F.count("*").alias("rows"))


@query("SELECT chunk_id, source_version, 'unknown' AS origin, '' AS tags FROM chunks")
def backfill_constant(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns are new, one is there already and stays."""
    new = {"source_version": F.lit("other"), "origin": F.lit("unknown"), "tags": F.array().cast("array<string>")}
    return store.with_constants(table(spark, sf, "chunks"), new).select("chunk_id", "source_version", "origin", joined("tags"))


@query(
    r"""WITH f AS (SELECT coalesce(file_path, '') AS p, coalesce(text, '') AS t, min(coalesce(symbol_refs, [])) AS s FROM raw_chunks GROUP BY ALL)
    SELECT chunk_id, CASE WHEN f.s IS NOT NULL THEN array_to_string(f.s, '|') ELSE array_to_string(list_filter(regexp_extract_all(coalesce(c.text, ''), 'Register ([A-Za-z0-9_]+)\s*(?:\([^)]*\))?\s* at address', 1), lambda x, i: true), '|') END AS symbol_refs
    FROM chunks c LEFT JOIN f ON f.p = coalesce(c.file_path, '') AND f.t = coalesce(c.text, '')"""
)
def backfill_fallback(spark: SparkSession, sf: str) -> DataFrame:
    out = store.with_refreshed_symbols(table(spark, sf, "chunks"), table(spark, sf, "raw_chunks"))
    return out.select("chunk_id", joined("symbol_refs"))


@query("SELECT chunk_id, b.origin, b.trust::VARCHAR AS trust FROM chunks c LEFT JOIN (SELECT source_commit, min(origin) AS origin, max(trust) AS trust FROM builds WHERE source_commit <> '' GROUP BY 1) b ON b.source_commit = c.source_commit")
def provenance_join(spark: SparkSession, sf: str) -> DataFrame:
    builds = table(spark, sf, "builds").where("source_commit <> ''").groupBy("source_commit").agg(F.min("origin").alias("origin"), F.max("trust").alias("trust"))
    return table(spark, sf, "chunks").select("chunk_id", "source_commit").join(builds, "source_commit", "left").select("chunk_id", "origin", F.col("trust").cast("string").alias("trust"))


# ---- joins and aggregates of general tables ----


@query(
    """SELECT o_orderpriority, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' GROUP BY ALL"""
)
def order_stats(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
    both = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.groupBy("o_orderpriority", "c_mktsegment").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    """SELECT 'semi' AS kind, count(*) AS "rows" FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
    UNION ALL SELECT 'anti', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'left', count(*) FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    UNION ALL SELECT 'inner', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""
)
def join_kinds(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines, customers = (table(spark, sf, t) for t in ("orders", "lineitem", "customer"))
    key, owner = F.col("o_orderkey") == F.col("l_orderkey"), F.col("o_custkey") == F.col("c_custkey")
    parts = {
        "semi": orders.join(lines.where("l_quantity > 45"), key, "left_semi"),
        "anti": customers.join(orders, owner, "left_anti"),
        "left": customers.join(orders, owner, "left"),
        "inner": lines.join(orders.where("o_orderstatus = 'F'"), key),
    }
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(k).alias("kind"), "rows") for k, df in parts.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


# ---- events ----


@query("SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS \"end\", event_type, count(*) AS n FROM events GROUP BY ALL")
def event_days(spark: SparkSession, sf: str) -> DataFrame:
    from silexa.streaming.ingest import windowed

    return windowed(table(spark, sf, "events"), "ts", ["event_type"], "1 day")


@query(
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events WHERE ts IS NOT NULL),
    s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, k"""
)
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    from silexa.streaming.ingest import sessions

    return sessions(table(spark, sf, "events"), "ts", "user_id", "6 hours")
