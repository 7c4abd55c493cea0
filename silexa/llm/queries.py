"""Registered queries of the training-data operators, and their SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silexa.llm import encoding, leaks, near_dups, neighbours, packing, spam, splitting, survivors
from silexa.sources.tables import table


def p1_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf, "raw_chunks"), table(spark, sf, "chunk_limits"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.oversized(p1_pieces(spark, sf))


def p2_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill_containers(table(spark, sf, "raw_chunks"), table(spark, sf, "chunk_limits"))


def p2_use(spark: SparkSession, sf: str) -> DataFrame:
    return packing.container_use(p2_fill(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.similar_pairs(neighbours.nearest(table(spark, sf, "chunks"), least=0.85, recall=0.95))


def p3_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "chunks"), queries=F.col("chunk_id") % 100 == 0, tables=2, recall=0.96)


def _near(spark: SparkSession, sf: str) -> near_dups.NearDuplicates:
    return near_dups.NearDuplicates(table(spark, sf, "raw_chunks"), words=3, similarity=0.6, least=20)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.row_pairs(_near(spark, sf))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.groups(table(spark, sf, "raw_chunks"), _near(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_records(spark, sf).select("group_id", "chips_from", "index_from", "symbols_from", "path_from")


def p5_records(spark: SparkSession, sf: str) -> DataFrame:
    return survivors.survivors(table(spark, sf, "raw_chunks"), table(spark, sf, "builds"))


def p5_truth(spark: SparkSession, sf: str) -> DataFrame:
    return survivors.true_values(table(spark, sf, "raw_chunks"), table(spark, sf, "builds"))


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.token_ids(table(spark, sf, "documents"))


def p6_counts(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.token_counts(p6_ids(spark, sf))


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p7_leaks(spark, sf).select("doc_id", "item_id").distinct()


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return spam.word_shares(table(spark, sf, "documents"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return spam.flagged(p8_shares(spark, sf)).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_pieces, p2_fill, p2_use, p3_found, p3_neighbours, p4_found, p4_groups, p5_found, p5_records, p5_truth, p6_ids, p6_counts, p7_found, p7_leaks, p8_found, p8_shares)}

_BLANKS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _split(c: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({c}, ''), '{_BLANKS}'), lambda w: w <> '')"


_PAGE = rf"regexp_replace(trim(regexp_replace(replace(lower(regexp_replace(file_path, '{_BLANKS}', '', 'g')), '\', '/'), '(^|/)(\.?/)+', '\1', 'g'), '/'), '\.[a-z0-9]+$', '')"


def _count(c: str) -> str:
    return rf"len(list_distinct(list_filter(coalesce({c}, []), lambda v: v IS NOT NULL AND regexp_replace(v, '{_BLANKS}', '', 'g') <> '')))"


#: Twins of the queries that SQL can express; the others are tested against brute force, exact round trips or planted cases.
SQL: dict[str, str] = {
    "p1_found": f"SELECT raw_id FROM raw_chunks JOIN chunk_limits USING (doc_type) WHERE text IS NOT NULL AND len({_split('text')}) - len({_split('section_path')}) > max_words",
    "p4_found": r"""WITH t AS (SELECT raw_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM raw_chunks WHERE text IS NOT NULL),
        s AS (SELECT DISTINCT raw_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT raw_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 20) x),
        n AS (SELECT raw_id, count(*) AS n FROM s GROUP BY raw_id), m AS (SELECT a.raw_id AS id_a, b.raw_id AS id_b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.raw_id < b.raw_id GROUP BY ALL)
        SELECT id_a, id_b FROM m JOIN n x ON x.raw_id = id_a JOIN n y ON y.raw_id = id_b WHERE 5 * m >= 3 * (x.n + y.n - m)""",
    "p5_found": f"""WITH r AS (SELECT raw_id, {_PAGE} AS page, array_to_string({_split('text')}, ' ') AS words, {_count('chips')} AS chips, {_count('symbol_refs')} AS symbols, chunk_index,
        coalesce(built_at, TIMESTAMP '0001-01-01') AS built, coalesce(trust, -1000) AS trust FROM raw_chunks LEFT JOIN builds USING (build_id))
        SELECT min(raw_id) AS group_id, arg_max(raw_id, (chips, built, -raw_id)) AS chips_from, arg_max(raw_id, (built, -raw_id)) FILTER (chunk_index IS NOT NULL) AS index_from,
        arg_max(raw_id, (symbols, trust, built, -raw_id)) AS symbols_from, arg_max(raw_id, (trust, built, -raw_id)) AS path_from FROM r WHERE page <> '' AND words <> '' GROUP BY page, words HAVING count(*) > 1""",
}
