"""Name -> query of the dealt operators over their whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from limitlens.llm.bpe import round_trip
from limitlens.llm.direct_codes import stored_ids
from limitlens.llm.exact_dedup import exact_duplicates
from limitlens.llm.language_model import language_scores
from limitlens.llm.near_dup import near_duplicates
from limitlens.llm.packing import pack
from limitlens.llm.pii import personal_data
from limitlens.llm.prefix_trie import prefix_trie
from limitlens.llm.quality import quality
from limitlens.llm.syncmers import fingerprints
from limitlens.llm.tables import table
from limitlens.llm.toxicity import toxicity
from limitlens.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes
from limitlens.llm.warc import pages_through_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op2_exact_dedup"] = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM texts
"""


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op4_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_ids(table(spark, sf_dir, "documents"))


@query
def op7_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_archives(table(spark, sf_dir, "pages"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _codebook_sql() -> str:
    """Rounds of a full search. Whole numbers below 2 ** 53 are exact as DOUBLE."""

    def assigned(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT s.row, s.p, s.part, min({{'d': s.size - 2 * list_inner_product(s.part, b.part) + b.size, 'entry': b.entry}}) AS hit
  FROM parts s JOIN b{n} b ON s.p = b.p GROUP BY s.row, s.p, s.part
)"""

    def improved(n: int) -> str:
        return f"""
m{n} AS MATERIALIZED (
  SELECT p, entry, list(v ORDER BY place) AS part
  FROM (SELECT p, hit.entry AS entry, place, floor(sum(part[place]) / count(*)) AS v
        FROM a{n - 1}, unnest(generate_series(1, len(part))) g(place) GROUP BY ALL)
  GROUP BY ALL
), b{n} AS MATERIALIZED (
  SELECT p, entry, part, list_inner_product(part, part) AS size
  FROM (SELECT b.p, b.entry, coalesce(m.part, b.part) AS part FROM b{n - 1} b LEFT JOIN m{n} m USING (p, entry))
)"""

    rounds = [assigned(0)]
    for n in range(1, ROUNDS + 1):
        rounds += [improved(n), assigned(n)]
    last = f"a{ROUNDS}"
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT *, list_inner_product(part, part) AS size
  FROM (SELECT row, p, v[(p * len(v) / {PARTS})::INT + 1 : ((p + 1) * len(v) / {PARTS})::INT] AS part
        FROM kept, range({PARTS}) g(p))
), b0 AS MATERIALIZED (
  SELECT p, row - 1 AS entry, part, size FROM parts WHERE row <= {ENTRIES}
), {','.join(rounds)}, coded AS (
  SELECT row, string_agg(printf('%02x', hit.entry), '' ORDER BY p) AS code, sum(hit.d)::BIGINT AS error
  FROM {last} GROUP BY row
), digest AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(part, lambda x: x::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY p, entry)) AS codebooks_sha256
  FROM b{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""


ORACLE["op11_vector_codes"] = _codebook_sql()


@query
def op12_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# The checksum goes bit by bit: the usual reflected polynomial.
ORACLE["op13_prefix_trie"] = """
WITH own AS MATERIALIZED (
  SELECT conv_id,
         list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT conv_id, turns,
         xor(4294967295::BIGINT, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda c, step: xor(c >> 1, 3988292384::BIGINT * (c & 1))))) % 6 AS h
  FROM own
), rebuilt AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(g.turns[1 : c.h], []), c.turns[c.h + 1 :]) AS turns
  FROM headed c LEFT JOIN own g ON g.conv_id = c.conv_id - ((c.conv_id % 100) + 100) % 100
), nodes AS MATERIALIZED (
  SELECT turns[1 : d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends_sha256
  FROM rebuilt, unnest(range(0, len(turns) + 1)) g(d) GROUP BY path, depth
), children AS (
  SELECT path[1 : depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), weighed AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * length(n.path[depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN children c ON c.path = n.path
), above AS (
  SELECT path[1 : d] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM weighed, unnest(range(0, depth + 1)) g(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves, a.saved_tokens, n.ends_sha256
FROM weighed n JOIN above a ON a.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1 : n.depth - 1]
"""
