"""Registered queries of the document operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import (
    bpe_automaton, exact_dedup, hard_negatives, language_id, line_dedup, lm_scoring, near_dedup,
    neighbours, packing, quality_classifier, quality_rules, sharding, vector_codes,
)
from cardlake.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function
    return register


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer file of the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_exact_dedup", r"""
WITH d AS (
  SELECT doc_id,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(table(spark, sf_dir, "documents")).drop("row")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


# DuckDB has no CRC-32: its table of 256 values is made by the polynomial, and the
# bytes of a text are folded through it.
@query("op3_sharding", r"""
WITH RECURSIVE bits AS (
  SELECT range AS i, 0 AS k, range::UBIGINT AS c FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END
  FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
hexed AS (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
  SELECT doc_id, (length(h) // 2 + 1)::BIGINT AS size,
    xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(length(h) // 2),
        lambda i: (('0x' || substr(h, 2 * i + 1, 2))::INTEGER)::UBIGINT)),
      lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT])))::BIGINT AS text_crc32
  FROM hexed, crc),
placed AS (
  SELECT *, sum(size) OVER o AS up_to, row_number() OVER o AS n, sum(size) OVER () AS whole
  FROM sized WINDOW o AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)),
cut AS (
  SELECT *, ((2 * up_to - size) * 16 // (2 * whole))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)


@query("op4_line_dedup", rf"""
WITH bare AS (
  SELECT page_id,
    coalesce(lower(regexp_extract(url, '{line_dedup.HOST}', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '{line_dedup.HIDDEN}', ' ', 'g'),
      '(?i)</?(?:{line_dedup.BLOCKS})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t
  FROM pages),
lined AS (
  SELECT page_id, host, list_filter(list_transform(string_split(regexp_replace(
    replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'),
      '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM bare),
totals AS (SELECT host, count(*) AS host_pages FROM lined GROUP BY host),
having_line AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined) GROUP BY host, line),
boilerplate AS (
  SELECT host, list(line) AS known FROM having_line JOIN totals USING (host)
  WHERE n >= 2 AND n > CAST(0.3 AS DOUBLE) * host_pages GROUP BY host),
kept AS (
  SELECT page_id, host, host_pages, lines, list_filter(lines,
    lambda x: NOT list_contains(coalesce(known, []), x)) AS kept
  FROM lined JOIN totals USING (host) LEFT JOIN boilerplate USING (host))
SELECT page_id, host, host_pages, len(lines)::INTEGER AS n_lines,
  (len(lines) - len(kept))::INTEGER AS n_dropped,
  coalesce(array_to_string(kept, chr(10)), '') AS text
FROM kept""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.language_scores(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op7_bpe_automaton")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.code_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("row")


# Integer vectors of the rows whose vector is whole.
WHOLE = """embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
FLOORS = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"


@query("op11_hard_negatives", f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    {FLOORS} AS v
  FROM embeddings WHERE label IS NOT NULL AND {WHOLE}),
scored AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, e.label = a.label AS same,
    list_sum(list_transform(list_zip(a.v, e.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


def _code_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Codebooks c0, c1, ... with the parts assigned to them in a0, a1, ..."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS (
  SELECT vec_id, label, p, v, min({{'away': away, 'e': e}}) AS best FROM (
    SELECT x.vec_id, x.label, x.p, x.v, c.e,
      list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
        AS away
    FROM parts x JOIN c{n} c USING (p)) GROUP BY vec_id, label, p, v)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT p, e, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
    SELECT p, best.e AS e, i, sum(v[i]) AS total, count(*) AS n
    FROM a{n}, range(1, 5) r(i) GROUP BY p, best.e, i) GROUP BY p, e),
c{n + 1} AS (
  SELECT p, e, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (p, e))""")
    return ",".join(steps)


# Four components a part, as in the given tables.
@query("op12_vector_codes", f"""
WITH kept AS (
  SELECT vec_id, label, {FLOORS} AS v FROM embeddings WHERE {WHOLE}),
parts AS (
  SELECT vec_id, label, p, v[4 * p + 1:4 * p + 4] AS v FROM kept, range(16) r(p)),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
c0 AS (SELECT p, e, v FROM parts JOIN first USING (vec_id)),
{_code_sql().lstrip()},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
    sum(best.away)::BIGINT AS error
  FROM a{vector_codes.ROUNDS} GROUP BY vec_id, label),
books AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM c{vector_codes.ROUNDS}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  codebooks_sha256
FROM coded, books""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query("op13_nearest_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_by_cosine(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
