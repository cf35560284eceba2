"""Registered queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shockwell.llm import (
    ans, collocations, exact_dedup, jaccard, packing, periodic_runs, pii, quality, sampling, sharding, simhash, token_counts, toxicity,
)
from shockwell.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ans.round_trip(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted_documents(table(spark, sf_dir, "documents"))


def op8_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_segmentations(table(spark, sf_dir, "documents")).drop("ids")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic_runs.planted))


OP10_SQL = """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id::BIGINT AS doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""

OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents WHERE text IS NOT NULL
), words AS (
    SELECT lang, p, unnest(w) AS w1, unnest(range(len(w))) AS i FROM (
        SELECT lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces)
), threes AS (
    SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM words WINDOW s AS (PARTITION BY p ORDER BY i)
), phrases AS (
    SELECT lang, 1 AS k, w1 AS phrase FROM threes
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM threes WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM threes WHERE w3 IS NOT NULL
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM phrases GROUP BY ALL
), totals AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
    SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.k, j.j, x.a AS l, y.a AS r,
        ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
    FROM c JOIN (VALUES (1), (2)) j(j) ON j.j < c.k
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j.j], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j.j + 1:], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), covers AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
), free AS (
    SELECT lowest.* FROM lowest LEFT JOIN covers USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS id, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
    FROM documents
), classes AS (
    SELECT min(id) AS c, w FROM texts WHERE len(w) > 0 GROUP BY w
), words AS (
    SELECT c, len(w) AS n, unnest(w) AS w1, unnest(range(len(w))) AS i FROM classes
), shingles AS (
    SELECT DISTINCT c, concat_ws(' ', w1, lead(w1) OVER s, lead(w1, 2) OVER s, lead(w1, 3) OVER s, lead(w1, 4) OVER s) AS g
    FROM words WINDOW s AS (PARTITION BY c ORDER BY i) QUALIFY i = 0 OR i <= n - 5
), sizes AS (
    SELECT c, count(*) AS n FROM shingles GROUP BY c
), links AS (
    SELECT a, b FROM (
        SELECT x.c AS a, y.c AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.g = y.g AND x.c <> y.c GROUP BY ALL)
    JOIN sizes p ON p.c = a JOIN sizes q ON q.c = b WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach(c, r) AS (
    SELECT c, c FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.r
), rows AS (
    SELECT id, doc_id, c FROM texts LEFT JOIN classes USING (w)
), least AS (
    SELECT reach.c, min(doc_id) AS component_id FROM reach JOIN rows ON rows.c = reach.r GROUP BY reach.c
)
SELECT doc_id::BIGINT AS doc_id, coalesce(n, 0) AS n_shingles,
    CASE WHEN c IS NULL THEN doc_id ELSE component_id END::BIGINT AS component_id
FROM rows LEFT JOIN sizes USING (c) LEFT JOIN least USING (c)
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_sharding": op5_sharding,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_sampled_segmentations": op8_sampled_segmentations,
    "op9_simhash": op9_simhash,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op10_exact_dedup": OP10_SQL, "op11_collocations": OP11_SQL, "op12_jaccard_join": OP12_SQL}
