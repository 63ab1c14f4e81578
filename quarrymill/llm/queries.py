"""The registered queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import cdc, langid, media, mixing, packing, pii, prefix_forest, sharding, simhash, suffix_dedup
from quarrymill.llm.common import table


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.dedup_chunks(table(spark, sf_dir, "documents")).drop("kept")


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_media, op2_chunk_dedup, op3_prefix_forest, op4_simhash, op5_packing, op6_pii, op7_sharding, op8_language, op9_mixing, op10_suffix_dedup, pipeline)}

#: Removed spans by counting every window; the other operators need hashes, models or searches that DuckDB has not.
SUFFIX_SQL = """WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents), n AS (SELECT doc_id, h, len(h) // 2 AS n FROM d),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM n)),
s AS (SELECT doc_id, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING COUNT(*) > 1)),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS f FROM s),
r AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS r FROM g),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM r GROUP BY doc_id, r),
gaps AS (SELECT doc_id, COALESCE(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans UNION ALL SELECT n.doc_id, COALESCE(max(b), 0), any_value(n.n) FROM n LEFT JOIN spans s ON s.doc_id = n.doc_id GROUP BY n.doc_id),
kept AS (SELECT n.doc_id, string_agg(substr(n.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.a) AS h FROM n JOIN gaps g ON g.doc_id = n.doc_id GROUP BY n.doc_id)
SELECT n.doc_id, n.n AS n_bytes, COALESCE(c.removed, 0)::BIGINT AS n_removed, COALESCE(c.spans, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM n JOIN kept k ON k.doc_id = n.doc_id LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, COUNT(*) AS spans FROM spans GROUP BY doc_id) c ON c.doc_id = n.doc_id"""

ORACLE_SQL: dict[str, str] = {"op10_suffix_dedup": SUFFIX_SQL}
