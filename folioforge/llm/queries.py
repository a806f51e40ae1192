"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import langid, licenses, mixing, pieces, sharding, simhash, substring, tiff, topk, urlfilter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return topk.search(v, v.filter(F.col("vec_id") % 100 == 0), k=10, scale=1024)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removals(table(spark, sf_dir, "documents"), size=50)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, bits=64, max_distance=2)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark))


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.round_trip(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_topk, op2_substring_dedup, op3_mixing, op4_simhash, op5_url_filter, op6_tiff, op7_sharding, op8_licenses, op9_sentencepiece, op10_language_id, pipeline)
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
             AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS i, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM n),
o AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM h JOIN o USING (h) WHERE doc_id > first),
r AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id),
k AS (SELECT d.doc_id, d.w, coalesce(gone, []) AS gone FROM d LEFT JOIN r USING (doc_id)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
y AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS kept FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.p = x.p WHERE g.p IS NULL GROUP BY x.doc_id)
SELECT k.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN y USING (doc_id)""",
    "op5_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
t(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, rhost || rpath AS rule, verdict FROM p JOIN t ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) = 1)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
}
