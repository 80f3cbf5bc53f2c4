"""Registered queries of the dealt operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from terrier.llm import bpe, codes, dedup, htmltext, licenses, lm, negatives, packing, pii, quality, rules, search, urls

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit(quality.training_rows(docs, (4, 2)), table(spark, sf, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", (quality.remainder("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op3_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_bpe(spark, sf):
    return bpe.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rules.judge(docs, rules.fit(docs, table(spark, sf, "labels"))).drop("text")


@query
def op8_pii(spark, sf):
    return pii.digest(pii.detect(table(spark, sf, "documents").select("doc_id", "text")))


@query
def op9_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query
def op4_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"), table(spark, sf, "labels"))


@query
def op10_topk_search(spark, sf):
    return search.top_k(table(spark, sf, "embeddings"))


ORACLES["op10_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op7_minhash_near_dedup(spark, sf):
    return dedup.classes(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op1_lm_scoring(spark, sf):
    return lm.score(table(spark, sf, "documents"))


@query
def op11_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved))


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


@query
def op12_html_extraction(spark, sf):
    return htmltext.extract(table(spark, sf, "pages"))


@query
def op13_vector_codes(spark, sf):
    coded = codes.encode(table(spark, sf, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(rounds: int = 4) -> str:
    """Assignment and update of the codebooks, round by round, as one statement."""
    steps = ["""k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", """p AS MATERIALIZED (
  SELECT vec_id, label, part, list_slice(v, part * (len(v) // 4) + 1, (part + 1) * (len(v) // 4)) AS x
  FROM k, (SELECT unnest(range(4)) AS part))""", """b0 AS MATERIALIZED (
  SELECT part, n AS entry, x AS e
  FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS n FROM p) WHERE n < 256)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, label, part, x, best.entry AS entry, best.far AS far FROM (
    SELECT vec_id, any_value(label) AS label, part, any_value(x) AS x, min({{'far': list_dot_product(x, x)
      - 2 * list_dot_product(x, e) + list_dot_product(e, e), 'entry': entry}}) AS best
    FROM p JOIN b{r} USING (part) GROUP BY vec_id, part))""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS DOUBLE) ORDER BY place) AS e FROM (
    SELECT part, entry, place, sum(CAST(y AS BIGINT)) AS total, count(*) AS n FROM (
      SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS place FROM a{r})
    GROUP BY part, entry, place) GROUP BY part, entry)""")
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m{r}.e, b{r}.e) AS e FROM b{r} LEFT JOIN m{r} USING (part, entry))""")
    steps.append(f"""h AS (
  SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ','
    ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})""")
    steps.append(f"""c AS (
  SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code,
    CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c, h"""


ORACLES["op13_vector_codes"] = _codes_sql()
