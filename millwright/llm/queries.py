"""Registered queries of the corpus operators: name -> (Spark callable, SQL twin or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import (
    chat,
    decontaminate,
    divergence,
    importance,
    jaccard,
    line_dedup,
    mixing,
    pieces,
    repeats,
    rules,
    token_counts,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text")
    )
    return chat.chat_digests(chat.chats(rows.unionByName(probe)))


OP6_SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *,
    length(text) + (length(text) - length(replace(text, '\', '')))
      + length(array_to_string(regexp_extract_all(text, '#{3,}'), '')) - 2 * len(regexp_extract_all(text, '#{3,}'))
      + length(array_to_string(regexp_extract_all(text, ':{2,}'), '')) - len(regexp_extract_all(text, ':{2,}'))
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escaped,
    length(CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' ELSE '### Assistant: ' END) + 9 AS around
  FROM all_rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + around)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text) || ',', '(system,)?(user,assistant,)+') AS valid
FROM t GROUP BY conv_id
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS o
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM s
), w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, (3 * source_size)::DOUBLE AS cap FROM r
), l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER p, 0.0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0.0::DOUBLE)) AS level
  FROM w WINDOW p AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, least(cap, coalesce((SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1) * weight, cap)) AS target FROM l
), b AS (
  SELECT d.*, row_number() OVER () AS id, rank, source_size, target, round(target)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS rounds FROM b
), e AS (
  SELECT *, greatest(0, least(size, quota - rounds * source_size - earlier)) AS part FROM q
), rounds AS (
  SELECT *, unnest(range(rounds + CASE WHEN part > 0 THEN 1 ELSE 0 END)) AS round FROM e WHERE rounds * size + part > 0
), shares AS (
  SELECT *, CASE WHEN round < rounds THEN size ELSE part END AS words,
    least(1.0::DOUBLE, (round * source_size + earlier + (CASE WHEN round < rounds THEN size ELSE part END)::DOUBLE / 2.0::DOUBLE) / quota::DOUBLE) AS share
  FROM rounds
), segments AS (
  SELECT k, lo::DOUBLE AS lo, hi::DOUBLE AS hi, t0::DOUBLE AS t0, a::DOUBLE AS a, slope::DOUBLE AS slope
  FROM (VALUES (0, 0, 0.375, 0, 0.5, 1), (0, 0.375, 2, 0.5, 1, 1), (1, 0, 0.5, 0, 1, 0), (1, 0.5, 2, 0.5, 1, 0),
    (2, 0, 0.625, 0, 1.5, -1), (2, 0.625, 2, 0.5, 1, -1)) AS v(k, lo, hi, t0, a, slope)
), times AS (
  SELECT shares.*, t0 + least(0.5::DOUBLE, greatest(0::DOUBLE,
    2::DOUBLE * (share - lo) / (a + sqrt(greatest(0::DOUBLE, a * a + 2::DOUBLE * slope * (share - lo)))))) AS train_time
  FROM shares JOIN segments ON rank % 3 = k AND share >= lo AND share < hi
), places AS (
  SELECT id, words, coalesce(sum(words) OVER (ORDER BY train_time, o, source NULLS LAST, round, earlier
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
  FROM times
), first AS (
  SELECT id, min(position)::BIGINT AS position FROM places GROUP BY id
)
SELECT doc_id, size, source_size, target, (rounds * size + part)::BIGINT AS taken, position
FROM e LEFT JOIN first USING (id)
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    both = pieces.round_trip(table(spark, sf_dir, "documents"), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS item
  FROM d
), k AS (
  SELECT lang, item FROM w GROUP BY lang, item HAVING count(DISTINCT id) >= 3
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, item, count(*) AS n FROM w JOIN k USING (lang, item) GROUP BY ALL
), v AS (
  SELECT lang, count(*) AS v FROM k GROUP BY lang
), cells AS (
  SELECT g.lang, g.source, k.item, coalesce(c.n, 0) AS n, v.v, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS size
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, item)
), shares AS (
  SELECT *, (1 + (1000000000::HUGEINT * (n + 1)) // (size + v))::BIGINT AS p FROM cells
), wide AS (
  SELECT lang, item, sum(n) AS n, any_value(v) AS v FROM cells GROUP BY lang, item
), whole AS (
  SELECT lang, item, (1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v))::BIGINT AS q FROM wide
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.item = y.item AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
), terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM shares s JOIN whole USING (lang, item) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_jaccard_join": (op2_jaccard_join, None),
    "op3_token_counts": (op3_token_counts, None),
    "op4_line_dedup": (op4_line_dedup, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_chat_format": (op6_chat_format, OP6_SQL),
    "op7_decontamination": (op7_decontamination, None),
    "op8_mixture": (op8_mixture, OP8_SQL),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_suffix_array": (op10_suffix_array, None),
    "op11_sentencepiece": (op11_sentencepiece, None),
    "op12_whitening": (op12_whitening, None),
    "op13_source_divergence": (op13_source_divergence, OP13_SQL),
}
