"""The registered queries of this package, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellarium.llm import (
    decontaminate,
    hard_negatives,
    html_text,
    itq,
    langid,
    mixing,
    ppm,
    quality,
    resampling,
    secret_scan,
    simhash,
    substrings,
    token_store,
)
from cellarium.llm.common import id_number, table
from cellarium.plans.scratch import new_path

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = new_path(spark, "tokens")
    token_store.write_store(docs, path, tokenizer_path())
    return token_store.fetch(docs.select("doc_id"), path).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "block", "bucket", "slot"
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ppm.score(docs, id_number(F.col("doc_id")) % 10 == 0, across=True)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_number(F.col("doc_id")) % 4 == 2
    model = langid.learn(docs.where(~held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.judge(docs, carry=["doc_id", "lang", "source"])
    return judged.select(
        F.col("_doc.doc_id").alias("doc_id"), *quality.STATS, "base_failed", "kept", "distance"
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.take(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select(
        F.col("_doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "shard"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.overlaps(docs, benchmark)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.spans(table(spark, sf_dir, "documents")))


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents"), keep="none")
    length = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.dedup(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, benchmark)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    number = F.col("vec_id")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("bigint"))
    rows = rows.where(finite)
    return hard_negatives.mine(
        rows.select(number, label.alias("label"), vector.alias("vector"), (number % 100 == 0).alias("anchor"))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_id": op2_language_id,
    "op3_token_store": op3_token_store,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extraction": op5_html_extraction,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_repeated_substrings": op10_repeated_substrings,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_resampling": op12_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

# CRC-32 of every distinct word by its bits, the lowest of each byte first.
OP12_SQL = f"""
WITH lowered AS (
  SELECT d.doc_id, row_number() OVER () AS place,
         regexp_extract_all({LOWERED},
                            {WORD}) AS words FROM documents d),
aimed AS (
  SELECT regexp_extract_all({LOWERED},
                            {WORD}) AS words FROM benchmark),
each AS (SELECT DISTINCT unnest(words) AS word FROM (SELECT words FROM lowered UNION ALL SELECT words FROM aimed)),
bits AS (
  SELECT word, hex(encode(word)) AS digits FROM each),
hashed AS (
  SELECT word,
    xor(list_reduce(
      list_transform(range(0, length(digits) * 4), lambda i: CAST(
        (CAST('0x' || substr(digits, CAST(i // 8 * 2 + 1 AS BIGINT), 2) AS BIGINT) >> (i % 8)) & 1 AS BIGINT)),
      lambda c, b: xor(c >> 1, 3988292384 * (xor(c & 1, b))), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM bits),
own AS (
  SELECT place, bucket FROM (SELECT place, unnest(words) AS word FROM lowered) JOIN hashed USING (word)),
aim AS (
  SELECT bucket FROM (SELECT unnest(words) AS word FROM aimed) JOIN hashed USING (word)),
totals AS (SELECT (SELECT count(*) FROM own) AS all_s, (SELECT count(*) FROM aim) AS all_t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
      ((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT bucket, count(*) AS s FROM own GROUP BY bucket)
  LEFT JOIN (SELECT bucket, count(*) AS t FROM aim GROUP BY bucket) USING (bucket), totals),
weighed AS (
  SELECT place, CAST(sum(gain) AS BIGINT) AS weight FROM own JOIN gain USING (bucket) GROUP BY place),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM lowered LEFT JOIN weighed USING (place)),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
      PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS nth FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN nth <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN nth END AS rank
FROM placed
"""

OP13_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
near AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM near JOIN met USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10
"""

ORACLES: dict[str, str] = {"op12_resampling": OP12_SQL, "op13_hard_negatives": OP13_SQL}
