"""Documents to training tokens: quality, near copies, benchmark overlap, mixing, token files.

Each stage takes (spark, docs, sf_dir); its result is written, and read again for the next.  The
tables a stage cuts on its way go when the next one starts, so only one stage's lie on disk.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cellarium.llm import decontaminate, mixing, quality, simhash, token_store
from cellarium.llm.common import table
from cellarium.llm.queries import tokenizer_path
from cellarium.plans.scratch import end_stage, new_path, next_stage, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def staged(stage: Stage) -> Stage:
    @wraps(stage)
    def start(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        next_stage(spark)
        return stage(spark, docs, sf_dir)

    return start


@staged
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


@staged
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


@staged
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@staged
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


@staged
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    # Workers outlive the stage, and whatever runs next shares the executor's memory with them.
    token_store.write_store(docs, path, tokenizer_path(), remember=False)
    return token_store.fetch(docs.select("doc_id"), path).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "block", "bucket", "slot"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Robust estimates, fingerprints and byte-pair encoding are beyond SQL; tests hold the result
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name, outlive=True)
    end_stage(spark)
    return docs
