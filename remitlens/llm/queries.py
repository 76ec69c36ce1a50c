"""One query for each text operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import (
    conversations,
    decontam,
    exact,
    language,
    lines,
    minhash,
    mixing,
    periods,
    sentencepieces,
    sharding,
    substrings,
    suffixes,
    tokens,
)
from remitlens.llm.common import documents, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return add


@query("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_table(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), shards=40)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query("op10_exact_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half of the rows, by a checksum of the id, plays the past that is already indexed."""
    is_past = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return exact.exact_duplicates(documents(spark, sf_dir), is_past).drop("in_past")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train(docs.where(language.learnable()))
    found = language.identify(docs, model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", F.size("spans").alias("n_spans"))


@query("op8_minhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), minhash.STRICT)


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated_substrings(documents(spark, sf_dir))


@query("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated_lines(documents(spark, sf_dir))
    return found.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepieces.checked(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents only: a row for each document and item, not kept."""
    found = decontam.contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("kept", F.lit(False))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeated_strings(documents(spark, sf_dir))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_facts(periods.periodic_runs(periods.planted(documents(spark, sf_dir))))


@query("op13_source_mixing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))
