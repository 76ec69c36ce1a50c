"""The corpus pipeline: from raw documents to checked token ids, one operator of remitlens.llm after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. A
stage works on all rows that the one before it kept, and its decisions take effect:

1. language ID drops documents without a letter, and those in which no language has half of the letters;
2. line dedup deletes later repeats of runs of lines, and documents with no line left;
3. MinHash near-dedup keeps one document of each group;
4. benchmark decontamination drops documents that contain a test item;
5. SentencePiece encodes every document and decodes it again.

NULLs, empty and long texts, repeated rows and further columns are handled as each operator's module states; empty tables
pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from remitlens.llm import decontam, language, lines, minhash, sentencepieces
from remitlens.llm.common import documents, prepare, settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.keep_identified(docs, language.train(docs.where(language.learnable())))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lines.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencepieces.checked(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode_pieces),
]

#: SQL can't express training, Viterbi labels or the piece lattice; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
