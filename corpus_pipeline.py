"""Training corpus from raw documents: five stages, each on all that its predecessor kept.

1. quality: documents that the weak-supervision verdict rejects go.
2. near_duplicates: of documents linked by 5-word shingles at a similarity of 0.8, the smallest doc_id stays.
3. decontaminate: documents with a benchmark item in them go.
4. mix: every source comes to its target number of words; documents are left out or repeated.
5. tokens: the mixed documents become files of equal-length id sequences; returns, per document (a row
   for each repetition), doc_id, start, n_tokens and ids_crc32, read back from the files.

Stages 1 to 4 return the columns of ``documents``. Each stage gets the stored result of the one before.
Nulls, empty texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provisio.llm import decontam, mixing, quality, setjoin, tokens
from provisio.llm.queries import END_ID, table, vocabulary
from provisio.llm.store import BATCH, settings, store

BATCH_ROWS = 2000  # texts that a task holds at once


def small_batches(spark: SparkSession) -> None:
    """Sets the size of batches. A stage's result is computed when its caller writes it, so the setting stays; ``run`` puts it back."""
    spark.conf.set(BATCH, str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep(docs, quality.fit(quality.measure(docs)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return setjoin.keep_one(docs, shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    manifest = tokens.write_tokens(docs, vocabulary(), END_ID)
    return tokens.read_documents(spark, manifest, docs.schema["doc_id"].dataType.simpleString())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("mix", mixing_stage),
    ("tokens", token_stage),
]

#: No SQL: expectation-maximisation, the cube method and the tokenizer are not expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with settings(spark, {BATCH: str(BATCH_ROWS)}):  # what the stages set ends here
        for number, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if number < len(STAGES) - 1:
                docs = store(docs, f"stage-{name}")
    return docs
