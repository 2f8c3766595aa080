"""From raw documents to token records: language ID, near-duplicates, decontamination, mixing, binary output.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. A document stays a document through the filtering
stages; the mix drops and repeats whole documents; the last stage writes records and returns their index.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import covering_dedup, curriculum, decontaminate, language_id, storage, token_records

ORACLE_SQL = None
#: Weights of the sources in turn over the training time: growing, steady, fading.
SCHEDULES = (((0.0, 1.0), (1.0, 3.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 4.0), (0.5, 1.0), (1.0, 1.0)))


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined, or determined with a probability under 0.4, go."""
    storage.small_batches(spark)
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model, least=0.4)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles, the one with the smallest id stays."""
    storage.small_batches(spark)
    return covering_dedup.drop_near_duplicates(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in twenty lies in a window of the benchmark go."""
    storage.small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to weights 5, 2, 1 in turn, up to three times their size, and ordered by training position."""
    return curriculum.mix_documents(docs, weights=(5, 2, 1), cap=3, schedules=SCHEDULES)


def write_token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token records to the shared folder and returns their index."""
    path = storage.fresh_path(storage.small_batches(spark), "corpus-records")
    token_records.write_records(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "record", "offset", "length")


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_records", write_token_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = storage.spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = storage.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
