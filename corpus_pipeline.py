"""From raw documents to token ids, in five stages; each works on all that the one before kept.

``run`` writes each stage as Parquet into the shared folder and reads it back, so a stage runs once and a
lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loregraph.llm import exact_dedup, mixing, near_dedup, toxicity, unigram
from loregraph.llm._util import load, new_folder

#: The vocabulary file; it isn't part of the repository.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels beside ``docs``."""
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with five-word similarity 0.8 or more the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, with the result of decoding."""
    return unigram.token_report(docs, MODEL_FILE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: SQL can't express the trained classifier, the sketches and the dual's solution.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
