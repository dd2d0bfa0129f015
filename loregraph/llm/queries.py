"""The driver's queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, html_extract, licenses, maxscore, mixing, near_dedup, pii, toxicity, unigram, warc
from ._util import load

#: The vocabulary file of op6; it isn't part of the repository.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"), k=3, percent=85)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(load(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(load(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(load(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_report(load(spark, sf_dir, "documents"), MODEL_FILE)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(load(spark, sf_dir, "pages"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(load(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_near_dedup, op2_html_extract, op3_exact_dedup, op4_maxscore, op5_pii, op6_sentencepiece, op7_toxicity, op8_mixing, op9_warc, op10_licenses)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.SQL, "op4_maxscore": maxscore.SQL, "op5_pii": pii.sql(), "op9_warc": warc.SQL}
