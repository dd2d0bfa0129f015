"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loregraph.storage import checkpoint, new_folder, shared_dir, table

__all__ = ["WORD", "WS", "checkpoint", "load", "named", "new_folder", "picked", "ranked", "shards", "shared_dir", "table", "text_key", "words"]

#: Fixed value: the white space of every contract here, space and the controls 9 to 13.
WS = r"[\x20\x09-\x0D]+"
#: Fixed value: a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def shards(rows: int, each: int, least: int = 256) -> int:
    """Number of hash shards for so many rows: it grows with the data, so a shard doesn't."""
    return max(least, math.ceil(rows / each))


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes; null is the empty text. With a row's doc_id it names the row where
    doc_ids are null or repeat."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def named(docs: DataFrame, key: Column) -> DataFrame:
    """row (all columns of ``docs``, so that no name clashes), id (doc_id) and key."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), key.alias("key"))


def picked(docs: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``wanted`` (id, key, n) names by doc_id and key, null equal to null. Where
    ``n`` rows, more than one, share both, the least of them as JSON stays: they're folded on the map side.
    ``wanted`` is a written table."""
    rows = named(docs, key)
    at = wanted.select(F.col("id").alias("w_id"), F.col("key").alias("w_key"), "n")
    same = F.col("id").eqNullSafe(F.col("w_id")) & (F.col("key") == F.col("w_key"))
    out = rows.join(at.where("n = 1"), same, "left_semi").select("row.*")
    if at.where("n > 1").limit(1).count():
        many = rows.join(at.where("n > 1"), same, "left_semi").groupBy("id", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
        out = out.union(many.select("row.*"))
    return out


def ranked(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) among rows of equal ``key``. Ranks are counted within the parts in
    which the rows are written, so a key with any number of rows is never in one task; ``order`` holds in
    a part."""
    held = table(rows.withColumn("in_part", F.spark_partition_id()))
    before = Window.partitionBy(*key).orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy(*key, "in_part").agg(F.count("*").alias("c")).withColumn("start", F.coalesce(F.sum("c").over(before), F.lit(0)))
    starts = counts.select(*[F.col(k).alias(f"s_{k}") for k in key], F.col("in_part").alias("s_part"), "start")
    on = F.col("in_part") == F.col("s_part")
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"s_{k}"))
    within = Window.partitionBy(*key, "in_part").orderBy(*order)
    return held.join(starts, on).withColumn("rank", F.col("start") + F.row_number().over(within) - 1).drop("start", "s_part", "in_part", *[f"s_{k}" for k in key])
