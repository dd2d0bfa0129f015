"""Incremental ingest and event feeds as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loregraph import types as T
from loregraph.functions.text import content_hash
from loregraph.operators.state import REGISTRY, new_books, upsert
from loregraph.sinks import load_or_empty, replace_table


def ingest(books: DataFrame, registry_path: str, out_path: str, checkpoint_path: str) -> StreamingQuery:
    """Take each new content once: a stream of books (book_id, title, author, file_path, content) goes to
    ``out_path``, and the registry learns them. A batch that repeats after a failure overwrites itself."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        registry = load_or_empty(spark, registry_path, REGISTRY)
        hashed = rows.withColumn("content_hash", content_hash(F.col("content")))
        # What this batch registered before it failed isn't old to it.
        earlier = registry.where(F.col("status") != f"batch {number}")
        fresh = new_books(hashed, earlier)
        fresh.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        done = spark.read.parquet(f"{out_path}/batch={number}")
        records = done.select("book_id", "title", "author", "file_path", "content_hash", F.lit(f"batch {number}").alias("status"), F.current_timestamp().alias("ingested_at"), F.lit(0).alias("entities_extracted"), F.lit(None).cast("int").alias("chapters"))
        replace_table(upsert(registry, records, "book_id", "ingested_at"), registry_path)

    return books.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()


def counters(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Totals a name and window of a stream of metrics (name, value, ts)."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "name").agg(F.sum("value").alias("total"))


def active_spells(events: DataFrame, gap: int = T.SILENT_SECONDS, late: str = "10 minutes") -> DataFrame:
    """Spells of a run's progress events without a silence of more than ``gap`` seconds."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", f"{gap} seconds"), "run_id").agg(F.count("*").alias("events"))
