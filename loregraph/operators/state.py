"""Registry, result cache and checkpoints as keyed tables: upserts, staleness, work still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.text import content_hash

REGISTRY = "book_id string, title string, author string, file_path string, content_hash string, status string, ingested_at timestamp, entities_extracted int, chapters int"
CACHE = "key string, completed_at timestamp, result string, model_name string, prompt_hash string"


def book_records(books: DataFrame, status: str = "ingested") -> DataFrame:
    """``books`` (book_id, title, author, file_path, content_hash, chapters) as new rows of the registry."""
    return books.select("book_id", "title", "author", "file_path", "content_hash", F.lit(status).alias("status"), F.current_timestamp().alias("ingested_at"), F.lit(0).alias("entities_extracted"), F.col("chapters").cast("int").alias("chapters"))


def latest(rows: DataFrame, key: str | list[str], at: str) -> DataFrame:
    """The newest row of each key: an upsert is a union and this."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*rows.columns)


def upsert(table: DataFrame, changes: DataFrame, key: str | list[str], at: str) -> DataFrame:
    return latest(table.unionByName(changes), key, at)


def update_counts(registry: DataFrame, counts: DataFrame) -> DataFrame:
    """``counts`` (book_id, n) set entities_extracted; books that aren't registered are left out."""
    out = registry.join(counts.select("book_id", F.col("n").alias("_n")), "book_id", "left")
    return out.withColumn("entities_extracted", F.coalesce(F.col("_n").cast("int"), "entities_extracted")).select(*registry.columns)


def new_books(books: DataFrame, registry: DataFrame) -> DataFrame:
    """Books whose content isn't registered; of equal ones only the first by book_id."""
    fresh = books.join(registry.select("content_hash").distinct(), "content_hash", "left_anti")
    rest = [c for c in books.columns if c != "content_hash"]
    first = fresh.groupBy("content_hash").agg(F.min_by(F.struct(*rest), "book_id").alias("_row"))
    return first.select("content_hash", *[F.col("_row")[c].alias(c) for c in rest]).select(*books.columns)


def by_hash(registry: DataFrame, hashes: DataFrame) -> DataFrame:
    return registry.join(hashes.select("content_hash").distinct(), "content_hash", "left_semi")


def by_id(registry: DataFrame, book_id: str) -> DataFrame:
    return registry.where(F.col("book_id") == book_id)


def misses(work: DataFrame, cache: DataFrame, key: str = "key", recompute_empty: bool = False) -> DataFrame:
    """Work without a result. With ``recompute_empty`` an empty result counts as none."""
    done = cache.where("coalesce(result, '') not in ('', '[]', '{}')") if recompute_empty else cache
    return work.join(done.select(key).distinct(), key, "left_anti")


def hits(work: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    return work.join(cache.select(key, "result"), key)


def is_stale(model: Column, prompt: Column, current_model: Column | str, current_prompt: Column | str) -> Column:
    """A missing row, another model or another prompt."""
    now = [F.lit(x) if isinstance(x, str) else x for x in (current_model, current_prompt)]
    return ~(model.eqNullSafe(now[0]) & prompt.eqNullSafe(now[1]))


def invalidate_model(cache: DataFrame, model: str) -> DataFrame:
    return cache.where(~F.col("model_name").eqNullSafe(model))


def cache_stats(cache: DataFrame) -> DataFrame:
    return cache.agg(F.count("*").alias("total_entries"), F.count_if(F.col("model_name").isNull()).alias("entries_without_model"))


def result_hash(result: Column) -> Column:
    return content_hash(result, 12)


def changed_results(log: DataFrame) -> DataFrame:
    """Rows of a cache's log whose result differs from the same key's row before."""
    before = Window.partitionBy("key").orderBy("completed_at")
    now = result_hash(F.col("result"))
    return log.withColumn("result_hash", now).withColumn("previous_hash", F.lag("result_hash").over(before)).where("previous_hash is not null and previous_hash <> result_hash")


def chapters_left(chapters: DataFrame, committed: DataFrame) -> DataFrame:
    """Chapters without a commit, by book and index: chapters may share titles."""
    return chapters.join(committed.select("book_id", "chapter_index").distinct(), ["book_id", "chapter_index"], "left_anti")


def checkpoint_rows(done: DataFrame, every: int = T.CHECKPOINT_EVERY) -> DataFrame:
    """Completed chapters after which a checkpoint is due: each book's every ``every``-th by time."""
    order = Window.partitionBy("book_id").orderBy("completed_at", "chapter_index")
    return done.withColumn("n_done", F.row_number().over(order)).where(F.col("n_done") % every == 0)


def progress_percent(done: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(done.cast("double") / total * 100)
