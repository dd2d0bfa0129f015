"""Exports: one JSON a book, markdown entity files, archives, and event tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.operators.summarize import output_json
from loregraph.storage import drop, table


def append_events(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


#: Name of the file that says which version of a table holds.
CURRENT = "_current"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _current(spark: SparkSession, path: str) -> str | None:
    """The version that holds, None where there is none."""
    jvm, at, store = _store(spark, f"{path}/{CURRENT}")
    if not store.exists(at):
        return None
    source = store.open(at)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8").strip()
    finally:
        source.close()


def replace_table(rows: DataFrame, path: str) -> None:
    """Replace a table that ``rows`` may read. The new version is written beside the old one, and renaming
    a small file makes it hold: a run that ends in between leaves the old version. Only then the old goes."""
    spark = rows.sparkSession
    old, new = _current(spark, path), f"version-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{new}")
    jvm, at, store = _store(spark, f"{path}/{CURRENT}")
    _, staged, _ = _store(spark, f"{path}/{CURRENT}-{new}")
    out = store.create(staged, True)
    out.write(bytearray(new.encode()))
    out.close()
    replaced = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    replaced.rename(staged, at, overwrite)
    if old:
        drop(spark, f"{path}/{old}")


def load_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table as ``replace_table`` or a plain writer left it, or an empty one where there is none, or none
    that can be read: state that is lost is made anew."""
    empty = spark.createDataFrame([], schema)
    try:
        version = _current(spark, path)
        found = spark.read.parquet(f"{path}/{version}" if version else path)
        names = [f.name for f in empty.schema.fields]
        if not set(names) <= set(found.columns):
            return empty
        found = found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema.fields])
        found.write.format("noop").mode("overwrite").save()
        return found
    except Exception as e:  # noqa: BLE001
        if any(x in str(e) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "is not a Parquet file", "CANNOT_MERGE_SCHEMAS", "DATATYPE_MISMATCH")):
            return empty
        raise


def result_json(books: DataFrame, entities: DataFrame, edges: DataFrame, telemetry: DataFrame) -> DataFrame:
    """book_id, json: {metadata, entities, connections, telemetry}. A book's entities meet in one row, as
    the format asks; the tables stay the place for whole corpora."""
    e = output_json(entities).groupBy("book_id").agg(F.array_join(F.array_sort(F.collect_list("json")), ",").alias("e"))
    edge = F.struct(F.col("source"), F.col("target"), F.col("weight"), F.col("co_occurrence_chapters"))
    c = edges.groupBy("book_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), edge.alias("edge"))))["edge"]).alias("c"))
    t = telemetry.select("book_id", F.to_json(F.struct(*[x for x in telemetry.columns if x != "book_id"])).alias("t"))
    meta = F.to_json(F.struct(*books.columns), {"ignoreNullFields": "false"})
    whole = F.concat(F.lit('{"metadata":'), meta, F.lit(',"entities":['), F.coalesce("e", F.lit("")), F.lit('],"connections":'), F.coalesce("c", F.lit("[]")), F.lit(',"telemetry":'), F.coalesce("t", F.lit("{}")), F.lit("}"))
    return books.join(e, "book_id", "left").join(c, "book_id", "left").join(t, "book_id", "left").select("book_id", whole.alias("json"))


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write ``files`` (relative path, content) below ``root``, a URI that executors reach; returns the
    paths written. Writing twice gives the same files, so a repeated task does no harm."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                store.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(content.encode())
            yield pd.DataFrame({"path": pdf["path"]})

    return files.select("path", "content").mapInPandas(run, "path string")


def priority_files(classified: DataFrame) -> DataFrame:
    """``classified`` (path, content, priority, is_wiki_linked, wiki_entry_name) with the three keys of its
    front matter set; an old wiki_entry_name stays where there is no new one."""
    set_ = lambda text, key, value: F.when(text.rlike(rf"(?m)^{key}:"), F.regexp_replace(text, F.lit(rf"(?m)^{key}:.*$"), F.concat(F.lit(f"{key}: "), value))).otherwise(F.concat(text, F.lit(f"{key}: "), value, F.lit("\n")))
    end = F.locate("---", F.col("content"), 4)
    head, tail = F.substr("content", F.lit(1), end - 1), F.substr("content", end)
    head = set_(set_(head, "priority", F.col("priority")), "is_wiki_linked", F.col("is_wiki_linked").cast("string"))
    head = F.when(F.col("wiki_entry_name").isNotNull(), set_(head, "wiki_entry_name", F.col("wiki_entry_name"))).otherwise(head)
    return classified.where(F.col("content").startswith("---") & (end > 0)).select("path", F.concat(head, tail).alias("content"))


def archived(classified: DataFrame, stamp: str) -> DataFrame:
    """The files of noise entities with their place in the archive (path) and their old one (original); a
    dry run only counts them."""
    return classified.where("priority = 'noise'").select(F.concat(F.lit(f"archive/{stamp}/"), F.col("entity_type"), F.lit("s/"), F.col("name"), F.lit(".md")).alias("path"), F.col("path").alias("original"), "content")


def move_files(files: DataFrame, root: str) -> DataFrame:
    """Move ``files`` (path below ``root``, original, content): the copy is complete before the original
    goes, so a repeated task finds either of them. Returns the paths."""
    kept = table(files.select("path", "original", "content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            for original in pdf["original"]:
                store, at = fs.FileSystem.from_uri(original if "://" in original or original.startswith("/") else original.replace("file:/", "file:///", 1))
                if store.get_file_info(at).type == fs.FileType.File:
                    store.delete_file(at)
            yield pdf[["path"]]

    written = table(write_files(kept, root))
    return kept.join(written.distinct(), "path", "left_semi").select("path", "original").mapInPandas(run, "path string")


def entity_markdown(entities: DataFrame) -> DataFrame:
    """Files of the folders that ``sources.corpus`` reads."""
    head = F.concat(F.lit("---\nname: "), F.col("name"), F.lit("\nentity_type: "), F.col("entity_type"), F.lit("\naliases: ["), F.array_join("aliases", ", "), F.lit("]\noccurrence_count: "), F.col("occurrence_count").cast("string"), F.lit("\n---\n# "), F.col("name"), F.lit("\n\n"))
    return entities.select(F.concat(T.folder(F.col("entity_type")), F.lit("/"), F.col("entity_id"), F.lit(".md")).alias("path"), F.concat(head, F.coalesce("canonical_description", F.lit(""))).alias("content"))
