"""Command line: ``books``, ``classify`` and ``clean``. A missing input exits with 1."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loregraph import sinks
from loregraph.plans.books import build_graph, classify_corpus, clean_corpus
from loregraph.sources.books import read_epubs
from loregraph.sources.corpus import read_corpus, read_wiki


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="loregraph", description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("books", help="EPUB files to entity graphs")
    b.add_argument("path")
    b.add_argument("--out", required=True)
    b.add_argument("--clear-cache", action="store_true")
    for name in ("classify", "clean"):
        c = sub.add_parser(name)
        c.add_argument("--corpus", required=True)
        c.add_argument("--wiki", required=True)
        c.add_argument("--execute", action="store_true", help="write; without it the job only reports")
        c.add_argument("--quiet", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("loregraph").getOrCreate()
    try:
        if a.job == "books":
            cache_path = f"{a.out}/cache"
            cache = sinks.load_or_empty(spark, cache_path, "key string, result string")
            if a.clear_cache:
                cache = cache.where("false")
            books, chapters = read_epubs(spark, a.path)
            g = build_graph(chapters, cache=cache)
            sinks.replace_table(cache.unionByName(g.answers.select("key", F.col("response").alias("result"))).dropDuplicates(["key"]), cache_path)
            counts = g.entities.groupBy("book_id").agg(F.count("*").alias("entities_resolved"))
            sinks.result_json(books, g.entities, g.edges, counts).select("book_id", F.col("json").alias("value")).write.mode("overwrite").partitionBy("book_id").text(f"{a.out}/results")
            return 0
        files = read_corpus(spark, a.corpus)
        if a.job == "classify":
            done, stats = classify_corpus(files, read_wiki(spark, a.wiki))
            changed = sinks.priority_files(done).withColumn("path", F.replace(F.regexp_replace("path", "^file:(//)?", ""), F.lit(a.corpus.removeprefix("file://") + "/"), F.lit("")))
        else:
            done, stats = clean_corpus(files, read_wiki(spark, a.wiki, labels=True))
            changed = sinks.archived(done, datetime.now().strftime("%Y%m%d_%H%M%S"))
        if not a.quiet:
            stats.show(truncate=False)
        if a.execute:
            root = a.corpus if "://" in a.corpus else f"file://{a.corpus}"
            if a.job == "classify":
                print(sinks.write_files(changed, root).count(), "files written")
            else:
                print(sinks.move_files(changed, root).count(), "files moved")
        return 0
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            print(str(e).splitlines()[0], file=sys.stderr)
            return 1
        raise


if __name__ == "__main__":
    sys.exit(main())
