"""The weighted graph of entities that share chunks, and components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loregraph.functions.text import chapter_of
from loregraph.storage import done_with, table


def mention_index(mentions: DataFrame) -> DataFrame:
    """entity, chunk: each entity once a chunk. An entity is its type and lower-case name."""
    return mentions.select(F.concat_ws(":", "entity_type", F.lower("name")).alias("entity"), F.col("chunk_id").alias("chunk")).distinct()


def connections(index: DataFrame, min_weight: int = 1, by: list[str] = [], chapters: bool = False) -> DataFrame:  # noqa: B006
    """source < target, weight (number of chunks with both), of edges of at least ``min_weight``; with
    ``chapters`` also co_occurrence_chapters, sorted as text. ``index``: ``by``, entity, chunk."""
    m = index.select(*by, "entity", "chunk").distinct()
    a, b = m.withColumnRenamed("entity", "source"), m.withColumnRenamed("entity", "target")
    pairs = a.join(b, [*by, "chunk"]).where("source < target")
    more = [F.sort_array(F.collect_set(chapter_of(F.col("chunk")))).alias("co_occurrence_chapters")] if chapters else []
    return pairs.groupBy(*by, "source", "target").agg(F.count("*").alias("weight"), *more).where(F.col("weight") >= min_weight)


def strongest(edges: DataFrame, n: int) -> DataFrame:
    return edges.orderBy(F.desc("weight"), "source", "target").limit(n)


def resolved(index: DataFrame, ids: DataFrame) -> DataFrame:
    """``index`` with mention keys replaced by entity ids: ``ids`` (entity, entity_id)."""
    return index.join(ids, "entity", "left").withColumn("entity", F.coalesce("entity_id", "entity")).drop("entity_id").distinct()


def _jump(parent: DataFrame) -> DataFrame:
    """Each node's parent's parent; a parent without a row is a root."""
    up = parent.select(F.col("v").alias("p_v"), F.col("p").alias("p_p"))
    return parent.join(up, F.col("p") == F.col("p_v"), "left").select("v", F.coalesce("p_p", "p").alias("p"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b of one orderable type) to (v, root): the smallest node of each node's component, for
    every node with a link.

    Each round ranks nodes by a new hash, points a node to its first neighbour in that rank if that comes
    before it, shortens the pointers twice and contracts the links. Ranks are random, so paths of pointers
    are short and a chain shrinks by a factor a round like any other shape. A node with a great many
    links is folded on the map side; links that become equal merge.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = table(links.where("a <> b").select(*pair).distinct())
    label, turn = None, 0
    while edges.limit(1).count():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        turn += 1
        ranked = edges.select(F.least(rank("a"), rank("b")).alias("u"), F.greatest(rank("a"), rank("b"))["x"].alias("v"))
        parent = ranked.groupBy("v").agg(F.min("u").alias("u")).select("v", F.col("u.x").alias("p"))
        parent = table(_jump(_jump(parent)))
        new = parent
        if label is not None:
            nxt = parent.select(F.col("v").alias("n_v"), F.col("p").alias("n_p"))
            old = label.join(nxt, F.col("p") == F.col("n_v"), "left").select("v", F.coalesce("n_p", "p").alias("p"))
            new = old.unionByName(parent.join(label.select("v"), "v", "left_anti"))
        old_label, label = label, table(new)
        pa, pb = parent.select(F.col("v").alias("a"), F.col("p").alias("pa")), parent.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(pa, "a", "left").join(pb, "b", "left").select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
        old_edges, edges = edges, table(moved.where("a <> b").select(*pair).distinct())
        done_with(old_edges, parent, *([old_label] if old_label is not None else []))
    if label is None:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root")).where("false")
    ends = table(label.groupBy(F.col("p").alias("e")).agg(F.least(F.min("v"), F.first("p")).alias("root")))
    return label.join(ends, F.col("p") == F.col("e")).select("v", "root").unionByName(ends.select(F.col("e").alias("v"), "root"))
