"""Merging mentions: within a chapter, over a book, and by alias groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F




def valid(mentions: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Mentions with a name and a type of ``types`` (any case); absent aliases and contexts are empty."""
    kind = F.lower("entity_type")
    keep = (F.coalesce(F.col("name"), F.lit("")) != "") & kind.isin(*types)
    return mentions.where(keep).withColumns({"entity_type": kind, "aliases": F.coalesce("aliases", F.expr("cast(array() as array<string>)")), "context": F.coalesce("context", F.lit(""))})


def _union(arrays: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(arrays))))


def _longest(context: Column, ord_: Column) -> Column:
    """The longest context, of equal ones the first."""
    return F.max_by(context, F.struct(F.length(context), -ord_))


def merge_raw(mentions: DataFrame, by: list[str] = ["book_id"]) -> DataFrame:  # noqa: B006
    """One row per ``by``, lower-case name and type: the first mention's spelling and chapter, all
    aliases (sorted), the longest context and the number of mentions."""
    return mentions.groupBy(*by, F.lower("name").alias("name_key"), "entity_type").agg(
        F.min_by("name", "ord").alias("name"), F.min_by("chapter_index", "ord").alias("chapter_index"), _union(F.col("aliases")).alias("aliases"),
        _longest(F.col("context"), F.col("ord")).alias("context"), F.count("*").cast("int").alias("occurrence_count"), F.min("ord").alias("ord"),
    )


def merge_two_level(mentions: DataFrame) -> DataFrame:
    """Chapters first, then books. A book's count is that of the first chapter with the entity plus one for
    each later chapter; ``true_mentions`` counts every mention."""
    chapters = merge_raw(mentions, ["book_id", "chapter_index"]).drop("name_key")
    return chapters.groupBy("book_id", F.lower("name").alias("name_key"), "entity_type").agg(
        F.min_by("name", "ord").alias("name"), _union(F.col("aliases")).alias("aliases"), _longest(F.col("context"), F.col("ord")).alias("context"),
        (F.min_by("occurrence_count", "ord") + F.count("*") - 1).cast("int").alias("occurrence_count"),
        F.sum("occurrence_count").cast("long").alias("true_mentions"), F.min("ord").alias("ord"),
    )


def alias_map(groups: DataFrame) -> DataFrame:
    """``groups`` (entity_type, pos, canonical_name, aliases) to (entity_type, alias_key, canonical);
    where groups claim one name, the last of them has it."""
    names = F.explode(F.array_distinct(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.expr("cast(array() as array<string>)")))))
    return groups.select("entity_type", "pos", "canonical_name", names.alias("alias")).groupBy("entity_type", F.lower("alias").alias("alias_key")).agg(F.max_by("canonical_name", "pos").alias("canonical"))


def canonical_names(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """``entities`` with ``canonical``: the group's name or their own."""
    known = aliases.select(F.col("entity_type").alias("a_type"), "alias_key", F.col("canonical").alias("a_name"))
    met = entities.join(known, (F.col("entity_type") == F.col("a_type")) & (F.lower("name") == F.col("alias_key")), "left")
    return met.withColumn("canonical", F.coalesce("a_name", "name")).drop("a_type", "alias_key", "a_name")


def merge_by_aliases(entities: DataFrame, aliases: DataFrame, by: list[str] = ["book_id"]) -> DataFrame:  # noqa: B006
    """Resolved entities: all names (sorted), contexts and chapters in order of first appearance, and the
    sum of occurrences. ``entities``: ``by``, name, aliases, entity_type, context, chapter_title, ord,
    occurrence_count."""
    ordered = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col(c).alias("x")))), lambda s: s["x"]))
    out = canonical_names(entities, aliases).groupBy(*by, F.lower("canonical").alias("canonical_key"), "entity_type").agg(
        F.min_by("canonical", "ord").alias("canonical_name"), F.array_sort(F.array_distinct(F.concat(F.collect_set("canonical"), F.collect_set("name"), F.flatten(F.collect_list("aliases"))))).alias("all_names"),
        ordered("context").alias("contexts"), ordered("chapter_title").alias("source_chapters"), F.sum("occurrence_count").cast("long").alias("total_occurrences"),
    )
    return out.withColumn("contexts", F.filter("contexts", lambda x: x != "")).drop("canonical_key")


def names_by_type(entities: DataFrame) -> DataFrame:
    """entity_type, name: distinct names and aliases."""
    every = F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.expr("cast(array() as array<string>)"))))
    return entities.select("entity_type", every.alias("name")).where("name <> ''").distinct()


def unresolved(names: DataFrame, groups: DataFrame) -> DataFrame:
    """Names in no group; letters' case counts."""
    claimed = groups.select(F.col("entity_type").alias("g_type"), F.explode(F.concat(F.array("canonical_name"), "aliases")).alias("g_name")).distinct()
    return names.join(claimed, (F.col("entity_type") == F.col("g_type")) & (F.col("name") == F.col("g_name")), "left_anti")


def by_source_priority(facts: DataFrame, key: str, fields: list[str], lists: list[str] = []) -> DataFrame:  # noqa: B006
    """Records of one entity from sources of different rank (``priority``, 1 first): each field is the
    best-ranked source's that isn't null; lists are united."""
    best = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("priority"))).alias(f) for f in fields]
    return facts.groupBy(key).agg(*best, *[_union(F.col(x)).alias(x) for x in lists])


