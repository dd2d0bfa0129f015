"""Linking names to a curated list, and the two priority rules that use it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.similarity import near_texts
from loregraph.functions.text import SPACE, normalize_name

# Fixed value: beginnings of file names that are no entities. The fifth only meets names that begin with it.
NOISE = r"(?i)^(?:a_|the_|an_|\d+_|_level_\d+|crawler_\d+|level_\d+|group_of_|pair_of_|two_|three_)"


def is_noise(name: Column) -> Column:
    return name.rlike(NOISE)


def best_match(names: DataFrame, wiki: DataFrame, threshold: int = T.FUZZY, partial: bool = True) -> DataFrame:
    """``names`` (entity_type, name, key) with ``wiki_match`` and ``match_score``: an equal key of the same
    type, else the best at or above the threshold; ties go to the smaller. ``wiki``: entity_type,
    wiki_name, wiki_key. Keys without an equal one are compared with all of their type."""
    keys = names.select("entity_type", "key").where("key is not null").distinct()
    w = wiki.select(F.col("entity_type").alias("w_type"), "wiki_name", "wiki_key").where("wiki_key is not null").distinct()
    same = keys.join(w, (F.col("entity_type") == F.col("w_type")) & (F.col("key") == F.col("wiki_key"))).groupBy("entity_type", "key").agg(F.min("wiki_name").alias("wiki_match")).withColumn("match_score", F.lit(100.0))
    rest = keys.join(same, ["entity_type", "key"], "left_anti")
    listed = w.select(F.col("w_type").alias("entity_type"), F.col("wiki_key").alias("key")).distinct()
    near = near_texts(rest, listed, "entity_type", threshold, partial).select(F.col("entity_type").alias("m_type"), "a", "b", F.col("score").alias("s"))
    fuzzy = near.join(w, (F.col("m_type") == F.col("w_type")) & (F.col("b") == F.col("wiki_key"))).groupBy(F.col("m_type").alias("entity_type"), F.col("a").alias("key")).agg(
        F.min_by("wiki_name", F.struct(-F.col("s"), F.col("wiki_name"))).alias("wiki_match"), F.max("s").alias("match_score"))
    return names.join(same.unionByName(fuzzy), ["entity_type", "key"], "left")


def classify_priority(entities: DataFrame, wiki: DataFrame, threshold: int = T.FUZZY) -> DataFrame:
    """``entities`` (entity_key, entity_type, name, aliases, occurrence_count) with priority (canonical,
    major, minor), is_wiki_linked and wiki_entry_name: the first of name and aliases, in order, that
    matches decides; without one the count does."""
    every = F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.expr("cast(array() as array<string>)"))))
    tried = entities.select("entity_key", "entity_type", every.alias("pos", "name")).withColumn("key", F.lower("name"))
    lists = wiki.withColumn("wiki_key", F.lower("wiki_name"))
    hits = best_match(tried, lists, threshold).where("wiki_match is not null").groupBy("entity_key").agg(F.min_by("wiki_match", "pos").alias("wiki_entry_name"))
    out = entities.join(hits, "entity_key", "left")
    linked = F.col("wiki_entry_name").isNotNull()
    return out.withColumn("priority", F.when(linked, "canonical").when(F.col("occurrence_count") >= T.MAJOR_COUNT, "major").otherwise("minor")).withColumn("is_wiki_linked", linked)


def priority_counts(entities: DataFrame) -> DataFrame:
    """entity_type, canonical, major, minor, total; the row with null type holds the grand totals."""
    count = lambda p: F.count_if(F.col("priority") == p).alias(p)
    return entities.rollup("entity_type").agg(count("canonical"), count("major"), count("minor"), F.count("*").alias("total"))


def quality_score(name: Column, description: Column, content: Column) -> Column:
    """0 to 100 from the name's form and the lengths of description and content."""
    steps = lambda n, table: F.coalesce(*[F.when(n > limit, points) for limit, points in table], F.lit(0))
    form = F.when(name.rlike(r"^\p{Lu}"), 15).otherwise(0) + steps(F.length(name), [(10, 10), (5, 5)]) + F.when(is_noise(name), 0).otherwise(5)
    return (form + steps(F.length(description), [(500, 40), (200, 30), (100, 20), (50, 10)]) + steps(F.length(content), [(1000, 30), (500, 20), (200, 10)])).cast("int")


def classify_cleanup(files: DataFrame, wiki: DataFrame, threshold: int = T.CLEANUP_FUZZY) -> DataFrame:
    """``files`` (name, entity_type, description, content) with wiki_match, quality_score and priority
    (canonical, major, minor, noise). Types are those of the files: events are 'timeline'."""
    keyed = files.withColumn("key", normalize_name(F.col("name")))
    matched = best_match(keyed, wiki.withColumn("wiki_key", normalize_name(F.col("wiki_name"))), threshold, partial=False)
    linked, score = F.col("wiki_match").isNotNull(), quality_score(F.col("name"), F.col("description"), F.col("content"))
    scored = matched.withColumn("noise_name", is_noise(F.col("name"))).withColumn("quality_score", F.when(linked, 100).otherwise(score))
    tier = F.when(linked, "canonical").when(F.col("noise_name"), "noise").when(F.col("quality_score") >= T.SCORE_MAJOR, "major").when(F.col("quality_score") >= T.SCORE_MINOR, "minor").otherwise("noise")
    return scored.withColumn("priority", tier).drop("key", "noise_name", "match_score")


def cleanup_stats(classified: DataFrame) -> DataFrame:
    count = lambda p: F.count_if(F.col("priority") == p).alias(p)
    return classified.agg(F.count("*").alias("total"), count("canonical"), count("major"), count("minor"), count("noise"))


def noise_sample(classified: DataFrame, n: int = 20) -> DataFrame:
    return classified.where("priority = 'noise'").orderBy("quality_score", "name").limit(n)


def markdown_parts(files: DataFrame) -> DataFrame:
    """``files`` (path, content) with ``description``: the first three lines that aren't blank, a heading
    or between rules. Every line '---' opens or closes front matter, in the body too."""
    lines = F.transform(F.split("content", "\n"), lambda x: F.regexp_replace(x, rf"^{SPACE}+|{SPACE}+$", ""))
    fold = F.aggregate(
        lines, F.struct(F.lit(False).alias("inside"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda a, x: F.when(x == "---", F.struct((~a["inside"]).alias("inside"), a["out"].alias("out")))
        .when(a["inside"] | (x == "") | x.startswith("#") | (F.size(a["out"]) >= 3), a)
        .otherwise(F.struct(a["inside"].alias("inside"), F.array_append(a["out"], x).alias("out"))),
        lambda a: F.array_join(a["out"], " "),
    )
    return files.withColumn("description", fold)
