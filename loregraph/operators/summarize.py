"""Describing resolved entities: prompts, typed fields from answers, output objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.text import content_hash, entity_id, recovered_json, valid_entity_id
from loregraph.storage import table


def prompt(name: Column, entity_type: Column, aliases: Column, contexts: Column) -> Column:
    """Aliases comma-joined or 'None'; contexts as list items with blank lines between, the first 50."""
    shown = F.filter(F.slice(contexts, 1, T.MAX_CONTEXTS), lambda x: x != "")
    fields = F.create_map(*[F.lit(x) for t in T.TYPES for x in (t.name, ", ".join(t.details))])
    listed = F.when(F.size(shown) == 0, "No context available.").otherwise(F.array_join(F.transform(shown, lambda x: F.concat(F.lit("- "), x)), "\n\n"))
    also = F.when(F.size(aliases) == 0, "None").otherwise(F.array_join(aliases, ", "))
    return F.concat(F.lit("Describe the "), entity_type, F.lit(" "), name, F.lit(".\nAlso known as: "), also, F.lit("\nFields: "), F.coalesce(F.try_element_at(fields, entity_type), F.lit("")), F.lit("\nText:\n"), listed)


def prompts(resolved: DataFrame) -> DataFrame:
    """``resolved`` with aliases (names other than the canonical) and prompt; types that aren't known have no
    description and leave."""
    known = resolved.where(F.col("entity_type").isin(list(T.BY_NAME)))
    return known.withColumn("aliases", F.array_remove("all_names", F.col("canonical_name"))).withColumn("prompt", prompt(F.col("canonical_name"), F.col("entity_type"), F.col("aliases"), F.col("contexts")))


def ask(resolved: DataFrame, model) -> DataFrame:
    """``answers`` of ``entities`` from a model (``answers``: key, text to key, response); entities with equal
    prompts are asked for once, and the answers are written before use."""
    asked = prompts(resolved).select("book_id", "canonical_name", "entity_type", F.col("prompt").alias("text")).withColumn("key", content_hash(F.concat_ws(":", F.lit("summary"), "text"), 16))
    answered = table(model.answers(asked.select("key", "text").dropDuplicates(["key"])))
    return asked.join(answered.select("key", "response"), "key").select("book_id", "canonical_name", "entity_type", "response")


def entities(resolved: DataFrame, answers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities, and those whose id isn't valid, set apart. ``answers``: book_id, canonical_name,
    entity_type, response. Without a readable answer an entity has no description and empty fields."""
    base = prompts(resolved).drop("prompt")
    if answers is None:
        described = base.withColumn("v", F.try_parse_json(F.lit(None).cast("string")))
    else:
        described = base.join(answers, ["book_id", "canonical_name", "entity_type"], "left").withColumn("v", recovered_json(F.col("response"))).drop("response")
    names = list(dict.fromkeys(d for t in T.TYPES for d in t.details))
    own = {d: F.col("entity_type").isin([t.name for t in T.TYPES if d in t.details]) for d in names}
    fields = {d: F.when(own[d], F.try_variant_get("v", f"$.{d}", "string") if d in T.SCALAR else F.coalesce(F.try_variant_get("v", f"$.{d}", "array<string>"), F.expr("cast(array() as array<string>)"))) for d in names}
    out = described.select(
        "book_id", entity_id(F.col("canonical_name"), F.col("entity_type")).alias("entity_id"), F.col("canonical_name").alias("name"), "entity_type", "aliases",
        F.try_element_at("source_chapters", F.lit(1)).alias("first_appearance"), F.col("total_occurrences").alias("occurrence_count"),
        F.array(F.struct(F.lit("book").alias("source_type"), F.col("book_id").alias("source_id"), F.try_element_at("contexts", F.lit(1)).alias("context"))).alias("sources"),
        F.try_variant_get("v", "$.description", "string").alias("canonical_description"), F.current_date().alias("last_updated"), *[c.alias(n) for n, c in fields.items()],
    )
    good = valid_entity_id(F.col("entity_id"))
    return out.where(good), out.where(~good)


def output_json(entities_: DataFrame) -> DataFrame:
    """``entities_`` with ``json``: seven common keys, null or not, then the type's fields that aren't empty."""
    common = F.to_json(F.struct("entity_id", "entity_type", "name", "aliases", F.col("canonical_description").alias("description"), "first_appearance", "occurrence_count"), {"ignoreNullFields": "false"})
    names = [d for d in dict.fromkeys(d for t in T.TYPES for d in t.details) if d in entities_.columns]
    filled = [F.when(F.col(d) != "", F.col(d)).alias(d) if d in T.SCALAR else F.when(F.size(d) > 0, F.col(d)).alias(d) for d in names]
    more = F.to_json(F.struct(*filled)) if filled else F.lit("{}")
    return entities_.withColumn("json", F.when(more == "{}", common).otherwise(F.concat(common.substr(F.lit(1), F.length(common) - 1), F.lit(","), more.substr(F.lit(2), F.length(more)))))
