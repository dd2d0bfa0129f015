"""Alias resolution: groups from a model where there are any, fuzzy groups for the rest."""

from __future__ import annotations

import heapq
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.similarity import near_texts, sorted_tokens
from loregraph.functions.text import content_hash, recovered_json
from loregraph.operators import merge
from loregraph.operators.graph import components
from loregraph.storage import table

GROUPS = "entity_type string, canonical_name string, aliases array<string>, confidence double"
#: Candidates that a seed looks at, itself included.
POOL = 10


#: Names that one call groups, about; components are never cut.
CALL = 20_000


def greedy(names: list[tuple[str, str]], near: dict[str, list[tuple[str, float]]]) -> list[tuple[str, list[str], float]]:
    """Stars in ascending order of ``names`` (name, sorted words): a name not yet used takes its best matches among
    the unused; the longest of them is canonical, the seed winning ties. ``near``: other words with their score;
    names of the same words score 100."""
    left: dict[str, dict[str, None]] = {}
    for name, words in (names := sorted(names)):
        left.setdefault(words, {})[name] = None
    out = []
    for seed, words in names:
        if seed not in left[words]:
            continue
        del left[words][seed]
        found = heapq.nsmallest(POOL - 1, ((-s, x, w) for w, s in [(words, 100.0), *near.get(words, [])] for x in islice(left[w], POOL - 1)))
        group = [seed, *(x for _, x, _ in found)]
        canonical = max(group, key=len)
        out.append((canonical, [x for x in group if x != canonical], min([-s for s, _, _ in found], default=100.0) / 100))
        for _, x, w in found:
            del left[w][x]
    return out


def fuzzy_groups(names: DataFrame, threshold: int = T.FUZZY) -> DataFrame:
    """``names`` (entity_type, name) to alias groups. Groups are stars around seeds, not closures. Seeds
    of different components of similar names never meet, so each component is grouped on its own. Names of the
    same words are compared as one text, and aren't paired with each other."""
    node = lambda c: F.concat_ws("\x01", "entity_type", c)
    every = table(names.select("entity_type", "name").where("name is not null").distinct().withColumn("words", sorted_tokens(F.col("name"))))
    pairs = table(near_texts(every.select("entity_type", F.col("words").alias("key")), None, "entity_type", threshold).withColumn("v", node("a")))
    roots = components(pairs.select(F.col("v").alias("a"), node("b").alias("b")))
    rooted = table(every.withColumn("v", node("words")).join(roots, "v", "left").withColumn("root", F.coalesce("root", "v")).drop("v"))
    shared = rooted.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select(F.col("root").alias("s_root"))
    linked = rooted.join(shared, F.col("root") == F.col("s_root"), "left_semi")
    calls = max(1, -(-rooted.count() // CALL))
    dealt = lambda df, *more: df.withColumn("call", F.pmod(F.xxhash64("root"), F.lit(calls))).select("call", "root", *more)

    def group(members: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        near: dict[str, dict[str, list[tuple[str, float]]]] = {}
        for root, a, b, s in zip(links["root"], links["a"], links["b"], links["score"], strict=True):
            of = near.setdefault(root, {})
            of.setdefault(a, []).append((b, s))
            of.setdefault(b, []).append((a, s))
        out = [(part["entity_type"].iloc[0], *g) for root, part in members.groupby("root") for g in greedy(list(zip(part["name"], part["words"], strict=True)), near.get(root, {}))]
        return pd.DataFrame(out, columns=["entity_type", "canonical_name", "aliases", "confidence"])

    links = pairs.join(roots, "v")
    stars = dealt(linked, "entity_type", "name", "words").groupBy("call").cogroup(dealt(links, "a", "b", "score").groupBy("call")).applyInPandas(group, GROUPS)
    alone = rooted.join(shared, F.col("root") == F.col("s_root"), "left_anti").select("entity_type", F.col("name").alias("canonical_name"), F.expr("cast(array() as array<string>)").alias("aliases"), F.lit(1.0).alias("confidence"))
    return stars.unionByName(alone)


#: Names that a model is shown at once, and the confidence of a group that comes without one.
SHOWN, CONFIDENCE = 500, 0.9


def group_prompts(names: DataFrame, shown: int = SHOWN) -> DataFrame:
    """``names`` (entity_type, name) to entity_type, block, key, text: prompts with about ``shown`` names. Names
    with the same last word are in one prompt; a single name isn't asked for."""
    last = F.lower(F.element_at(F.split(F.trim("name"), " +"), -1))
    counts = names.groupBy("entity_type").agg(F.count("*").alias("n")).where("n > 1")
    dealt = names.join(counts, "entity_type").withColumn("block", F.pmod(F.xxhash64(last), F.ceil(F.col("n") / shown)).cast("int"))
    listed = dealt.groupBy("entity_type", "block").agg(F.array_sort(F.collect_list("name")).alias("names")).where(F.size("names") > 1)
    text = F.concat(
        F.lit('Which of these names mean the same '), F.col("entity_type"), F.lit('? Answer with JSON: {"groups": [{"canonical_name": "...", "aliases": ["..."], "confidence": 0.0 to 1.0}]}. Names:\n'),
        F.array_join(F.transform("names", lambda x: F.concat(F.lit("- "), x)), "\n"),
    )
    return listed.select("entity_type", "block", text.alias("text")).withColumn("key", content_hash(F.concat_ws(":", F.lit("alias"), "text"), 16))


def groups_from(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """``answers`` (key, response) of ``group_prompts`` as ``GROUPS`` with ``pos``. Groups without a canonical
    name, and answers that hold no object, give nothing; other lists in an answer don't count."""
    item = "array<struct<canonical_name:string,aliases:array<string>,confidence:double>>"
    parsed = prompts.join(answers.select("key", "response"), "key").select("entity_type", "block", F.try_variant_get(recovered_json(F.col("response")), "$.groups", item).alias("groups"))
    rows = parsed.select("entity_type", "block", F.posexplode("groups").alias("place", "g")).where("coalesce(g.canonical_name, '') <> ''")
    aliases = F.filter(F.coalesce("g.aliases", F.expr("cast(array() as array<string>)")), lambda x: x.isNotNull())
    return rows.select("entity_type", F.col("g.canonical_name").alias("canonical_name"), aliases.alias("aliases"), F.coalesce("g.confidence", F.lit(CONFIDENCE)).alias("confidence"), (F.col("block") * 100_000 + F.col("place")).cast("long").alias("pos"))


def ask_groups(entities: DataFrame, model) -> DataFrame:
    """Alias groups of all names from a model (``answers``: key, text to key, response). The answers are written
    before use, so nothing is asked twice."""
    prompts = table(group_prompts(merge.names_by_type(entities)))
    return groups_from(prompts, table(model.answers(prompts.select("key", "text"))))


def resolve(entities: DataFrame, model_groups: DataFrame | None = None, threshold: int = T.FUZZY, by: list[str] = ["book_id"]) -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """Resolved entities, and the decision log: per type the method that grouped its names.
    ``model_groups``: ``GROUPS``, and ``pos`` where the order in which the model listed them is known."""
    names = merge.names_by_type(entities)
    if model_groups is None:
        model_groups = entities.sparkSession.createDataFrame([], GROUPS)
    left = merge.unresolved(names, model_groups)
    # Where two model groups claim a name the last has it: in the order of ``pos``, else of canonical names.
    numbered = model_groups if "pos" in model_groups.columns else model_groups.withColumn("pos", F.lit(0))
    numbered = numbered.select("entity_type", "canonical_name", "aliases", "confidence", F.struct(F.col("pos").cast("long").alias("pos"), F.col("canonical_name").alias("tie")).alias("pos"))
    own = fuzzy_groups(left, threshold).withColumn("pos", F.struct(F.lit(-1).cast("long").alias("pos"), F.col("canonical_name").alias("tie")))
    groups = numbered.unionByName(own)
    counts = names.groupBy("entity_type").agg(F.count("*").alias("names")).join(model_groups.groupBy("entity_type").agg(F.count("*").alias("n")), "entity_type", "left")
    method = F.when(F.col("n") > 0, "llm").when(F.col("names") <= 1, "none").otherwise("fuzzy")
    return merge.merge_by_aliases(entities, merge.alias_map(groups), by), counts.select("entity_type", "names", method.alias("method"))
