"""Mixing sources to target word counts by entropy balancing.

Each source has a target number of words. Among all document rates that meet it, those closest to 1
in entropy, and at most ``cap``, are ``min(cap, exp(lam * x))`` with ``x`` the document's size over the
source's size-weighted mean size; ``lam`` is the dual variable of the source's constraint. The dual is
convex with one variable a source, and Newton steps find all of them at once: each step is one
aggregate over a table of distinct (source, size), never over documents, and a bracket around the root
keeps steps safe. Rates become copies by systematic rounding along (source, size, hash): cumulative
rates in integers of 2**-20, so the result doesn't depend on partitioning; of 64 starts of the rounding
each source takes the one that meets its target best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import checkpoint, named, ranked, table, text_key, words

#: Fixed-point unit of a rate.
UNIT = 1 << 20
#: Largest relative miss of a target before rounding, and Newton steps at most.
TOLERANCE, STEPS = 1e-7, 60
#: Starts of systematic rounding that are tried for each source.
STARTS = 64


def _key(source: Column) -> Column:
    """Orders sources by code point with null last; null isn't the text 'null'."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``sources`` (key, source_size) with ``target``: shares by repeating weights, capped, excess reshared.

    The shared rate is the largest of (total - caps before) / (weights left) along rising cap a weight.
    One row a source goes through the windows, a table of names and not of documents.
    """
    every, by_key = Window.partitionBy(), Window.orderBy("key")
    before = Window.orderBy("ceiling", "key").rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(by_key) - 1, F.lit(len(weights))) + 1).cast("int"))
    return (
        sources.withColumn("w", w.cast("double")).withColumn("top", F.col("source_size").cast("double") * cap)
        .withColumn("ceiling", F.col("top") / F.col("w"))
        .withColumn("rate", (F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
        .select("key", "source_size", F.least(F.col("w") * F.max("rate").over(every), F.col("top")).alias("target"), "top")
    )


def _rate(cap: int) -> Column:
    """Rate of a document; sources at their cap take everything ``cap`` times."""
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.lit(50.0), F.col("lam") * F.col("size") / F.col("mean")))))


def solve(sizes: DataFrame, goals: DataFrame, cap: int = 3) -> DataFrame:
    """Newton steps on the dual: ``sizes`` (key, size, n), ``goals`` (key, source_size, target, top) to
    (key, source_size, target, mean, full, lam). Sums are decimals, so their order doesn't matter."""
    exact = lambda x: F.sum(x.cast("decimal(38,6)")).cast("double")
    moments = sizes.groupBy("key").agg(F.sum(F.col("size").cast("decimal(38,0)") * F.col("size") * F.col("n")).cast("double").alias("square"))
    state = checkpoint(
        goals.join(moments, "key", "left").select(
            "key", "source_size", "target", F.coalesce(F.col("square") / F.col("source_size"), F.lit(1.0)).alias("mean"),
            (F.col("target") >= F.col("top") * (1 - 1e-12)).alias("full"), F.lit(0.0).alias("lam"),
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"),
        )
    )
    for _ in range(STEPS):
        mass = F.col("n") * F.col("size") * F.col("rate")
        sums = (
            sizes.join(state.where("not full and not done"), "key").withColumn("rate", _rate(cap))
            .groupBy("key").agg(exact(mass).alias("value"), exact(F.when(F.col("rate") < cap, mass * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        )
        low = F.when(F.col("value") < F.col("target"), F.col("lam")).otherwise(F.col("low"))
        high = F.when(F.col("value") >= F.col("target"), F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") + (F.col("target") - F.col("value")) / F.col("slope")
        # Without a bound on one side the step at most triples; within bounds it bisects when Newton leaves them.
        reach = 2 * F.greatest(F.lit(1.0), F.abs("lam"))
        step = (
            F.when((F.col("slope") > 0) & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high)), F.greatest(F.col("lam") - reach, F.least(F.col("lam") + reach, newton)))
            .when(low.isNotNull() & high.isNotNull(), (low + high) / 2)
            .when(low.isNotNull(), F.col("lam") + reach).otherwise(F.col("lam") - reach)
        )
        done = F.col("done") | F.col("full") | F.col("value").isNull() | (F.abs(F.col("value") - F.col("target")) <= TOLERANCE * F.greatest(F.lit(1.0), F.col("target")))
        state = checkpoint(
            state.join(sums, "key", "left").withColumn("ends", done)
            .select("key", "source_size", "target", "mean", "full", F.when(F.col("ends"), F.col("lam")).otherwise(step).alias("lam"), low.alias("low"), high.alias("high"), F.col("ends").alias("done"))
        )
        if not state.where("not done").limit(1).count():
            break
    return state


def _plan(docs: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """doc_id, key, text_key, size, source_size, target, copies: one row per row of ``docs``."""
    spark = docs.sparkSession
    base = checkpoint(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("source")).alias("key"), text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("size"))
        # Rows that agree in all this may come in any order; the last number keeps them from one range.
        .withColumn("tie", F.monotonically_increasing_id())
    )
    sizes = checkpoint(base.groupBy("key", "size").agg(F.count("*").alias("n")))
    goals = targets(sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap)
    state = solve(sizes.where("size > 0"), checkpoint(goals), cap)

    # Written, so the planner knows its size, and documents aren't dealt by source to meet a row a source.
    rates = table(state.select(F.col("key").alias("of"), "source_size", "target", "mean", "full", "lam"))
    rated = base.join(rates, F.col("key") == F.col("of")).select(
        "doc_id", "key", "text_key", "size", "source_size", "target", "tie",
        F.floor(_rate(cap) * UNIT).cast("long").alias("units"), F.xxhash64("doc_id", "text_key").alias("h"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["size", "h", "doc_id", "text_key", "tie"]
    dealt = checkpoint(rated.repartitionByRange(parts, "key", *order).withColumn("part", F.spark_partition_id()))
    # Cumulative rates: a sum for each part and source, their prefix, and a running sum within.
    sums = dealt.groupBy("part", "key").agg(F.sum("units").alias("s"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("part").alias("p"), F.col("key").alias("k"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("start"))
    so_far = Window.partitionBy("part", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("start") + F.col("inner")
    placed = checkpoint(
        dealt.join(starts, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k")))
        .withColumn("inner", F.sum("units").over(so_far))
        .select("doc_id", "key", "text_key", "size", "source_size", "target", "units", upto.alias("upto"))
    )
    # Rounding may start anywhere in a unit: each source takes the start that meets its target best.
    copies = lambda at: F.shiftright(F.col("upto") + at, 20) - F.shiftright(F.col("upto") - F.col("units") + at, 20)
    missed = F.array(*[F.abs(F.sum(F.col("size") * copies(F.lit(j * (UNIT // STARTS)))) - F.first("target")) for j in range(STARTS)])
    best = table(placed.groupBy(F.col("key").alias("of")).agg(missed.alias("missed")).select("of", ((F.array_position("missed", F.array_min("missed")) - 1) * (UNIT // STARTS)).alias("at")))
    return placed.join(best, F.col("key") == F.col("of")).select("doc_id", "key", "text_key", "size", "source_size", "target", copies(F.col("at")).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """How often a mix takes each document.

    ``docs``: doc_id, text, source; other columns are ignored. Returns one row per row of ``docs``:
    doc_id, size (words), source_size, target (words of its source), taken (words, repeats counted),
    copies (0 to ``cap``).

    Null or empty text has size 0 and takes no words. Null source is a source of its own, the last.
    Null doc_id and repeated rows are documents like others. An empty table gives an empty result.
    Sources of size 0 get target 0. Reruns agree.
    """
    return _plan(docs, weights, cap).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with all its columns, whatever their
    names. ``docs`` and odd rows: as for ``mix``.

    A row takes the copies planned for its doc_id, source and text. Rows that agree in all three (repeated
    rows, null ids) share the copies of all of them evenly, so targets hold for them too; which of them has
    one more depends on how the table is split, if they differ in other columns.
    """
    rows_of = _plan(docs, weights, cap).groupBy("doc_id", "key", "text_key").agg(F.sum("copies").alias("all"), F.count("*").alias("n"))
    plan = table(rows_of.where("all > 0").select(F.col("doc_id").alias("p_id"), F.col("key").alias("p_source"), F.col("text_key").alias("p_key"), "all", "n"))
    rows = named(docs, text_key(F.col("text"))).withColumn("source", _key(F.col("row")["source"]))
    same = F.col("id").eqNullSafe(F.col("p_id")) & (F.col("source") == F.col("p_source")) & (F.col("key") == F.col("p_key"))
    out = rows.join(plan.where("n = 1"), same).select("row", F.col("all").alias("copies"))
    if plan.where("n > 1").limit(1).count():
        many = ranked(rows.join(plan.where("n > 1"), same).select("row", "id", "source", "key", "all", "n"), ["id", "source", "key"], [F.to_json("row")])
        share = F.floor(F.col("all") / F.col("n")) + F.when(F.col("rank") < F.col("all") % F.col("n"), 1).otherwise(0)
        out = out.union(many.select("row", share.alias("copies")).where("copies > 0"))
    return out.select("row", F.explode(F.expr("sequence(1, cast(copies as int))")).alias("copy")).select("row.*")
