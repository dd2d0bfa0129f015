"""Counters, histograms, gauges, timers, errors, spans and progress over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.text import preview
from loregraph.storage import table

METRICS = "run_id string, kind string, name string, value double, ts timestamp"
SPANS = "trace_id string, span_id string, parent_id string, name string, start double, end double, status string, error string, attributes map<string,string>"
DECISIONS = "trace_id string, decision_id string, category string, options array<string>, chosen string, reason string, constraints array<string>, confidence double, metadata map<string,string>"
LLM_CALLS = "trace_id string, model string, prompt string, response string, prompt_tokens int, completion_tokens int, duration_ms double, success boolean"


def counters(metrics: DataFrame, by: list[str] = ["name"]) -> DataFrame:  # noqa: B006
    return metrics.groupBy(*by).agg(F.sum("value").alias("total"))


def gauges(metrics: DataFrame, by: list[str] = ["name"], at: str = "ts") -> DataFrame:  # noqa: B006
    """The last value; of values at one time the largest."""
    return metrics.groupBy(*by).agg(F.max_by("value", F.struct(at, "value")).alias("value"))


def histogram(metrics: DataFrame, by: list[str] = ["name"]) -> DataFrame:  # noqa: B006
    """count, min, max, mean, p50, p95, sum. Percentiles are the values at place floor(n q) of the order,
    found by counting equal values first: a name's rows never meet in one array."""
    values = metrics.groupBy(*by, "value").agg(F.count("*").alias("c"))
    upto = Window.partitionBy(*by).orderBy("value")
    ranked = values.withColumn("after", F.sum("c").over(upto)).join(values.groupBy(*by).agg(F.sum("c").alias("n")), by)
    at = lambda q: F.when(F.col("n") == 1, F.lit(0)).otherwise(F.floor(F.col("n") * q))
    return ranked.groupBy(*by).agg(
        F.first("n").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), (F.sum(F.col("value") * F.col("c")) / F.first("n")).alias("mean"),
        F.min(F.when(F.col("after") > at(0.5), F.col("value"))).alias("p50"), F.min(F.when(F.col("after") > at(0.95), F.col("value"))).alias("p95"),
        F.sum(F.col("value") * F.col("c")).alias("sum"),
    )


def errors(rows: DataFrame, by: list[str] = ["stage"]) -> DataFrame:  # noqa: B006
    return rows.groupBy(*by).agg(F.count("*").alias("errors"), F.count_if("fatal").alias("fatal"))


def timers(marks: DataFrame, by: list[str] = ["run_id", "name"]) -> DataFrame:  # noqa: B006
    """``marks`` (…, action start or stop, seconds) to duration_ms: a stop pairs with the start right
    before it; starts without a stop and stops without a start are left out."""
    order = Window.partitionBy(*by).orderBy("seconds")
    paired = marks.withColumn("_a", F.lag("action").over(order)).withColumn("_s", F.lag("seconds").over(order))
    return paired.where("action = 'stop' and _a = 'start'").select(*by, ((F.col("seconds") - F.col("_s")) * 1000).alias("duration_ms"))


def run_summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row a run with the total of each named counter, as whole numbers."""
    return metrics.where(F.col("name").isin(names)).groupBy("run_id").pivot("name", names).agg(F.sum("value").cast("long")).na.fill(0)


def duration_ms(start: Column, end: Column) -> Column:
    return F.when(end.isNull(), F.lit(0.0)).otherwise((end - start) * 1000)


def span_stats(spans: DataFrame) -> DataFrame:
    d = duration_ms(F.col("start"), F.col("end"))
    return spans.groupBy("name").agg(F.count("*").alias("spans"), F.count_if(F.col("status") == "error").alias("errors"), F.sum(d).alias("total_ms"), F.max(d).alias("max_ms"))


def span_depth(spans: DataFrame) -> DataFrame:
    """span_id, depth: 0 for spans without a parent in the table. What a span knows of its ancestors doubles
    each round, until none has an ancestor left: one join for each doubling of the deepest chain. Spans on a
    circle of parents have no depth: null."""
    ids = spans.select(F.col("span_id").alias("p"))
    known = table(
        spans.select("span_id", "parent_id").join(ids, F.col("parent_id") == F.col("p"), "left")
        .select("span_id", F.col("p").alias("up"), F.when(F.col("p").isNull(), 0).otherwise(1).alias("depth"))
    )
    open_ = known.where("up is not null").count()
    rounds, most = 0, max(1, open_).bit_length() + 1
    while open_ and rounds < most:
        above = known.select(F.col("span_id").alias("u"), F.col("up").alias("u_up"), F.col("depth").alias("u_depth"))
        known = table(known.join(above, F.col("up") == F.col("u"), "left").select("span_id", F.col("u_up").alias("up"), (F.col("depth") + F.coalesce("u_depth", F.lit(0))).alias("depth")))
        open_ = known.where("up is not null").limit(1).count()
        rounds += 1
    # A chain of n spans ends within log2(n) rounds; what is open then is a circle.
    return known.select("span_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def call_previews(calls: DataFrame) -> DataFrame:
    """Calls with the first characters of prompt and response and their lengths; the tables keep both whole."""
    return calls.select("*", preview(F.col("prompt")).alias("prompt_preview"), preview(F.col("response")).alias("response_preview"), F.length("prompt").alias("prompt_length"), F.length("response").alias("response_length"))


def percentage(current: Column, total: Column, complete: Column | None = None) -> Column:
    """0 without a total; at most 95 until complete."""
    raw = current.cast("double") / total * 100
    done = current >= total if complete is None else complete
    return F.when(total == 0, F.lit(0.0)).when(~done & (raw > T.PROGRESS_CAP), F.lit(float(T.PROGRESS_CAP))).otherwise(raw)


def clamp(current: Column, total: Column) -> Column:
    return F.when((total > 0) & (current > total), total).otherwise(current)


def progress(rows: DataFrame) -> DataFrame:
    """``rows`` (…, current, total) with current held to total, percentage and overflow."""
    over = (F.col("total") > 0) & (F.col("current") > F.col("total"))
    return rows.withColumn("overflow", over).withColumn("current", clamp(F.col("current"), F.col("total"))).withColumn("percentage", percentage(F.col("current"), F.col("total")))


def silent_gaps(rows: DataFrame, by: list[str] = ["run_id"], at: str = "ts", seconds: int = T.SILENT_SECONDS) -> DataFrame:  # noqa: B006
    """Events more than ``seconds`` after the one before, with the gap."""
    order = Window.partitionBy(*by).orderBy(at)
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(order).cast("timestamp"))
    return rows.withColumn("gap_seconds", gap / 1_000_000).where(F.col("gap_seconds") > seconds)


def warnings(rows: DataFrame) -> DataFrame:
    """Both kinds of progress warnings: kind, run_id, stage, ts."""
    over = rows.where("total > 0 and current > total").select(F.lit("overflow").alias("kind"), "run_id", "stage", "ts")
    return over.unionByName(silent_gaps(rows).select(F.lit("silent").alias("kind"), "run_id", "stage", "ts"))
