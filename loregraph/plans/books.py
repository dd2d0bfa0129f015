"""From chapters to an entity graph, and the two jobs that keep a corpus."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.chunking import explode_chunks
from loregraph.observe import Recorder
from loregraph.operators import extract, graph, merge, resolve, summarize, wiki
from loregraph.operators.extract import Capitalized, Extractor
from loregraph.operators.state import chapters_left
from loregraph.sinks import append_events, load_or_empty
from loregraph.storage import checkpoint, drop, table


@dataclass
class Run:
    """Callbacks and switches of a run; listeners that fail don't stop it. What a recorder is given, it keeps."""

    listeners: list[Callable[[str, str], None]] = field(default_factory=list)
    approve: Callable[[str, str], bool] | None = None
    interrupted: bool = False
    recorder: Recorder | None = None

    def tell(self, stage: str, message: str, current: int = 0, total: int = 0) -> None:
        if self.interrupted:
            raise InterruptedError(f"stopped before {stage}")
        if self.recorder:
            self.recorder.progress(stage, current, total, message)
        for f in list(self.listeners):
            try:
                f(stage, message)
            except Exception:  # noqa: BLE001, S112
                continue

    def gate(self, stage: str, description: str) -> None:
        """Batch runs, and runs where nobody is asked, go on; a refusal ends the run before the stage."""
        asked = self.approve is not None
        allowed = not asked or self.approve(stage, description)
        if self.recorder and asked:
            self.recorder.decision("approval", ["go on", "stop"], "go on" if allowed else "stop", description, stage=stage)
        if not allowed:
            raise PermissionError(f"{stage} wasn't approved")

    def step(self, name: str):
        return self.recorder.span(name) if self.recorder else nullcontext()


#: Chapters that are extracted between two commits.
BATCH = 100_000
COMMITS = "book_id string, chapter_index int, batch string"


def committed_mentions(spark: SparkSession, store: str) -> DataFrame:
    """Mentions of all chapters that are committed in ``store``; what a run left without a commit isn't read."""
    done = load_or_empty(spark, f"{store}/chapters", COMMITS)
    batches = [r["batch"] for r in done.select("batch").distinct().collect()]  # a name for each BATCH chapters
    if not batches:
        return spark.createDataFrame([], T.MENTIONS)
    return spark.read.schema(T.MENTIONS).parquet(*[f"{store}/mentions/{b}" for b in batches])


def extract_chapters(chapters: DataFrame, extractor: Extractor, store: str, cache: DataFrame | None = None, size: int = T.CHUNK_SIZE, overlap: int = T.CHUNK_OVERLAP, run: Run | None = None, batch: int = BATCH) -> DataFrame:
    """Mentions of ``chapters``, those of earlier runs in ``store`` included. Batches of chapters are extracted,
    written and then committed, so a run that was stopped goes on after its last commit with nothing lost."""
    run, spark = run or Run(), chapters.sparkSession
    left = table(chapters_left(chapters, load_or_empty(spark, f"{store}/chapters", COMMITS)))
    parts = -(-left.count() // batch)
    for i in range(parts):
        run.tell("extraction", f"batch {i + 1} of {parts}", i, parts)
        part = left.where(F.pmod(F.xxhash64("book_id", "chapter_index"), F.lit(parts)) == i)
        chunks = extract.keyed(explode_chunks(part, size, overlap))
        answers = table(extract.extract(chunks, extractor, cache).select("key", "response"))
        known = answers if cache is None else answers.unionByName(cache.select("key", F.col("result").alias("response")))
        name = uuid.uuid4().hex
        extract.mentions(chunks, known).write.parquet(f"{store}/mentions/{name}")
        append_events(part.select("book_id", F.col("chapter_index").cast("int").alias("chapter_index"), F.lit(name).alias("batch")), f"{store}/chapters")
    return committed_mentions(spark, store)


def clear_store(spark: SparkSession, store: str) -> None:
    """Forget what is committed, as after a run that ended."""
    drop(spark, store)


@dataclass
class Graph:
    chunks: DataFrame
    answers: DataFrame
    mentions: DataFrame
    entities: DataFrame
    rejected: DataFrame
    decisions: DataFrame
    edges: DataFrame


def build_graph(chapters: DataFrame, extractor: Extractor | None = None, cache: DataFrame | None = None, model_groups: DataFrame | None = None, descriptions: DataFrame | None = None, size: int = T.CHUNK_SIZE, overlap: int = T.CHUNK_OVERLAP, min_weight: int = 2, by_entity: bool = False, run: Run | None = None, store: str | None = None, grouper=None, describer=None) -> Graph:  # noqa: E501
    """All tables of a run over ``chapters`` (book_id, chapter_index, chapter_title, content). Answers are
    checkpointed before use: an extractor isn't asked again when Spark recomputes. Mentions and merged names are written
    once, as several tables come from each. With ``store`` chapters are
    committed as they are done, and a later run takes up what is left. ``grouper`` and ``describer`` are models
    that are asked for alias groups and descriptions where ``model_groups`` and ``descriptions`` aren't given.
    Edges join mention keys; with ``by_entity`` resolved entities."""
    run = run or Run()
    extractor = extractor or Capitalized()
    run.tell("chunking", f"chunks of {size} with {overlap} shared")
    chunks = extract.keyed(explode_chunks(chapters, size, overlap))
    run.gate("extraction", f"ask {extractor.name} for the entities of all chunks that have no answer")
    run.tell("extraction", "asking for entities")
    with run.step("extraction"):
        if store is not None:
            mentions = extract_chapters(chapters, extractor, store, cache, size, overlap, run)
            answers = chapters.sparkSession.createDataFrame([], "key string, response string")
        else:
            answers = checkpoint(extract.extract(chunks, extractor, cache))
            if run.recorder and run.recorder.trace_id and "prompt_tokens" in answers.columns:
                seen = answers.agg(F.count("*").alias("n"), F.sum("prompt_tokens").alias("p"), F.sum("completion_tokens").alias("c")).first()
                for name, value in (("llm_calls", seen["n"]), ("prompt_tokens", seen["p"]), ("completion_tokens", seen["c"])):
                    run.recorder.increment(name, value or 0)
            known = answers.select("key", "response")
            known = known if cache is None else known.unionByName(cache.select("key", F.col("result").alias("response")))
            mentions = table(extract.mentions(chunks, known))
    run.tell("resolution", "merging names")
    raw = merge.merge_two_level(mentions)
    firsts = mentions.groupBy("book_id", F.lower("name").alias("name_key"), "entity_type").agg(F.min_by("chapter_title", "ord").alias("chapter_title"))
    named = table(raw.join(firsts, ["book_id", "name_key", "entity_type"]))
    with run.step("resolution"):
        if model_groups is None and grouper is not None:
            run.gate("resolution", f"ask {grouper.name} which names mean the same")
            model_groups = resolve.ask_groups(named, grouper)
        resolved, decisions = resolve.resolve(named, model_groups)
    run.tell("description", "describing entities")
    with run.step("description"):
        if descriptions is None and describer is not None:
            run.gate("description", f"ask {describer.name} to describe all entities")
            descriptions = summarize.ask(resolved, describer)
        good, bad = summarize.entities(resolved, descriptions)
    run.tell("connection", "counting shared chunks")
    index = mentions.select("book_id", F.concat_ws(":", "entity_type", F.lower("name")).alias("entity"), F.col("chunk_id").alias("chunk")).distinct()
    if by_entity:
        ids = good.select("book_id", "entity_id", "entity_type", F.explode(F.concat(F.array("name"), "aliases")).alias("n")).select("book_id", F.concat_ws(":", "entity_type", F.lower("n")).alias("entity"), "entity_id").dropDuplicates(["book_id", "entity"])
        index = index.join(ids, ["book_id", "entity"], "left").select("book_id", F.coalesce("entity_id", "entity").alias("entity"), "chunk").distinct()
    edges = graph.connections(index, min_weight, ["book_id"], chapters=True)
    run.tell("complete", "done")
    return Graph(chunks, answers, mentions, good, bad, decisions, edges)


def classify_corpus(files: DataFrame, wiki_entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Priorities of corpus files by the wiki, and their counts. ``files``: as ``sources.corpus`` reads."""
    fm = lambda k: F.try_element_at("front_matter", F.lit(k))
    entities = files.select(
        F.col("path").alias("entity_key"), "path", "content", "entity_type", F.coalesce(fm("name"), "name").alias("name"),
        F.filter(F.split(F.coalesce(fm("aliases"), F.lit("")), r",\s*"), lambda x: x != "").alias("aliases"), F.coalesce(F.expr("try_cast(try_element_at(front_matter, 'occurrence_count') as int)"), F.lit(0)).alias("occurrence_count"),
    )
    classified = wiki.classify_priority(entities, wiki_entries)
    return classified, wiki.priority_counts(classified)


def clean_corpus(files: DataFrame, wiki_entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tiers of corpus files by wiki, name and quality, and their counts; ``wiki_entries`` with labels."""
    labels = F.when(F.col("entity_type") == "timeline_event", "timeline").otherwise(F.col("entity_type"))
    classified = wiki.classify_cleanup(files.withColumn("entity_type", labels), wiki_entries)
    return classified, wiki.cleanup_stats(classified)
