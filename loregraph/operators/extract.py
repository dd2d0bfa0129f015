"""Entity extraction through a pluggable extractor; each distinct chunk is asked for once."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loregraph import types as T
from loregraph.functions.text import content_hash, idempotency_key, recovered_json
from loregraph.operators.state import misses

#: Fixed value: a name is a word that begins with a capital and goes on in at least two small letters.
NAME = "^[A-Z][a-z]{2,}$"


class Extractor(Protocol):
    """From chunks (key, text) to raw answers (key, response)."""

    name: str

    def answers(self, chunks: DataFrame) -> DataFrame: ...


class Capitalized:
    """The offline default, deterministic and native: capitalised ASCII words; ``gazetteer`` (name_key,
    entity_type) types them, the rest are characters."""

    name = "capitalized"

    def __init__(self, gazetteer: DataFrame | None = None):
        self.gazetteer = gazetteer

    def answers(self, chunks: DataFrame) -> DataFrame:
        named = chunks.select("key", F.posexplode(capitalized(F.col("text"))).alias("pos", "name"))
        if self.gazetteer is None:
            typed = named.withColumn("entity_type", F.lit("character"))
        else:
            g = self.gazetteer.select(F.col("name_key").alias("g"), F.col("entity_type").alias("g_type"))
            typed = named.join(g, F.lower("name") == F.col("g"), "left").withColumn("entity_type", F.coalesce("g_type", F.lit("character")))
        listed = typed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "entity_type"))).alias("found"))
        entities = F.transform(F.coalesce("found", F.expr("cast(array() as array<struct<pos:int,name:string,entity_type:string>>)")), lambda x: F.struct(x["name"].alias("name"), x["entity_type"].alias("entity_type"), F.expr("cast(array() as array<string>)").alias("aliases"), F.lit("").alias("context")))
        return chunks.select("key").join(listed, "key", "left").select("key", F.to_json(F.struct(entities.alias("entities"))).alias("response"))


#: A row a text that a model was asked for; ``response`` is null where every try failed.
ASKED = "key string, response string, model string, prompt string, prompt_tokens int, completion_tokens int, duration_ms double, attempts int, success boolean"


class HttpModel:
    """A model server that answers POST {model, prompt, system, stream, options} with {response}, and counts
    of tokens where it gives them. A client lives in each partition; failures are retried and then left
    without an answer, so the work is asked for again on the next run."""

    # Options that make answers repeat as far as the server can.
    OPTIONS = {"temperature": 0.0, "seed": 42, "num_predict": 4096}

    def __init__(self, url: str, model: str, system: str = "", timeout: float = 300, retries: int = T.MAX_RETRIES, options: dict | None = None):
        self.url, self.name, self.system, self.timeout, self.retries = url, model, system, timeout, retries
        self.options = dict(self.OPTIONS if options is None else options)

    def asked(self, texts: DataFrame) -> DataFrame:
        """``texts`` (key, text) to ``ASKED``; materialise it before use, so that nothing is asked twice."""
        url, model, system, timeout, retries, options = self.url, self.name, self.system, self.timeout, self.retries, self.options
        estimate = lambda text: len(text) // 4

        def ask(prompt: str) -> tuple:
            body = json.dumps({"model": model, "prompt": prompt, "system": system, "stream": False, "options": options}).encode()
            began = time.monotonic()
            for attempt in range(1, retries + 1):
                try:
                    with urllib.request.urlopen(urllib.request.Request(url, body, {"Content-Type": "application/json"}), timeout=timeout) as r:
                        answer = json.loads(r.read())
                    text = answer["response"]
                    counts = answer.get("prompt_eval_count") or estimate(prompt + system), answer.get("eval_count") or estimate(text)
                    return text, model, prompt, *counts, (time.monotonic() - began) * 1000, attempt, True
                except (OSError, ValueError, KeyError, TypeError):
                    continue
            return None, model, prompt, estimate(prompt + system), 0, (time.monotonic() - began) * 1000, retries, False

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            columns = [c.split()[0] for c in ASKED.split(", ")]
            for pdf in batches:
                yield pd.DataFrame([(k, *ask(t)) for k, t in zip(pdf["key"], pdf["text"], strict=True)], columns=columns).astype({c: "int32" for c in ("prompt_tokens", "completion_tokens", "attempts")})

        return texts.select("key", "text").mapInPandas(run, ASKED)

    def answers(self, chunks: DataFrame) -> DataFrame:
        return self.asked(chunks).where("response is not null")

    def versions(self) -> dict[str, str]:
        """Models of the server with the beginning of their digests; none where the server doesn't say."""
        parts = urllib.parse.urlsplit(self.url)
        try:
            with urllib.request.urlopen(f"{parts.scheme}://{parts.netloc}/api/tags", timeout=10) as r:
                return {m["name"]: m.get("digest", "")[:12] for m in json.loads(r.read())["models"]}
        except (OSError, ValueError, KeyError, TypeError):
            return {}


def calls(asked: DataFrame, trace_id: str) -> DataFrame:
    """Rows of the event table of calls from answers that say how they came about."""
    return asked.select(F.lit(trace_id).alias("trace_id"), "model", "prompt", "response", "prompt_tokens", "completion_tokens", "duration_ms", "success")


def capitalized(text: Column) -> Column:
    return F.filter(F.split(text, "[^A-Za-z]+"), lambda x: x.rlike(NAME))


def keyed(chunks: DataFrame, operation: str = "ner") -> DataFrame:
    """Chunks with the key of their content: equal chunks of a book share one answer."""
    return chunks.withColumn("content_hash", content_hash(F.col("text"), 16)).withColumn("key", idempotency_key(F.col("book_id"), F.lit(""), F.lit(""), F.lit(operation), F.col("content_hash")))


def extract(chunks: DataFrame, extractor: Extractor, cache: DataFrame | None = None) -> DataFrame:
    """New answers (key, response) for keyed chunks that ``cache`` doesn't hold; write them before use,
    so that nothing is asked twice when Spark recomputes."""
    work = chunks.select("key", "text").dropDuplicates(["key"])
    return extractor.answers(work if cache is None else misses(work, cache))


def mentions(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Mentions of keyed chunks from raw answers, in chunk order; see ``types.MENTIONS``. Answers that
    hold no object, and entities without name or known type, give nothing."""
    item = "array<struct<name:string,entity_type:string,aliases:array<string>,context:string>>"
    parsed = answers.withColumn("entities", F.try_variant_get(recovered_json(F.col("response")), "$.entities", item))
    rows = chunks.join(parsed.select("key", "entities"), "key").select("book_id", "chapter_index", "chapter_title", "chunk_id", "chunk_idx", F.posexplode("entities").alias("pos", "e"))
    # Places compare as chapter, chunk and entity: 24, 20 and 19 bits, and what doesn't fit ends the run.
    fits = (F.col("chapter_index") < 1 << 24) & (F.col("chunk_idx") < 1 << 20) & (F.col("pos") < 1 << 19)
    place = F.shiftleft(F.col("chapter_index").cast("long"), 39) + F.shiftleft(F.col("chunk_idx").cast("long"), 19) + F.col("pos")
    ord_ = F.when(fits, place).otherwise(F.raise_error(F.lit("a mention's place doesn't fit a long")).cast("long"))
    none = F.expr("cast(array() as array<string>)")
    flat = rows.select("book_id", "chapter_index", "chapter_title", "chunk_id", ord_.alias("ord"), F.col("e.name").alias("name"), F.coalesce("e.aliases", none).alias("aliases"), F.lower("e.entity_type").alias("entity_type"), F.coalesce("e.context", F.lit("")).alias("context"))
    return flat.where(F.col("entity_type").isin(list(T.BY_NAME)) & (F.coalesce("name", F.lit("")) != ""))
