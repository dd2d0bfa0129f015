"""Models that are asked over HTTP, recorded runs, and runs that go on where they stopped."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from loregraph import observe
from loregraph.operators import extract, resolve, state, summarize, telemetry
from loregraph.operators.extract import HttpModel
from loregraph.plans import books
from loregraph.plans.books import Run, build_graph
from loregraph.sources import corpus

CHAPTERS = [("b", i, f"ch {i}", text) for i, text in enumerate(["Carl met Donut. Carl ran.", "Donut saw Mordecai.", "Princess Donut and Carl."])]
CHAPTER = "book_id string, chapter_index int, chapter_title string, content string"


@pytest.fixture(scope="module")
def server():
    """Entities from capital letters; groups and descriptions as asked; the first try of a text with FLAKY fails."""
    seen: list[str] = []

    class Handler(BaseHTTPRequestHandler):
        def _send(self, body: dict, code: int = 200):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            self._send({"models": [{"name": "m", "digest": "0123456789abcdef"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            prompt = asked["prompt"]
            seen.append(prompt)
            if "BROKEN" in prompt or "FLAKY" in prompt and seen.count(prompt) < 2:
                return self._send({}, 500)
            if prompt.startswith("Which of these"):
                text = 'Sure:\n```json\n{"groups": [{"canonical_name": "Princess Donut", "aliases": ["Donut"]}, {"aliases": ["Carl"]}], "unresolved": ["Carl"]}\n```'
            elif prompt.startswith("Describe the"):
                text = json.dumps({"description": "Of " + prompt.split(".")[0], "role": "hero", "abilities": ["runs"]})
            else:
                names = dict.fromkeys(w.strip(".") for w in prompt.split() if w[0].isupper())
                text = json.dumps({"entities": [{"name": n, "entity_type": "character", "context": prompt} for n in names]})
            return self._send({"response": text, "prompt_eval_count": 7, "eval_count": 3})

        def log_message(self, *_):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}/api/generate", seen
    http.shutdown()


def test_model_calls(spark, server):
    url, _ = server
    model = HttpModel(url, "m", timeout=5)
    texts = spark.createDataFrame([("a", "Carl."), ("b", "FLAKY Donut"), ("c", "BROKEN")], "key string, text string").coalesce(1)
    asked = {r["key"]: r for r in model.asked(texts).collect()}
    assert [(asked[k]["attempts"], asked[k]["success"]) for k in "abc"] == [(1, True), (2, True), (3, False)]
    assert (asked["a"]["prompt_tokens"], asked["a"]["completion_tokens"]) == (7, 3)
    assert asked["c"]["response"] is None
    assert {r["key"] for r in model.answers(texts).collect()} == {"a", "b"}
    calls = telemetry.call_previews(extract.calls(model.asked(texts), "t")).collect()
    assert {(r["prompt_preview"], r["prompt_length"], r["trace_id"]) for r in calls} == {("Carl.", 5, "t"), ("FLAKY Donut", 11, "t"), ("BROKEN", 6, "t")}
    assert model.versions() == {"m": "0123456789ab"}
    assert HttpModel("http://127.0.0.1:9/x", "m", timeout=1).versions() == {}


def test_whole_run_that_asks(spark, server, tmp_path):
    url, seen = server
    model = HttpModel(url, "m", timeout=5)
    recorder = observe.Recorder()
    trace = recorder.start_trace(book="b")
    recorder.model_version(*next(iter(model.versions().items())))
    approved = []
    run = Run(approve=lambda stage, _: approved.append(stage) or True, recorder=recorder)
    seen.clear()
    g = build_graph(spark.createDataFrame(CHAPTERS, CHAPTER), extractor=model, grouper=model, describer=model, run=run)
    entities = {r["name"]: r for r in g.entities.collect()}
    assert "Donut" in entities["Princess Donut"]["aliases"]
    assert entities["Carl"]["canonical_description"] == "Of Describe the character Carl"
    assert (entities["Carl"]["role"], entities["Carl"]["abilities"]) == ("hero", ["runs"])
    assert approved == ["extraction", "resolution", "description"]
    assert len([p for p in seen if not p.startswith(("Which", "Describe"))]) == 3
    recorder.end_trace()
    recorder.save(spark, str(tmp_path))
    back = observe.load_trace(spark, str(tmp_path), trace)
    assert {r["name"] for r in back["spans"].collect()} == {"extraction", "resolution", "description"}
    assert {r["name"]: r["total"] for r in telemetry.counters(back["metrics"]).collect()} == {"llm_calls": 3.0, "prompt_tokens": 21.0, "completion_tokens": 9.0}
    summary = telemetry.run_summary(back["metrics"], ["llm_calls", "prompt_tokens", "chapters"]).first()
    assert (summary["run_id"], summary["llm_calls"], summary["prompt_tokens"], summary["chapters"]) == (trace, 3, 21, 0)
    assert [(r["model"], r["digest"]) for r in back["model_versions"].collect()] == [("m", "0123456789ab")]
    assert back["decisions"].count() == 3
    assert back["traces"].first()["metadata"] == {"book": "b"}
    with pytest.raises(PermissionError):
        build_graph(spark.createDataFrame(CHAPTERS, CHAPTER), extractor=model, run=Run(approve=lambda *_: False))


def test_groups_from_answers(spark):
    names = spark.createDataFrame([("character", n) for n in ("Harry Dresden", "Dresden", "Carl")] + [("location", "Chicago")], "entity_type string, name string")
    prompts = resolve.group_prompts(names)
    assert [r["entity_type"] for r in prompts.collect()] == ["character"]
    blocks = {r["text"] for r in resolve.group_prompts(names, shown=1).collect()}
    assert all("Harry Dresden" not in t or "- Dresden" in t for t in blocks)
    for text, n in (("nothing", 0), ("[1, 2]", 0), ('{"groups": [{"canonical_name": "Harry Dresden", "aliases": null}, {"canonical_name": ""}]}', 1)):
        got = resolve.groups_from(prompts, prompts.select("key", F.lit(text).alias("response"))).collect()
        assert [(r["canonical_name"], r["aliases"], r["confidence"]) for r in got] == [("Harry Dresden", [], 0.9)][:n]


def test_recorder():
    now = [0.0]
    r = observe.Recorder(clock=lambda: now[0])
    assert len(r.decision("c", ["a"], "a", "why")) == 8
    assert r.end_trace() is None
    trace = r.start_trace()
    with pytest.raises(ValueError, match="x"), r.span("outer", k=1) as outer:
        with r.span("inner"):
            now[0] = 2.0
        raise ValueError("x")
    inner, out = r.rows["spans"]
    assert (inner[2], inner[3], inner[6]) == (outer, "inner", "ok")
    assert (out[0], out[2], out[6], out[7], out[8]) == (trace, None, "error", "x", {"k": "1"})
    r.start_timer("t")
    now[0] = 2.5
    assert r.stop_timer("t") == 500.0
    assert r.stop_timer("t") == 0.0
    assert [m[2:4] for m in r.rows["metrics"]] == [("t_duration_ms", 500.0)]
    r.error("parse", "bad", fatal=True)
    assert r.rows["errors"][0][1:4] == ("parse", "bad", True)


def test_a_run_goes_on_after_its_last_commit(spark, tmp_path):
    many = [(b, i + 3 * k, t, f"{c} {k}") for k in range(5) for b, i, t, c in CHAPTERS]
    chapters, store = spark.createDataFrame(many, CHAPTER), f"file://{tmp_path}/store"
    asked = []

    class Counting(extract.Capitalized):
        def answers(self, chunks):
            asked.append(chunks.count())
            if len(asked) == 2:
                raise RuntimeError("stopped")
            return super().answers(chunks)

    with pytest.raises(RuntimeError):
        books.extract_chapters(chapters, Counting(), store, batch=3)
    first = books.committed_mentions(spark, store)
    done = {r["chapter_index"] for r in first.collect()}
    assert 0 < len(done) < 15
    whole = books.extract_chapters(chapters, Counting(), store, batch=3)
    names = {0: ["Carl", "Carl", "Donut"], 1: ["Donut", "Mordecai"], 2: ["Carl", "Donut", "Princess"]}
    assert sorted((r["chapter_index"], r["name"]) for r in whole.collect()) == [(i, n) for i in range(15) for n in names[i % 3]]
    before = len(asked)
    g = build_graph(chapters, extractor=Counting(), store=store)
    assert len(asked) == before
    assert g.mentions.count() == 40
    books.clear_store(spark, store)
    assert books.committed_mentions(spark, store).count() == 0


def test_registry_and_progress(spark):
    rows = spark.createDataFrame([("b", "t", "a", "f", "h1", 3), ("c", "t", "a", "f", "h2", 4)], "book_id string, title string, author string, file_path string, content_hash string, chapters int")
    registry = state.book_records(rows)
    assert registry.columns == [c.split()[0] for c in state.REGISTRY.split(", ")]
    counted = state.update_counts(registry, spark.createDataFrame([("b", 9), ("x", 1)], "book_id string, n int"))
    assert {r["book_id"]: r["entities_extracted"] for r in counted.collect()} == {"b": 9, "c": 0}
    assert state.by_id(registry, "c").first()["content_hash"] == "h2"
    assert [r["book_id"] for r in state.by_hash(registry, spark.createDataFrame([("h1",), ("h1",)], "content_hash string")).collect()] == ["b"]
    done = spark.createDataFrame([(1, 4), (0, 0)], "d int, t int")
    assert [r["p"] for r in done.select(state.progress_percent(F.col("d"), F.col("t")).alias("p")).collect()] == [25.0, 0.0]
    events = spark.createDataFrame([("r", "s", 5, 3, 0), ("r", "s", 1, 3, 61), ("r", "s", 1, 3, 130)], "run_id string, stage string, current int, total int, s long").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r["kind"] for r in telemetry.warnings(events).collect()) == ["overflow", "silent", "silent"]


def test_first_contexts(spark):
    contexts = F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("c"), i.cast("string")))
    text = spark.range(1).select(summarize.prompt(F.lit("N"), F.lit("character"), F.array(F.lit("x")), contexts).alias("p")).first()["p"]
    assert text.count("\n- c") == 50
    assert "- c50" in text
    assert "- c51" not in text


def test_nested_front_matter():
    pytest.importorskip("yaml")
    assert corpus.front_matter_of("---\na: {b: [1, 2]}\nc:\n  - x\n  - y\nd: true\ne:\n---\n") == {"a": '{"b": [1, 2]}', "c": "x, y", "d": "true", "e": ""}
    assert corpus._flat("name: Carl\naliases: [a, 'b']\nmore:\n- c\n") == {"name": "Carl", "aliases": ["a", "b"], "more": ["c"]}
    assert corpus._flat("a:\n  b: 1\n") is None
