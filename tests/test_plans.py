from __future__ import annotations

import json
import re
import zipfile

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from loregraph import cli, sinks
from loregraph.operators import extract, graph, merge, state, telemetry
from loregraph.plans.books import Run, build_graph
from loregraph.sources.books import read_epubs
from loregraph.sources.corpus import read_corpus, read_wiki
from loregraph.streaming import feeds


def epub(path, title, author, chapters):
    items = "".join(f'<item id="c{i}" href="c{i}.xhtml" media-type="application/xhtml+xml"/>' for i in range(len(chapters)))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="o/p.opf"/></rootfiles></container>')
        z.writestr("o/p.opf", f'<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata>{f"<dc:title>{title}</dc:title>" if title else ""}<dc:creator>{author}</dc:creator></metadata><manifest>{items}</manifest></package>')
        for i, c in enumerate(chapters):
            z.writestr(f"o/c{i}.xhtml", c)


CHAPTERS = ["<h1>One</h1><p>" + "Carl met Donut near the gate. " * 6 + "</p>", "<p>short</p>", "<p>" + "Donut and Carl saw Mordecai there. " * 6 + "</p>"]


def test_books_end_to_end(spark, tmp_path):
    epub(tmp_path / "a.EPUB", "Dungeon", "Author", CHAPTERS)
    (tmp_path / "bad.epub").write_bytes(b"no zip")
    books, chapters = read_epubs(spark, f"file://{tmp_path}")
    assert [(r["book_id"], r["chapters"]) for r in books.collect()] == [("dungeonauthor", 2)]
    assert sorted((r["chapter_index"], r["chapter_title"]) for r in chapters.collect()) == [(0, "One"), (1, "Chapter 2")]
    told = []
    run = Run(listeners=[lambda s, m: told.append(s), lambda s, m: 1 / 0])
    g = build_graph(chapters, size=80, overlap=10, run=run)
    assert told[0] == "chunking"
    assert told[-1] == "complete"
    assert {"char_carl", "char_donut", "char_mordecai"} <= {r["entity_id"] for r in g.entities.collect()}
    edges = {(r["source"], r["target"]): r["weight"] for r in g.edges.collect()}
    assert edges["character:carl", "character:donut"] >= 2
    assert all(a < b for a, b in edges)
    out = sinks.result_json(books, g.entities, g.edges, books.select("book_id", F.lit(1).alias("calls"))).first()["json"]
    assert set(json.loads(out)) == {"metadata", "entities", "connections", "telemetry"}
    run.interrupted = True
    with pytest.raises(InterruptedError):
        run.tell("x", "y")


def test_extractor_is_asked_once_per_content(spark):
    chunks = extract.keyed(spark.createDataFrame([("b", 0, "t", "chapter_0:chunk_0", 0, "Carl went."), ("b", 1, "u", "chapter_1:chunk_0", 0, "Carl went.")], "book_id string, chapter_index int, chapter_title string, chunk_id string, chunk_idx int, text string"))
    answers = extract.extract(chunks, extract.Capitalized())
    assert answers.count() == 1
    assert extract.extract(chunks, extract.Capitalized(), answers.select("key", F.col("response").alias("result"))).count() == 0
    assert extract.mentions(chunks, answers).count() == 2
    odd = chunks.select("key").distinct().withColumn("response", F.lit('{"entities":[{"name":"A","entity_type":"Dragon"},{"name":"B","entity_type":"LOCATION","aliases":null},{"entity_type":"location"}]}'))
    assert [(r["name"], r["aliases"]) for r in extract.mentions(chunks.limit(1), odd).collect()] == [("B", [])]


def test_two_level_count(spark):
    rows = [("b", c, f"c{c}", f"{c}:0", c * 10 + i, "Carl", [f"x{i}"], "character", "ctx" * (i + 1)) for c, n in ((0, 3), (1, 4), (2, 1)) for i in range(n)]
    from loregraph.types import MENTIONS

    r = merge.merge_two_level(spark.createDataFrame(rows, MENTIONS)).first()
    assert (r["occurrence_count"], r["true_mentions"]) == (5, 8)


def test_connections_limit_and_order(spark):
    index = spark.createDataFrame([("a", "chapter_2:0"), ("a", "chapter_2:0"), ("b", "chapter_2:0"), ("a", "chapter_10:0"), ("b", "chapter_10:0"), ("c", "x")], "entity string, chunk string")
    assert [(r["source"], r["target"], r["weight"], r["co_occurrence_chapters"]) for r in graph.connections(index, 2, chapters=True).collect()] == [("a", "b", 2, ["chapter_10", "chapter_2"])]
    assert graph.connections(index, 3).count() == 0


def test_components(spark):
    import random

    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    expected = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = {r["v"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == expected


def test_state(spark):
    cache = spark.createDataFrame([("k", 1, "a", "m", "p"), ("k", 2, "b", "m", "p"), ("e", 1, "[]", None, "p")], "key string, completed_at int, result string, model_name string, prompt_hash string")
    assert {(r["key"], r["result"]) for r in state.latest(cache, "key", "completed_at").collect()} == {("k", "b"), ("e", "[]")}
    work = spark.createDataFrame([("k",), ("e",), ("n",)], "key string")
    assert {r["key"] for r in state.misses(work, cache).collect()} == {"n"}
    assert {r["key"] for r in state.misses(work, cache, recompute_empty=True).collect()} == {"n", "e"}
    assert state.changed_results(cache).count() == 1
    assert state.invalidate_model(cache, "m").count() == 1


@pytest.mark.parametrize("n,p50,p95", [(1, 0, 0), (2, 1, 1), (3, 1, 2), (20, 10, 19), (100, 50, 95)])
def test_histogram(spark, n, p50, p95):
    r = telemetry.histogram(spark.createDataFrame([("x", float(i)) for i in range(n)], "name string, value double")).first()
    assert (r["count"], r["p50"], r["p95"]) == (n, p50, p95)


def test_progress(spark):
    df = spark.createDataFrame([(0, 0), (96, 100), (100, 100), (7, 5)], "current int, total int")
    assert [(r["current"], r["percentage"], r["overflow"]) for r in telemetry.progress(df).collect()] == [(0, 0.0, False), (95 + 1, 95.0, False), (100, 100.0, False), (5, 100.0, True)]


def test_corpus_and_cli(spark, tmp_path, capsys):
    folder = tmp_path / "characters"
    folder.mkdir()
    (folder / "Carl.md").write_text("---\nname: Carl\n---\n# Carl\n\nA man.\nWith a cat.\n")
    (folder / "a_dog.md").write_text("---\nname: a_dog\n---\nA dog.\n")
    (folder / "_index.md").write_text("x")
    (tmp_path / "w.json").write_text(json.dumps({"characters": [{"name": "Carl", "description": "d"}, "Donut"], "timeline_events": [{"event": "Fall"}]}))
    files = read_corpus(spark, f"file://{tmp_path}")
    assert {(r["name"], r["description"]) for r in files.collect()} == {("Carl", "A man. With a cat."), ("a_dog", "A dog.")}
    assert {(r["entity_type"], r["wiki_name"]) for r in read_wiki(spark, f"file://{tmp_path}/w.json").collect()} == {("character", "Carl"), ("character", "Donut"), ("timeline_event", "Fall")}
    wiki = ["--wiki", f"file://{tmp_path}/w.json", "--corpus", str(tmp_path)]
    assert cli.main(["clean", *wiki, "--execute"]) == 0
    assert [p.name for p in (tmp_path / "archive").rglob("*.md")] == ["a_dog.md"]
    assert sorted(p.name for p in folder.glob("*.md")) == ["Carl.md", "_index.md"]
    assert cli.main(["clean", *wiki, "--execute", "--quiet"]) == 0
    assert len(list((tmp_path / "archive").rglob("*.md"))) == 1
    assert cli.main(["classify", *wiki, "--execute", "--quiet"]) == 0
    assert "priority: canonical" in (folder / "Carl.md").read_text()
    assert cli.main(["clean", "--wiki", f"file://{tmp_path}/none.json", "--corpus", str(tmp_path)]) == 1


def test_ingest_takes_content_once(spark, tmp_path):
    schema = "book_id string, title string, author string, file_path string, content string"
    src = tmp_path / "in"
    for i, (book, content) in enumerate([("a", "x"), ("b", "x"), ("c", "y"), ("d", "x")]):
        spark.createDataFrame([(book, "t", "a", "f", content)], schema).coalesce(1).write.mode("append").parquet(str(src))
        if i % 2:
            q = feeds.ingest(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "reg"), str(tmp_path / "out"), str(tmp_path / "cp"))
            q.awaitTermination()
    assert sorted(r["book_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "c"]
    assert sinks.load_or_empty(spark, str(tmp_path / "reg"), state.REGISTRY).count() == 2


def test_replaced_tables_and_lost_state(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    schema = "k string, n int"
    for n in range(3):
        old = sinks.load_or_empty(spark, path, schema)
        sinks.replace_table(old.unionByName(spark.createDataFrame([("a", n)], schema)), path)
    assert sorted(r["n"] for r in sinks.load_or_empty(spark, path, schema).collect()) == [0, 1, 2]
    assert len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("version-")]) == 1
    for part in (tmp_path / "t").rglob("*.parquet"):
        part.write_bytes(b"not a table")
    for crc in (tmp_path / "t").rglob(".*.crc"):
        crc.unlink()
    assert sinks.load_or_empty(spark, path, schema).count() == 0
    assert sinks.load_or_empty(spark, f"file://{tmp_path}/none", schema).count() == 0


def test_span_depth_of_a_long_chain(spark):
    chain = [(f"s{i}", f"s{i - 1}" if i else None) for i in range(200)] + [("x", "y"), ("y", "x"), ("o", "gone")]
    got = {r["span_id"]: r["depth"] for r in telemetry.span_depth(spark.createDataFrame(chain, "span_id string, parent_id string")).collect()}
    assert got == {**{f"s{i}": i for i in range(200)}, "x": None, "y": None, "o": 0}


def test_chapters_of_strong_edges(spark):
    import itertools
    import random

    rng = random.Random(2)
    rows = {(f"e{rng.randrange(12)}", f"chapter_{rng.randrange(9)}:{rng.randrange(3)}") for _ in range(150)}
    chunks = {}
    for e, c in rows:
        chunks.setdefault(c, []).append(e)
    edges = {}
    for c, es in chunks.items():
        for a, b in itertools.combinations(sorted(es), 2):
            edges.setdefault((a, b), []).append(c)
    index = spark.createDataFrame(sorted(rows), "entity string, chunk string")
    for least in (1, 2, 3):
        expected = sorted((a, b, len(cs), sorted({c.split(":")[0] for c in cs})) for (a, b), cs in edges.items() if len(cs) >= least)
        assert sorted(map(tuple, graph.connections(index, least, chapters=True).collect())) == expected


def test_model_groups_in_order(spark):
    """Of two groups that claim a name the last one has it; fuzzy groups come before all."""
    from loregraph.operators import resolve

    rows = [("b", n, [], "character", "", "ch", i, 1) for i, n in enumerate(["Carl", "Karl", "Donut"])]
    entities = spark.createDataFrame(rows, "book_id string, name string, aliases array<string>, entity_type string, context string, chapter_title string, ord long, occurrence_count int")
    groups = [("character", "Carl", ["Donut"], 0.9, 0), ("character", "Princess", ["donut"], 0.9, 1)]
    for order, canonical in ((groups, "Princess"), ([(*g[:4], 1 - g[4]) for g in groups], "Carl")):
        out, log = resolve.resolve(entities, spark.createDataFrame(order, resolve.GROUPS + ", pos int"))
        names = {n: r["canonical_name"] for r in out.collect() for n in r["all_names"]}
        assert names["Donut"] == canonical
        assert [(r["method"], r["names"]) for r in log.collect()] == [("llm", 3)]


def test_whole_plan_of_the_table(spark):
    """Entities of all conversations against a plain program: mentions, counts, greedy groups, ids."""
    from test_text import greedy_brute

    from loregraph import queries

    seen = {}  # (book, name) to [first place, count in the first chapter, later chapters]
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").collect()
    for r in sorted(turns, key=lambda r: (r["conv_id"], r["turn"])):
        names = [w for w in re.split("[^A-Za-z]+", r["text"]) if re.fullmatch("[A-Z][a-z]{2,}", w)]
        for name in dict.fromkeys(names):
            place = (r["turn"], names.index(name))
            if (r["conv_id"], name) in seen:
                seen[r["conv_id"], name][2] += 1
            else:
                seen[r["conv_id"], name] = [place, names.count(name), 0]
    canonical = {x: c for c, group in greedy_brute({n for _, n in seen}, 85) for x in group}
    expected = {}
    for (book, name), (place, first, later) in seen.items():
        e = expected.setdefault((f"conv{book}", canonical[name]), [place, 0])
        e[0], e[1] = min(e[0], place), e[1] + first + later
    rows = [(b, f"char_{n.lower()[:30]}", n, "character", f"turn {p[0]}", count) for (b, n), (p, count) in expected.items()]
    got = queries.queries()["book_entities"](spark, DATA).select("book_id", "entity_id", "name", "entity_type", "first_appearance", "occurrence_count")
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_graph_writes_mentions_once(spark):
    """Tables that several others come from are written, not computed again."""
    chapters = spark.createDataFrame([("b", 0, "t", "Carl met Donut. Carl left.")], "book_id string, chapter_index int, chapter_title string, content string")
    g = build_graph(chapters)
    assert g.mentions.folder and g.mentions.count() == 3


def test_priority_files_reads_the_folder_once(spark, monkeypatch):
    from loregraph import queries
    from loregraph.storage import drop

    roots, made = [], queries._folder_of_files
    monkeypatch.setattr(queries, "_folder_of_files", lambda *a: roots.append(made(*a)) or roots[-1])
    got = queries.queries()["priority_files"](spark, DATA)
    drop(spark, roots[0])
    assert got.count() == spark.read.parquet(f"{DATA}/supplier.parquet").count()
