"""Queries over the driver's tables, one an operator, each with SQL where SQL can express it.

Both sides run over whole tables. Columns are cast so that types agree.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loregraph import sinks
from loregraph import types as T
from loregraph.functions import chunking, similarity, text
from loregraph.operators import extract, graph, merge, resolve, state, summarize, telemetry, wiki
from loregraph.plans import books
from loregraph.sources import corpus, html
from loregraph.storage import new_folder, table
from loregraph.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _long(*columns: str) -> dict[str, Column]:
    return {c: F.col(c).cast("long") for c in columns}


# --- graph: parts are entities, orders are chunks ------------------------------------------------------

_M = "m AS (SELECT DISTINCT l_partkey AS e, l_orderkey AS c FROM lineitem)"
_EDGES = "SELECT a.e AS source, b.e AS target, count(*) AS weight FROM m a JOIN m b ON a.c = b.c AND a.e < b.e GROUP BY 1, 2"


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("entity"), F.col("l_orderkey").alias("chunk"))


@query(f"WITH {_M} {_EDGES} HAVING count(*) >= 2")
def cooccurrence(spark, sf_dir):
    return graph.connections(_index(spark, sf_dir), 2)


@query(f"WITH {_M} {_EDGES} ORDER BY weight DESC, source, target LIMIT 100")
def cooccurrence_top(spark, sf_dir):
    return graph.strongest(graph.connections(_index(spark, sf_dir)), 100)


@query("""
WITH m AS (SELECT DISTINCT l_partkey AS e, strftime(o_orderdate, '%Y-%m') || ':' || l_orderkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT a.e AS source, b.e AS target, count(*) AS weight, array_to_string(list_sort(list(DISTINCT split_part(a.c, ':', 1))), ',') AS chapters
FROM m a JOIN m b ON a.c = b.c AND a.e < b.e GROUP BY 1, 2 HAVING count(*) >= 2
""")
def cooccurrence_chapters(spark, sf_dir):
    lines, orders = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders")
    chunk = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit(":"), F.col("l_orderkey").cast("string"))
    index = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").alias("entity"), chunk.alias("chunk"))
    return graph.connections(index, 2, chapters=True).select("source", "target", "weight", F.array_join("co_occurrence_chapters", ",").alias("chapters"))


# --- text ---------------------------------------------------------------------------------------------

_TEXT_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(nfc_normalize({t}), '[\t\r\f\x0B]+', ' ', 'g'), ' +', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"""


@query(r"""
WITH d AS (SELECT doc_id, nfc_normalize('  ' || text || 'e' || chr(769) || chr(9) || chr(13) || ' x' || chr(11) || chr(12) || '  y' || chr(10) || chr(10) || chr(10) || chr(10) || ' z  ') AS t FROM documents)
SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(t, '[\t\r\f\x0B]+', ' ', 'g'), ' +', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10))) AS h FROM d
""")
def normalize_text(spark, sf_dir):
    dirty = F.concat(F.lit("  "), F.col("text"), F.lit("é\t\r x\x0b\f  y\n\n\n\n z  "))
    return _t(spark, sf_dir, "documents").select("doc_id", text.content_hash(text.normalize_text(dirty)).alias("h"))


@query("SELECT doc_id, sha256(text) AS book_hash, left(sha256(text), 16) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("book_hash"), text.content_hash(F.col("text"), 16).alias("content_hash"))


@query("""
SELECT doc_id, left(sha256(source || ':' || doc_id || ':0:ner'), 16) AS by_place,
       left(sha256(source || ':ner:' || left(sha256(text), 16)), 16) AS by_content FROM documents
""")
def idempotency_key(spark, sf_dir):
    place = text.idempotency_key(F.col("source"), F.col("doc_id"), F.lit(0), F.lit("ner"))
    content = text.idempotency_key(F.col("source"), F.col("doc_id"), F.lit(0), F.lit("ner"), text.content_hash(F.col("text"), 16))
    return _t(spark, sf_dir, "documents").select("doc_id", place.alias("by_place"), content.alias("by_content"))


@query(r"SELECT p_partkey, trim(substr(regexp_replace(regexp_replace(lower(p_name || '_' || p_brand), '[^a-z0-9\s]', '', 'g'), '\s+', '_', 'g'), 1, 50), '_') AS book_id FROM part")
def book_slug(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", text.book_id(F.col("p_name"), F.col("p_brand")).alias("book_id"))


_TYPE_SQL = "CASE {k} % 5 WHEN 0 THEN 'character' WHEN 1 THEN 'location' WHEN 2 THEN 'faction' WHEN 3 THEN 'timeline_event' ELSE 'other' END"


def _type(key: Column) -> Column:
    names = F.array(*[F.lit(x) for x in ("character", "location", "faction", "timeline_event", "other")])
    return F.element_at(names, (F.pmod(key, F.lit(5)) + 1).cast("int"))


@query(r"""
WITH p AS (SELECT p_partkey, p_name, """ + _TYPE_SQL.format(k="p_partkey") + r""" AS t FROM part), i AS (
SELECT p_partkey, CASE t WHEN 'character' THEN 'char' WHEN 'location' THEN 'loc' WHEN 'faction' THEN 'fac' WHEN 'timeline_event' THEN 'evt' ELSE 'ent' END || '_' ||
  trim(substr(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9\s]', '', 'g'), '\s+', '_', 'g'), 1, 30), '_') AS entity_id FROM p)
SELECT p_partkey, entity_id, regexp_matches(entity_id, '^[a-z_]+_[a-z0-9_]+$') AS valid FROM i
""")
def entity_slug(spark, sf_dir):
    ids = _t(spark, sf_dir, "part").select("p_partkey", text.entity_id(F.col("p_name"), _type(F.col("p_partkey"))).alias("entity_id"))
    return ids.withColumn("valid", text.valid_entity_id(F.col("entity_id")))


@query(r"SELECT p_partkey, trim(regexp_replace(lower(replace(replace(p_brand || '_ ' || p_name || '.md', '.md', ''), '_', ' ')), '\s+', ' ', 'g')) AS name FROM part")
def normalize_name(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", text.normalize_name(F.concat("p_brand", F.lit("_ "), "p_name", F.lit(".md"))).alias("name"))


@query("SELECT doc_id, CAST(length(text) // 4 AS INTEGER) AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@query("""
WITH d AS (SELECT doc_id, length(text) // 4 + length(source) // 4 AS tokens, CASE lang WHEN 'en' THEN 8192 WHEN 'de' THEN 4096 ELSE 2048 END AS lim FROM documents)
SELECT doc_id, CAST(tokens AS INTEGER) AS tokens, tokens > 0.9 * lim AS warn FROM d
""")
def context_usage(spark, sf_dir):
    limit = F.when(F.col("lang") == "en", 8192).when(F.col("lang") == "de", 4096).otherwise(2048)
    used = text.context_usage(F.col("text"), F.col("source"), limit)
    return _t(spark, sf_dir, "documents").select("doc_id", used["tokens"].alias("tokens"), used["warn"].alias("warn"))


@query(r"SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS INTEGER) AS words FROM documents")
def word_count(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


@query("SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS chapter_index, doc_id FROM documents WHERE length(text) >= 100")
def chapter_index(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("source").orderBy("doc_id")
    kept = _t(spark, sf_dir, "documents").where(F.length("text") >= T.MIN_CHAPTER)
    return kept.select("source", (F.row_number().over(order) - 1).alias("chapter_index"), "doc_id")


def _chunks_sql(text_sql: str, size: int, overlap: int) -> str:
    return rf"""
RECURSIVE d AS (SELECT doc_id, {text_sql} AS t FROM documents),
c AS (
  SELECT doc_id, t, 0 AS i, CASE WHEN length(t) <= {size} THEN length(t) ELSE 0 END AS st, CASE WHEN length(t) <= {size} THEN t END AS chunk FROM d
  UNION ALL
  SELECT doc_id, t, i + 1, CASE WHEN e < length(t) THEN e - {overlap} ELSE e END, trim(substr(t, st + 1, e - st), ' ' || chr(10) || chr(9) || chr(13)) FROM (
    SELECT doc_id, t, i, st, CASE WHEN st + {size} >= length(t) THEN length(t) WHEN p > {size // 2} THEN st + p WHEN q > {size // 2} THEN st + q + 1 ELSE st + {size} END AS e FROM (
      SELECT doc_id, t, i, st, CASE WHEN strpos(reverse(w), chr(10) || chr(10)) = 0 THEN -1 ELSE length(w) - strpos(reverse(w), chr(10) || chr(10)) - 1 END AS p,
             CASE WHEN strpos(reverse(w), ' .') = 0 THEN -1 ELSE length(w) - strpos(reverse(w), ' .') - 1 END AS q
      FROM (SELECT doc_id, t, i, st, substr(t, st + 1, {size}) AS w FROM c WHERE st < length(t))))
)
"""


@query("WITH " + _chunks_sql("replace(text, chr(10), chr(10) || chr(10))", 300, 40) + """
SELECT doc_id, CAST(CASE WHEN length(t) <= 300 THEN 0 ELSE i - 1 END AS INTEGER) AS chunk_idx, sha256(chunk) AS h FROM c WHERE chunk IS NOT NULL
""")
def chunks(spark, sf_dir):
    doubled = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    cut = _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.chunks(doubled, 300, 40)).alias("chunk_idx", "chunk"))
    return cut.select("doc_id", "chunk_idx", F.sha2("chunk", 256).alias("h"))


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END AS preview, CAST(length(text) AS INTEGER) AS n FROM documents")
def trace_preview(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"), F.length("text").alias("n"))


# --- mentions: sources are books, documents are chapters, capitalised words are names -----------------

_MENTIONS = r"""
w AS (SELECT doc_id, source, lang || ' ' || n_chars AS context, unnest(list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda x: regexp_matches(x, '^[A-Z][a-z]{2,}$'))) AS name,
      unnest(range(1, 1 + len(list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda x: regexp_matches(x, '^[A-Z][a-z]{2,}$'))))) - 1 AS pos FROM documents),
m AS (SELECT source AS book_id, doc_id AS chapter_index, doc_id * 1000000 + pos AS ord, name, CASE length(name) % 4 WHEN 0 THEN 'character' WHEN 1 THEN 'location' WHEN 2 THEN 'faction' ELSE 'timeline_event' END AS entity_type, context FROM w)
"""


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", F.concat("lang", F.lit(" "), F.col("n_chars").cast("string")).alias("context"), F.posexplode(extract.capitalized(F.col("text"))).alias("pos", "name"))
    kinds = F.array(*[F.lit(t.name) for t in T.TYPES])
    return d.select(
        F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("chapter_index"), F.concat(F.lit("chapter "), F.col("doc_id").cast("string")).alias("chapter_title"),
        F.concat(F.col("doc_id").cast("string"), F.lit(":0")).alias("chunk_id"), (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("ord"), "name",
        F.array(F.lower("name")).alias("aliases"), F.element_at(kinds, F.length("name") % 4 + 1).alias("entity_type"), "context",
    )


@query("WITH" + _MENTIONS + """
SELECT book_id, lower(name) AS name_key, entity_type, arg_min(name, ord) AS name, CAST(arg_min(chapter_index, ord) AS INTEGER) AS chapter_index,
       arg_max(context, length(context) * 1000000000000 - ord) AS context, array_to_string(list_sort(list(DISTINCT lower(name))), ',') AS aliases, CAST(count(*) AS INTEGER) AS occurrence_count FROM m GROUP BY 1, 2, 3
""")
def raw_merge(spark, sf_dir):
    return merge.merge_raw(_mentions(spark, sf_dir)).drop("ord").withColumn("aliases", F.array_join("aliases", ","))


@query("WITH" + _MENTIONS + """, c AS (
SELECT book_id, chapter_index, lower(name) AS name_key, entity_type, arg_min(name, ord) AS name, min(ord) AS ord, count(*) AS n, arg_max(context, length(context) * 1000000000000 - ord) AS context FROM m GROUP BY 1, 2, 3, 4)
SELECT book_id, name_key, entity_type, arg_min(name, ord) AS name, name_key AS aliases, arg_max(context, length(context) * 1000000000000 - ord) AS context, CAST(arg_min(n, ord) + count(*) - 1 AS INTEGER) AS occurrence_count, CAST(sum(n) AS BIGINT) AS true_mentions
FROM c GROUP BY 1, 2, 3
""")
def two_level_merge(spark, sf_dir):
    return merge.merge_two_level(_mentions(spark, sf_dir)).drop("ord").withColumn("aliases", F.array_join("aliases", ","))


@query("WITH" + _MENTIONS + "SELECT DISTINCT entity_type || ':' || lower(name) AS entity, chapter_index || ':0' AS chunk FROM m")
def mention_index(spark, sf_dir):
    return graph.mention_index(_mentions(spark, sf_dir))


@query("WITH" + _MENTIONS + "SELECT entity_type, count(DISTINCT lower(name)) + count(DISTINCT name) - count(DISTINCT CASE WHEN name = lower(name) THEN name END) AS names FROM m GROUP BY 1")
def names_by_type(spark, sf_dir):
    return merge.names_by_type(_mentions(spark, sf_dir)).groupBy("entity_type").agg(F.count("*").alias("names"))


_GROUPS_SQL = "g AS (SELECT 'character' AS entity_type, n_nationkey AS pos, 'Nation ' || n_regionkey AS canonical, unnest([n_name, 'Nation ' || n_regionkey]) AS alias FROM nation), a AS (SELECT entity_type, lower(alias) AS alias_key, arg_max(canonical, pos) AS canonical FROM g GROUP BY 1, 2)"


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "nation").select(F.lit("character").alias("entity_type"), F.col("n_nationkey").alias("pos"), F.concat(F.lit("Nation "), F.col("n_regionkey").cast("string")).alias("canonical_name"), F.array("n_name").alias("aliases"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_mktsegment").alias("book_id"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.col("n_name")).alias("name"), F.lit("character").alias("entity_type"),
        F.array("c_name").alias("aliases"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("context"), F.concat(F.lit("ch"), (F.col("c_custkey") % 7).cast("string")).alias("chapter_title"),
        F.col("c_custkey").alias("ord"), (F.col("c_custkey") % 5 + 1).cast("int").alias("occurrence_count"),
    )


_CUST_SQL = "c AS (SELECT c_mktsegment AS book_id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE n_name END AS name, c_name, c_custkey AS ord, c_custkey % 5 + 1 AS n FROM customer JOIN nation ON c_nationkey = n_nationkey), j AS (SELECT c.*, coalesce(a.canonical, c.name) AS canonical FROM c LEFT JOIN a ON lower(c.name) = a.alias_key)"


@query(f"WITH {_GROUPS_SQL}, {_CUST_SQL} SELECT ord, name, canonical FROM j")
def alias_lookup(spark, sf_dir):
    return merge.canonical_names(_customers(spark, sf_dir), merge.alias_map(_groups(spark, sf_dir))).select("ord", "name", "canonical")


@query(f"""WITH {_GROUPS_SQL}, {_CUST_SQL} SELECT book_id, arg_min(canonical, ord) AS canonical_name, CAST(sum(n) AS BIGINT) AS total_occurrences, array_to_string(list_sort(list(DISTINCT 'ch' || ord % 7)), ',') AS chapters,
string_agg('c' || ord, ',' ORDER BY ord) AS contexts, array_to_string(list_sort(list_distinct(flatten(list([canonical, name, c_name])))), ',') AS all_names FROM j GROUP BY book_id, lower(canonical)""")
def alias_merge(spark, sf_dir):
    out = merge.merge_by_aliases(_customers(spark, sf_dir), merge.alias_map(_groups(spark, sf_dir)))
    return out.select("book_id", "canonical_name", "total_occurrences", F.array_join(F.array_sort("source_chapters"), ",").alias("chapters"), F.array_join("contexts", ",").alias("contexts"), F.array_join("all_names", ",").alias("all_names"))


@query("SELECT DISTINCT 'character' AS entity_type, c_mktsegment AS name FROM customer WHERE c_mktsegment NOT IN (SELECT n_name FROM nation) UNION SELECT 'character', n_name FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 3)")
def unresolved_names(spark, sf_dir):
    n, c = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "customer")
    names = n.select("n_name").union(c.select("c_mktsegment")).select(F.lit("character").alias("entity_type"), F.col("n_name").alias("name")).distinct()
    return merge.unresolved(names, _groups(spark, sf_dir).join(n.where("n_regionkey < 3").select(F.col("n_nationkey").alias("pos")), "pos", "left_semi"))


@query("SELECT entity_type, count(*) AS n, sum(len) AS length FROM (SELECT DISTINCT 'character' AS entity_type, p_name, length(p_name) AS len FROM part) GROUP BY 1")
def fuzzy_groups(spark, sf_dir):
    """Every distinct name is in one group, once; groups themselves are tested against a brute force."""
    names = _t(spark, sf_dir, "part").select(F.lit("character").alias("entity_type"), F.col("p_name").alias("name"))
    every = resolve.fuzzy_groups(names).select("entity_type", F.explode(F.concat(F.array("canonical_name"), "aliases")).alias("name"))
    return every.groupBy("entity_type").agg(F.count("*").alias("n"), F.sum(F.length("name")).cast("decimal(38,0)").alias("length"))


# --- similarity: nations against nations and regions ---------------------------------------------------

_LCS = """
RECURSIVE p AS (SELECT {a} AS a, {b} AS b FROM {tables}), s AS (
  SELECT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda x: CAST(0 AS BIGINT)) AS r FROM p
  UNION ALL
  SELECT a, b, i + 1, list_reduce(list_prepend([CAST(0 AS BIGINT)], list_transform(range(1, length(b) + 1), lambda x: [x])),
    lambda acc, x: list_append(acc, CASE WHEN substr(a, i + 1, 1) = substr(b, x[1], 1) THEN r[x[1]] + 1 ELSE greatest(r[x[1] + 1], acc[x[1]]) END)) FROM s WHERE i < length(a))
"""
_FINAL = "SELECT DISTINCT a, b, 200.0::DOUBLE * r[length(b) + 1] / (length(a) + length(b)) AS score FROM s WHERE i = length(a)"


def _nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("a"), F.lit(1).alias("k"))
    return n.join(n.select(F.col("a").alias("b"), "k"), "k").select("a", "b").distinct()


@query("WITH " + _LCS.format(a="x.n_name", b="y.n_name", tables="nation x, nation y") + _FINAL)
def lcs_ratio(spark, sf_dir):
    return _nation_pairs(spark, sf_dir).withColumn("score", similarity.ratio("a", "b"))


@query("WITH " + _LCS.format(a="array_to_string(list_sort(string_split('z ' || x.n_name, ' ')), ' ')", b="array_to_string(list_sort(string_split(y.n_name || ' B', ' ')), ' ')", tables="nation x, nation y") + _FINAL)
def token_sort_ratio(spark, sf_dir):
    a, b = similarity.sorted_tokens(F.concat(F.lit("z "), F.col("a"))), similarity.sorted_tokens(F.concat(F.col("b"), F.lit(" B")))
    return _nation_pairs(spark, sf_dir).select(a.alias("a"), b.alias("b")).distinct().withColumn("score", similarity.ratio("a", "b"))


_WINDOWS = """(SELECT sh, substr(lo, greatest(0, i) + 1, i + length(sh) - greatest(0, i)) AS win FROM (SELECT *, unnest(range(1 - length(sh), length(lo))) AS i FROM
(SELECT DISTINCT CASE WHEN length(x.n_name) <= length(y.n_name) THEN x.n_name ELSE y.n_name END AS sh, CASE WHEN length(x.n_name) <= length(y.n_name) THEN y.n_name ELSE x.n_name END AS lo FROM nation x, nation y)))"""


@query("WITH " + _LCS.format(a="DISTINCT sh", b="win", tables=_WINDOWS) + ", f AS (" + _FINAL + """), o AS (SELECT DISTINCT x.n_name AS a, y.n_name AS b FROM nation x, nation y),
w AS (SELECT *, unnest(range(1 - length(sh), length(lo))) AS i FROM (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS sh, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS lo FROM o))
SELECT w.a, w.b, max(f.score) AS score FROM w JOIN f ON f.a = w.sh AND f.b = substr(w.lo, greatest(0, i) + 1, i + length(sh) - greatest(0, i)) GROUP BY 1, 2
""")
def partial_ratio(spark, sf_dir):
    return _nation_pairs(spark, sf_dir).withColumn("score", similarity.partial_ratio("a", "b"))


# --- wiki: regions and nations are the list, customers and suppliers the names -------------------------


def _wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "nation").select(F.lit("character").alias("entity_type"), F.col("n_name").alias("wiki_name"), F.lower("n_name").alias("wiki_key"))


@query("WITH " + _LCS.format(a="DISTINCT lower(left(n.n_name, length(n.n_name) - 1))", b="lower(w.n_name)", tables="nation n, nation w") + ", f AS (" + _FINAL + """),
k AS (SELECT a, arg_max(b, score * 1000 - 0.0001 * rn) AS m, max(score) AS s FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY b) AS rn FROM f WHERE score >= 80) GROUP BY a)
SELECT DISTINCT lower(left(n.n_name, length(n.n_name) - 1)) AS name, upper(m) AS wiki_match, s AS match_score FROM nation n LEFT JOIN k ON lower(left(n.n_name, length(n.n_name) - 1)) = a
""")
def wiki_best_match(spark, sf_dir):
    short = F.lower(F.expr("left(n_name, length(n_name) - 1)"))
    names = _t(spark, sf_dir, "nation").select(F.lit("character").alias("entity_type"), short.alias("name")).distinct().withColumn("key", F.col("name"))
    return wiki.best_match(names, _wiki(spark, sf_dir), T.CLEANUP_FUZZY, partial=False).select("name", F.upper("wiki_match").alias("wiki_match"), "match_score")


_PRIORITY_SQL = """
e AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN n_name ELSE 'QQ' || c_custkey % 50 || '#' END AS name, c_custkey % 15 AS n, CASE WHEN c_custkey % 2 = 0 THEN 'character' ELSE 'location' END AS t FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT c_custkey, t AS entity_type, CASE WHEN t = 'character' AND c_custkey % 4 = 0 THEN 'canonical' WHEN n >= 10 THEN 'major' ELSE 'minor' END AS priority FROM e)
"""


def _prioritized(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation")
    far = F.concat(F.lit("QQ"), (F.col("c_custkey") % 50).cast("string"), F.lit("#"))
    e = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity_key"), F.when(F.col("c_custkey") % 2 == 0, "character").otherwise("location").alias("entity_type"),
        F.when(F.col("c_custkey") % 4 == 0, F.col("n_name")).otherwise(far).alias("name"), F.expr("cast(array() as array<string>)").alias("aliases"), (F.col("c_custkey") % 15).cast("int").alias("occurrence_count"),
    )
    return wiki.classify_priority(e, _wiki(spark, sf_dir).drop("wiki_key"))


@query(f"WITH {_PRIORITY_SQL} SELECT c_custkey AS entity_key, priority FROM p")
def priority_class(spark, sf_dir):
    return _prioritized(spark, sf_dir).select("entity_key", "priority")


@query(f"""WITH {_PRIORITY_SQL} SELECT coalesce(entity_type, 'all') AS entity_type, count(*) FILTER (priority = 'canonical') AS canonical, count(*) FILTER (priority = 'major') AS major,
count(*) FILTER (priority = 'minor') AS minor, count(*) AS total FROM p GROUP BY ROLLUP (entity_type)""")
def priority_rollup(spark, sf_dir):
    return wiki.priority_counts(_prioritized(spark, sf_dir)).withColumn("entity_type", F.coalesce("entity_type", F.lit("all")))


_NOISE_SQL = f"'{wiki.NOISE}'"
_NAMED_SQL = "n AS (SELECT doc_id, (['The_man', 'goblin_level_2', 'crawler_12', '35_years', 'theodore', 'Bautista the Great', 'Élan', 'a_dog'])[doc_id % 8 + 1] AS name, CASE WHEN doc_id % 3 = 0 THEN source || ' ' || lang ELSE text END AS description, text AS content FROM documents)"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("The_man", "goblin_level_2", "crawler_12", "35_years", "theodore", "Bautista the Great", "Élan", "a_dog")])
    d = F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit(" "), "lang")).otherwise(F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.element_at(names, (F.col("doc_id") % 8 + 1).cast("int")).alias("name"), d.alias("description"), F.col("text").alias("content"), F.lit("character").alias("entity_type"))


@query(f"WITH {_NAMED_SQL} SELECT doc_id, regexp_matches(name, {_NOISE_SQL}) AS noise FROM n")
def noise_flag(spark, sf_dir):
    return _named(spark, sf_dir).select("doc_id", wiki.is_noise(F.col("name")).alias("noise"))


_SCORE_SQL = f"""
CAST(CASE WHEN regexp_matches(name, '^\\p{{Lu}}') THEN 15 ELSE 0 END + CASE WHEN length(name) > 10 THEN 10 WHEN length(name) > 5 THEN 5 ELSE 0 END + CASE WHEN regexp_matches(name, {_NOISE_SQL}) THEN 0 ELSE 5 END
+ CASE WHEN length(description) > 500 THEN 40 WHEN length(description) > 200 THEN 30 WHEN length(description) > 100 THEN 20 WHEN length(description) > 50 THEN 10 ELSE 0 END
+ CASE WHEN length(content) > 1000 THEN 30 WHEN length(content) > 500 THEN 20 WHEN length(content) > 200 THEN 10 ELSE 0 END AS INTEGER)"""


@query(f"WITH {_NAMED_SQL} SELECT doc_id, {_SCORE_SQL} AS score FROM n")
def quality_score(spark, sf_dir):
    return _named(spark, sf_dir).select("doc_id", wiki.quality_score(F.col("name"), F.col("description"), F.col("content")).alias("score"))


_CLEAN_SQL = f"""{_NAMED_SQL}, q AS (SELECT doc_id, name, {_SCORE_SQL} AS s FROM n), t AS (SELECT doc_id, CASE WHEN name = 'theodore' THEN 100 ELSE s END AS quality_score,
CASE WHEN name = 'theodore' THEN 'canonical' WHEN regexp_matches(name, {_NOISE_SQL}) THEN 'noise' WHEN s >= 70 THEN 'major' WHEN s >= 40 THEN 'minor' ELSE 'noise' END AS priority FROM q)"""


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame([("character", "Theodore"), ("location", "Bautista the Great")], "entity_type string, wiki_name string")
    return wiki.classify_cleanup(_named(spark, sf_dir), entries)


@query(f"WITH {_CLEAN_SQL} SELECT doc_id, quality_score, priority FROM t")
def cleanup_class(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("doc_id", "quality_score", "priority")


@query(f"WITH {_CLEAN_SQL} SELECT count(*) AS total, count(*) FILTER (priority = 'canonical') AS canonical, count(*) FILTER (priority = 'major') AS major, count(*) FILTER (priority = 'minor') AS minor, count(*) FILTER (priority = 'noise') AS noise FROM t")
def cleanup_stats(spark, sf_dir):
    return wiki.cleanup_stats(_cleaned(spark, sf_dir))


@query(r"""
WITH d AS (SELECT doc_id, '---' || chr(10) || 'name: x' || chr(10) || '---' || chr(10) || '# Title' || chr(10) || chr(10) || 'First.' || chr(10) || '---' || chr(10) || 'hidden' || chr(10) || ' --- ' || chr(10) || text AS content FROM documents),
l AS (SELECT doc_id, trim(unnest(string_split(content, chr(10)))) AS x, unnest(range(len(string_split(content, chr(10))))) AS pos FROM d),
f AS (SELECT doc_id, x, pos, sum(CASE WHEN x = '---' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) % 2 AS inside FROM l),
k AS (SELECT doc_id, x, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM f WHERE inside = 0 AND x NOT IN ('', '---') AND x NOT LIKE '#%')
SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS description FROM k WHERE rn <= 3 GROUP BY doc_id
""")
def frontmatter_toggle(spark, sf_dir):
    content = F.concat(F.lit("---\nname: x\n---\n# Title\n\nFirst.\n---\nhidden\n --- \n"), F.col("text"))
    return wiki.markdown_parts(_t(spark, sf_dir, "documents").select("doc_id", content.alias("content"))).select("doc_id", "description")


# --- answers of models: events' properties in various wrappings -----------------------------------------


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = F.col("props"), F.col("event_id") % 5
    shaped = F.when(k == 0, p).when(k == 1, F.concat(F.lit("Here:\n```json\n"), p, F.lit("\n```\nDone."))).when(k == 2, F.concat(F.lit("The answer is "), p, F.lit(" as asked."))).when(k == 3, F.concat(p, F.lit(" broken {"))).otherwise(F.lit("no json"))
    return _t(spark, sf_dir, "events").select("event_id", shaped.alias("response"))


@query("SELECT event_id, CASE WHEN event_id % 5 < 4 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def json_recover(spark, sf_dir):
    return _answers(spark, sf_dir).select("event_id", F.try_variant_get(text.recovered_json(F.col("response")), "$.k", "long").alias("k"))


@query("SELECT event_id, event_type AS name, CASE WHEN user_id % 2 = 0 THEN 'character' ELSE 'faction' END AS entity_type FROM events WHERE event_id % 4 < 2 AND event_type <> 'click'")
def valid_entities(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("name"), F.when(F.col("event_id") % 4 >= 2, "Dragon").when(F.col("user_id") % 2 == 0, "CHARACTER").otherwise("Faction").alias("entity_type"), F.lit(None).cast("array<string>").alias("aliases"), F.lit(None).cast("string").alias("context"))
    return merge.valid(e, tuple(T.BY_NAME)).select("event_id", "name", "entity_type")


# --- telemetry, progress, traces: the events table ------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("name"), "value", "ts", "event_id", "user_id")


@query("SELECT event_type AS name, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def counters(spark, sf_dir):
    cents = _metrics(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100).cast("long"))
    return telemetry.counters(cents)


@query("""
WITH v AS (SELECT event_type AS name, list_sort(list(round(value * 100))) AS v FROM events GROUP BY 1)
SELECT name, CAST(len(v) AS BIGINT) AS count, list_sum(v) AS sum, list_sum(v) / len(v) AS mean, v[1] AS min, v[len(v)] AS max, v[CAST(floor(len(v) * 0.5) AS BIGINT) + 1] AS p50, v[CAST(floor(len(v) * 0.95) AS BIGINT) + 1] AS p95 FROM v
""")
def histogram(spark, sf_dir):
    cents = _metrics(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100))  # whole numbers, so sums are exact
    return telemetry.histogram(cents)


@query("SELECT event_type AS name, arg_max(value, (ts, value)) AS value FROM events GROUP BY 1")
def gauge(spark, sf_dir):
    return telemetry.gauges(_metrics(spark, sf_dir))


@query("SELECT user_id % 10 AS stage, count(*) AS errors, count(*) FILTER (event_id % 7 = 0) AS fatal FROM events GROUP BY 1")
def error_totals(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("stage"), (F.col("event_id") % 7 == 0).alias("fatal"))
    return telemetry.errors(rows)


@query("""
WITH m AS (SELECT user_id, event_id AS s, CASE WHEN event_id % 3 = 0 THEN 'stop' ELSE 'start' END AS a FROM events),
l AS (SELECT *, lag(a) OVER w AS pa, lag(s) OVER w AS ps FROM m WINDOW w AS (PARTITION BY user_id ORDER BY s))
SELECT user_id, CAST((s - ps) * 1000 AS DOUBLE) AS duration_ms FROM l WHERE a = 'stop' AND pa = 'start'
""")
def timers(spark, sf_dir):
    marks = _t(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 3 == 0, "stop").otherwise("start").alias("action"), F.col("event_id").cast("double").alias("seconds"))
    return telemetry.timers(marks, ["user_id"])


@query("SELECT event_type AS name, count(*) AS spans, count(*) FILTER (event_id % 11 = 0) AS errors, CAST(sum(CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id * 1000 END) AS DOUBLE) AS total_ms, CAST(max(CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id * 1000 END) AS DOUBLE) AS max_ms FROM events GROUP BY 1")
def span_stats(spark, sf_dir):
    spans = _t(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.when(F.col("event_id") % 11 == 0, "error").otherwise("ok").alias("status"), F.col("event_id").cast("double").alias("start"), F.when(F.col("event_id") % 5 != 0, (F.col("event_id") + F.col("user_id")).cast("double")).alias("end"))
    return telemetry.span_stats(spans)


@query("WITH RECURSIVE d AS (SELECT p_partkey, 0 AS depth FROM part WHERE p_partkey // 3 NOT IN (SELECT p_partkey FROM part) OR p_partkey // 3 = p_partkey UNION ALL SELECT p.p_partkey, depth + 1 FROM part p JOIN d ON p.p_partkey // 3 = d.p_partkey AND p.p_partkey <> d.p_partkey) SELECT CAST(p_partkey AS VARCHAR) AS span_id, CAST(depth AS INTEGER) AS depth FROM d")
def span_depth(spark, sf_dir):
    spans = _t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("span_id"), F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 3).cast("string")).alias("parent_id"))
    return telemetry.span_depth(spans)


@query("""
SELECT event_id, CAST(CASE WHEN t > 0 AND c > t THEN t ELSE c END AS BIGINT) AS current, t > 0 AND c > t AS overflow,
  CASE WHEN t = 0 THEN 0.0 WHEN least(c, t) < t AND c * 100.0 / t > 95 THEN 95.0 ELSE CAST(CASE WHEN t > 0 AND c > t THEN t ELSE c END AS DOUBLE) / t * 100 END AS percentage
FROM (SELECT event_id, event_id % 120 AS c, user_id % 101 AS t FROM events)
""")
def progress_pct(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 120).alias("current"), (F.col("user_id") % 101).alias("total"))
    return telemetry.progress(rows).select("event_id", "current", "overflow", "percentage")


@query("""
WITH l AS (SELECT event_id, user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id, count(*) AS gaps, max(gap) AS longest FROM l WHERE gap > 60 * 1000000 GROUP BY 1
""")
def silent_gaps(spark, sf_dir):
    gaps = telemetry.silent_gaps(_t(spark, sf_dir, "events"), ["user_id"])
    return gaps.groupBy("user_id").agg(F.count("*").alias("gaps"), F.max(F.round(F.col("gap_seconds") * 1_000_000).cast("long")).alias("longest"))


# --- state: events and documents as logs ----------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("completed_at"), F.col("props").alias("result"), F.when(F.col("event_id") % 9 != 0, F.col("event_type")).alias("model_name"), (F.col("event_id") % 2).cast("string").alias("prompt_hash"))


_LOG_SQL = "log AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id AS completed_at, props AS result, CASE WHEN event_id % 9 <> 0 THEN event_type END AS model_name, CAST(event_id % 2 AS VARCHAR) AS prompt_hash FROM events)"


@query(f"WITH {_LOG_SQL} SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY completed_at DESC) AS rn FROM log) WHERE rn = 1")
def upsert_latest(spark, sf_dir):
    log = _log(spark, sf_dir)
    return state.upsert(log.where("completed_at % 2 = 0"), log.where("completed_at % 2 = 1"), "key", "completed_at")


@query(f"WITH {_LOG_SQL} SELECT completed_at, NOT (coalesce(model_name, '') = 'click' AND prompt_hash = '1') AS stale FROM log")
def stale_entries(spark, sf_dir):
    return _log(spark, sf_dir).select("completed_at", state.is_stale(F.col("model_name"), F.col("prompt_hash"), "click", "1").alias("stale"))


@query(f"WITH {_LOG_SQL} SELECT * FROM log WHERE model_name IS DISTINCT FROM 'click'")
def invalidate_model(spark, sf_dir):
    return state.invalidate_model(_log(spark, sf_dir), "click")


@query(f"WITH {_LOG_SQL} SELECT count(*) AS total_entries, count(*) FILTER (model_name IS NULL) AS entries_without_model FROM log")
def cache_stats(spark, sf_dir):
    return state.cache_stats(_log(spark, sf_dir))


@query(f"WITH {_LOG_SQL}, h AS (SELECT key, completed_at, left(sha256(result), 12) AS result_hash, lag(left(sha256(result), 12)) OVER (PARTITION BY key ORDER BY completed_at) AS previous_hash FROM log) SELECT * FROM h WHERE previous_hash <> result_hash")
def nondeterminism(spark, sf_dir):
    return state.changed_results(_log(spark, sf_dir)).select("key", "completed_at", "result_hash", "previous_hash")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def cache_miss(spark, sf_dir):
    cache = _t(spark, sf_dir, "labels").select("doc_id", F.lit("x").alias("result"))
    return state.misses(_t(spark, sf_dir, "documents").select("doc_id"), cache, "doc_id")


@query("SELECT d.doc_id, CAST(l.toxic AS VARCHAR) AS result FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def cache_hit(spark, sf_dir):
    cache = _t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("string").alias("result"))
    return state.hits(_t(spark, sf_dir, "documents").select("doc_id"), cache, "doc_id")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0) GROUP BY 2")
def registry_incremental(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("book_id"), text.content_hash(F.col("text")).alias("content_hash"))
    return state.new_books(d, d.where("doc_id % 10 = 0")).select("doc_id", "content_hash")


@query("SELECT conv_id AS book_id, turn AS chapter_index FROM conversations WHERE conv_id % 3 <> 0 OR turn % 2 <> 0")
def chapters_left(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("chapter_index"))
    return state.chapters_left(c, c.where("book_id % 3 = 0 and chapter_index % 2 = 0"))


@query("SELECT book_id, chapter_index, CAST(rn AS INTEGER) AS n_done FROM (SELECT source AS book_id, doc_id AS chapter_index, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn % 5 = 0")
def every_nth(spark, sf_dir):
    done = _t(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("chapter_index"), F.col("doc_id").alias("completed_at"))
    return state.checkpoint_rows(done).select("book_id", "chapter_index", "n_done")


# --- descriptions and output ----------------------------------------------------------------------------


@query("""
SELECT conv_id, 'Describe the location X' || conv_id || '.' || chr(10) || 'Also known as: None' || chr(10) || 'Fields: location_type, environment, architecture, atmosphere' || chr(10) || 'Text:' || chr(10) ||
  coalesce(string_agg('- ' || text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> ''), 'No context available.') AS prompt FROM conversations GROUP BY conv_id
""")
def prompt_render(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("contexts"))
    return c.select("conv_id", summarize.prompt(F.concat(F.lit("X"), F.col("conv_id").cast("string")), F.lit("location"), F.expr("cast(array() as array<string>)"), F.col("contexts")).alias("prompt"))


@query("SELECT conv_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS content_hash, CAST(sum(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS words FROM conversations GROUP BY conv_id")
def full_text(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n\n")
    return c.agg(text.content_hash(whole).alias("content_hash"), F.sum(text.word_count(F.col("text"))).alias("words"))


@query("SELECT source AS id, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) FILTER (n_chars % 2 = 0) AS n_chars FROM documents GROUP BY 1")
def source_priority_merge(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select(F.col("source").alias("id"), F.col("doc_id").alias("priority"), "lang", F.when(F.col("n_chars") % 2 == 0, F.col("n_chars")).alias("n_chars"))
    return merge.by_source_priority(d, "id", ["lang", "n_chars"])


@query("""
SELECT n_nationkey, '{"entity_id":"char_x","entity_type":"character","name":"' || n_name || '","aliases":[],"description":null,"first_appearance":null,"occurrence_count":' || n_nationkey ||
  CASE WHEN n_nationkey % 2 = 0 THEN ',"role":"r"' ELSE '' END || '}' AS json FROM nation
""")
def output_json(spark, sf_dir):
    e = _t(spark, sf_dir, "nation").select("n_nationkey", F.lit("char_x").alias("entity_id"), F.lit("character").alias("entity_type"), F.col("n_name").alias("name"), F.expr("cast(array() as array<string>)").alias("aliases"), F.lit(None).cast("string").alias("canonical_description"), F.lit(None).cast("string").alias("first_appearance"), F.col("n_nationkey").alias("occurrence_count"), F.when(F.col("n_nationkey") % 2 == 0, "r").otherwise("").alias("role"), F.expr("cast(array() as array<string>)").alias("abilities"))
    return summarize.output_json(e).select("n_nationkey", "json")


# --- files: written below the shared folder and read back ------------------------------------------------


def _far(key: Column, salt: str, width: int = 24) -> Column:
    """Names so different from each other that only planted likeness matches."""
    return F.substring(F.sha2(F.concat(F.lit(salt), key.cast("string")), 256), 1, width)


@query("""
SELECT 'character' AS entity_type, CASE WHEN n_nationkey % 3 = 0 THEN 'Sir ' || n_name ELSE n_name END AS wiki_name, CASE WHEN n_nationkey % 3 = 0 THEN 'd' || n_nationkey ELSE '' END AS description FROM nation WHERE n_nationkey % 3 < 2
UNION ALL SELECT 'timeline_event', r_name, '' FROM region
""")
def wiki_files(spark, sf_dir):
    """Entries that are objects, texts, or neither; events are named by another field."""
    k = F.col("n_nationkey") % 3
    named = F.to_json(F.struct(F.concat(F.lit("Sir "), F.col("n_name")).alias("name"), F.concat(F.lit("d"), F.col("n_nationkey").cast("string")).alias("description")))
    entry = F.when(k == 0, named).when(k == 1, F.concat(F.lit('"'), F.col("n_name"), F.lit('"'))).otherwise(F.lit("17"))
    listed = _t(spark, sf_dir, "nation").agg(F.array_join(F.collect_list(entry), ",").alias("c"))
    events = _t(spark, sf_dir, "region").agg(F.array_join(F.collect_list(F.to_json(F.struct(F.col("r_name").alias("event")))), ",").alias("e"))
    at = new_folder(spark, "wiki")
    listed.join(events).select(F.concat(F.lit('{"characters":['), "c", F.lit('],"timeline_events":['), "e", F.lit("]}"))).write.text(at)
    return corpus.read_wiki(spark, at)


_TYPES4_SQL = "CASE {k} % 5 WHEN 1 THEN 'location' WHEN 2 THEN 'faction' WHEN 3 THEN 'timeline_event' ELSE 'character' END"
_FOLDER_SQL = "CASE {k} % 5 WHEN 1 THEN 'locations' WHEN 2 THEN 'factions' WHEN 3 THEN 'timeline' ELSE 'characters' END"
_ID_SQL = "CASE {k} % 5 WHEN 0 THEN 'char' WHEN 1 THEN 'loc' WHEN 2 THEN 'fac' WHEN 3 THEN 'evt' ELSE 'ent' END || '_' || n"
_FILES_SQL = "f AS (SELECT s_suppkey, left(sha256('f' || s_suppkey), 24) AS n, s_suppkey % 15 AS c FROM supplier)"


def _entity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", _far(F.col("s_suppkey"), "f").alias("name"), _type(F.col("s_suppkey")).alias("entity_type"), F.array(F.lit("one"), F.concat(F.lit("zz"), F.col("s_suppkey").cast("string"), F.lit("zz"))).alias("aliases"), (F.col("s_suppkey") % 15).alias("occurrence_count"))
    return sinks.entity_markdown(s.withColumn("entity_id", text.entity_id(F.col("name"), F.col("entity_type"))).withColumn("canonical_description", F.concat(F.lit("About "), "name")))


def _folder_of_files(spark: SparkSession, files: DataFrame) -> str:
    root = new_folder(spark, "corpus")
    table(sinks.write_files(files, root))
    return root


@query(f"WITH {_FILES_SQL} SELECT {_TYPES4_SQL.format(k='s_suppkey')} AS entity_type, {_ID_SQL.format(k='s_suppkey')} AS file, n AS name, 'one, zz' || s_suppkey || 'zz' AS aliases, CAST(c AS VARCHAR) AS occurrence_count, 'About ' || n AS description FROM f")
def corpus_files(spark, sf_dir):
    """Types that aren't known are in the folder of characters; files whose name begins with '_' don't count."""
    files = _entity_files(spark, sf_dir)
    index = files.limit(1).select(F.lit("characters/_index.md").alias("path"), F.lit("---\nname: x\n---\n").alias("content"))
    fm = lambda k: F.col("front_matter")[k].alias(k)
    found = corpus.read_corpus(spark, _folder_of_files(spark, files.unionByName(index)))
    return found.select("entity_type", F.col("name").alias("file"), fm("name"), fm("aliases"), fm("occurrence_count"), "description")


@query(f"""WITH {_FILES_SQL}, p AS (SELECT *, s_suppkey % 2 = 0 AS l, {_ID_SQL.format(k='s_suppkey')} AS id FROM f)
SELECT id || '.md' AS file, '---' || chr(10) || 'name: ' || n || chr(10) || 'entity_type: ' || {_TYPE_SQL.format(k='s_suppkey')} || chr(10) || 'aliases: [one, zz' || s_suppkey || 'zz]' || chr(10) || 'occurrence_count: ' || c || chr(10) ||
'priority: ' || CASE WHEN l THEN 'canonical' WHEN c >= 10 THEN 'major' ELSE 'minor' END || chr(10) || 'is_wiki_linked: ' || l || chr(10) || CASE WHEN l THEN 'wiki_entry_name: ' || n || chr(10) ELSE '' END || '---' || chr(10) || '# ' || n || chr(10) || chr(10) || 'About ' || n AS content FROM p""")
def priority_files(spark, sf_dir):
    """Priorities of a folder's entities by the list, in their front matter."""
    files = table(corpus.read_corpus(spark, _folder_of_files(spark, _entity_files(spark, sf_dir))))
    listed = files.where("front_matter['aliases'] rlike '[02468]zz$'").select("entity_type", F.col("front_matter")["name"].alias("wiki_name"))
    classified, _ = books.classify_corpus(files, listed)
    return sinks.priority_files(classified).select(F.substring_index("path", "/", -1).alias("file"), "content")


@query(f"""WITH {_FILES_SQL} SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'archive/now/' || {_TYPES4_SQL.format(k='s_suppkey')} || 's/' ELSE {_FOLDER_SQL.format(k='s_suppkey')} || '/' END || {_ID_SQL.format(k='s_suppkey')} || '.md' AS path FROM f""")
def archived_files(spark, sf_dir):
    """Noise is moved: what is in a folder afterwards."""
    root = _folder_of_files(spark, _entity_files(spark, sf_dir))
    noise = F.when(F.col("front_matter")["aliases"].rlike("[02468]zz$"), "noise").otherwise("minor")
    classified = corpus.read_corpus(spark, root).withColumn("priority", noise)
    table(sinks.move_files(sinks.archived(classified, "now"), root))
    left = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(root)
    return left.select(F.element_at(F.split("path", "/corpus-[0-9a-f]{32}/"), 2).alias("path"))


@query(f"WITH {_CLEAN_SQL} SELECT name, quality_score FROM t JOIN n USING (doc_id) WHERE priority = 'noise' ORDER BY quality_score, name LIMIT 20")
def noise_sample(spark, sf_dir):
    """A report of twenty names, as the operator gives it."""
    return wiki.noise_sample(_cleaned(spark, sf_dir)).select("name", "quality_score")


@query("""
SELECT r_name AS book_id, '{"metadata":{"book_id":"' || r_name || '","title":null},"entities":[' || coalesce((SELECT string_agg(j, ',' ORDER BY j) FROM (
  SELECT '{"entity_id":"char_' || n_nationkey || '","entity_type":"character","name":"' || n_name || '","aliases":[],"description":null,"first_appearance":null,"occurrence_count":' || n_nationkey || '}' AS j FROM nation WHERE n_regionkey = r_regionkey)), '') ||
  '],"connections":' || coalesce((SELECT '[' || string_agg('{"source":"' || a.n_name || '","target":"' || b.n_name || '","weight":' || (a.n_nationkey + b.n_nationkey) % 3 || ',"co_occurrence_chapters":["c"]}', ',' ORDER BY (a.n_nationkey + b.n_nationkey) % 3 DESC, a.n_name, b.n_name) || ']'
  FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name WHERE a.n_regionkey = r_regionkey), '[]') || ',"telemetry":{"calls":' || r_regionkey || '}}' AS json FROM region
""")
def result_json(spark, sf_dir):
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    named = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("book_id"), "n_name", "n_nationkey")
    entities = named.select("book_id", F.concat(F.lit("char_"), F.col("n_nationkey").cast("string")).alias("entity_id"), F.lit("character").alias("entity_type"), F.col("n_name").alias("name"), F.expr("cast(array() as array<string>)").alias("aliases"), F.lit(None).cast("string").alias("canonical_description"), F.lit(None).cast("string").alias("first_appearance"), F.col("n_nationkey").alias("occurrence_count"))
    b = named.select("book_id", F.col("n_name").alias("target"), F.col("n_nationkey").alias("k"))
    edges = named.join(b, "book_id").where("n_name < target").select("book_id", F.col("n_name").alias("source"), "target", ((F.col("n_nationkey") + F.col("k")) % 3).cast("long").alias("weight"), F.array(F.lit("c")).alias("co_occurrence_chapters"))
    return sinks.result_json(r.select(F.col("r_name").alias("book_id"), F.lit(None).cast("string").alias("title")), entities, edges, r.select(F.col("r_name").alias("book_id"), F.col("r_regionkey").alias("calls")))


@query(f"WITH {_LOG_SQL} SELECT key, completed_at, result FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY completed_at DESC) AS rn FROM log) WHERE rn = 1")
def state_table(spark, sf_dir):
    """A table that starts out missing and is replaced by what is read from it and added to it."""
    schema, at = "key string, completed_at long, result string", new_folder(spark, "state")
    log = _log(spark, sf_dir).select("key", "completed_at", "result")
    for part in range(2):
        sinks.replace_table(state.upsert(sinks.load_or_empty(spark, at, schema), log.where(F.col("completed_at") % 2 == part), "key", "completed_at"), at)
    return sinks.load_or_empty(spark, at, schema)


# --- likeness that is planted, so that SQL knows it ------------------------------------------------------

_ORDERS = list(itertools.permutations(range(4)))
_STARS_SQL = f"""
s AS (SELECT s_suppkey AS k, sha256('g' || s_suppkey) AS h FROM supplier), t AS (SELECT k, [substr(h, 1, 6), substr(h, 7, 6), substr(h, 13, 6), substr(h, 19, 6)] AS t, left(h, 24) AS x, substr(h, 25, 24) AS y FROM s),
n AS (SELECT k, unnest([{", ".join("array_to_string([" + ", ".join(f"t[{i + 1}]" for i in p) + "], ' ')" for p in _ORDERS)}]) AS name FROM t WHERE k % 2 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY name) AS rn FROM n)
SELECT 'character' AS entity_type, min(name) AS canonical_name, coalesce(string_agg(name, ',' ORDER BY name) FILTER (rn % 10 <> 1), '') AS aliases, CAST(1 AS DOUBLE) AS confidence FROM r GROUP BY k, (rn - 1) // 10
UNION ALL SELECT 'character', x || ' ' || y || 'q', least(x || ' ' || y, y || ' ' || x) || ',' || greatest(x || ' ' || y, y || ' ' || x), 200.0::DOUBLE * 49 / 99 / 100 FROM t WHERE k % 2 = 1
"""


@query("WITH " + _STARS_SQL)
def fuzzy_stars(spark, sf_dir):
    """Whole groups: 24 orders of four words are three stars of at most ten, and a longer spelling is canonical."""
    h = F.sha2(F.concat(F.lit("g"), F.col("s_suppkey").cast("string")), 256)
    x, y = F.substring(h, 1, 24), F.substring(h, 25, 24)
    words = [F.substring(h, 1 + 6 * i, 6) for i in range(4)]
    names = F.when(F.col("s_suppkey") % 2 == 0, F.array(*[F.concat_ws(" ", *[words[i] for i in p]) for p in _ORDERS])).otherwise(F.array(F.concat_ws(" ", x, y), F.concat_ws(" ", y, x), F.concat(x, F.lit(" "), y, F.lit("q"))))
    found = resolve.fuzzy_groups(_t(spark, sf_dir, "supplier").select(F.lit("character").alias("entity_type"), F.explode(names).alias("name")))
    return found.withColumn("aliases", F.array_join("aliases", ","))


@query("""
WITH s AS (SELECT s_suppkey AS k, left(sha256('w' || s_suppkey), 24) AS h FROM supplier), w AS (SELECT k, h FROM s WHERE k % 2 = 0)
SELECT s.k AS entity_key, w.h AS wiki_entry_name, CASE WHEN w.h IS NOT NULL THEN 'canonical' WHEN s.k % 15 >= 10 THEN 'major' ELSE 'minor' END AS priority FROM s LEFT JOIN w ON s.k % 4 < 3 AND s.k - CASE WHEN s.k % 4 = 1 THEN 1 ELSE 0 END = w.k
""")
def wiki_links(spark, sf_dir):
    """Names that are part of an entry, aliases after names that match nothing, one letter changed, none."""
    k, h = F.col("s_suppkey"), _far(F.col("s_suppkey"), "w")
    s = _t(spark, sf_dir, "supplier")
    far = _far(k, "v")
    name = F.when(k % 4 == 0, F.upper(F.substring(h, 3, 12))).when(k % 4 == 2, F.concat(F.lit("Q"), F.substring(h, 2, 23))).otherwise(far)
    aliases = F.when(k % 4 == 1, F.array(_far(k, "u"), F.concat(_far(k - 1, "w"), F.lit("q"))))
    entities = s.select(k.alias("entity_key"), F.lit("character").alias("entity_type"), name.alias("name"), aliases.alias("aliases"), (k % 15).cast("int").alias("occurrence_count"))
    listed = s.where("s_suppkey % 2 = 0").select(F.lit("character").alias("entity_type"), h.alias("wiki_name"))
    return wiki.classify_priority(entities, listed).select("entity_key", "wiki_entry_name", "priority")


@query("""
SELECT 'location' AS entity_type, n_name AS canonical_name, CASE WHEN n_nationkey % 2 = 0 THEN 'x,y' ELSE '' END AS aliases, CASE WHEN n_nationkey % 2 = 0 THEN 0.5 ELSE CAST(0.9 AS DOUBLE) END AS confidence, CAST(n_nationkey * 100000 + 1 AS BIGINT) AS pos FROM nation WHERE n_nationkey % 5 > 0
""")
def model_groups(spark, sf_dir):
    """Groups from answers: the first of each is without a name, every fifth answer holds no object."""
    k = F.col("n_nationkey")
    n = _t(spark, sf_dir, "nation").select(F.lit("location").alias("entity_type"), k.cast("int").alias("block"), k.cast("string").alias("key"), "n_name")
    one = F.when(F.col("block") % 2 == 0, F.concat(F.lit('{"canonical_name":"'), "n_name", F.lit('","aliases":["x","y"],"confidence":0.5}'))).otherwise(F.concat(F.lit('{"canonical_name":"'), "n_name", F.lit('"}')))
    answer = F.when(F.col("block") % 5 == 0, "none").otherwise(F.concat(F.lit('```json\n{"groups":[{"canonical_name":""},'), one, F.lit("]}\n```")))
    return resolve.groups_from(n, n.select("key", answer.alias("response"))).withColumn("aliases", F.array_join("aliases", ","))


@query("""
SELECT 'char_' || lower(replace(n_name, '_', '')) AS entity_id, n_name AS name, 'a' || n_nationkey AS aliases, 'ch' || n_regionkey AS first_appearance, CAST(n_nationkey AS BIGINT) AS occurrence_count, CASE WHEN n_nationkey % 3 > 0 THEN 'd' || n_nationkey END AS description,
CASE WHEN n_nationkey % 3 > 0 THEN 'r' END AS role, CASE WHEN n_nationkey % 3 > 0 THEN 'p,q' ELSE '' END AS abilities, true AS valid FROM nation
UNION ALL SELECT 'char_', '!!!', r_name, 'ch', r_regionkey, NULL, NULL, '', false FROM region
""")
def described_entities(spark, sf_dir):
    k = F.col("n_nationkey")
    resolved = _t(spark, sf_dir, "nation").select(F.lit("b").alias("book_id"), F.col("n_name").alias("canonical_name"), F.lit("character").alias("entity_type"), F.array(F.concat(F.lit("a"), k.cast("string")), "n_name").alias("all_names"), F.array(F.lit("t")).alias("contexts"), F.array(F.concat(F.lit("ch"), F.col("n_regionkey").cast("string"))).alias("source_chapters"), k.cast("long").alias("total_occurrences"), "n_nationkey")
    said = F.concat(F.lit('{"description":"d'), k.cast("string"), F.lit('","role":"r","abilities":["p","q"],"goals":["not a field of characters"]}'))
    answers = resolved.where("n_nationkey % 3 > 0").select("book_id", "canonical_name", "entity_type", said.alias("response"))
    nameless = _t(spark, sf_dir, "region").select(F.lit("b").alias("book_id"), F.lit("!!!").alias("canonical_name"), F.lit("character").alias("entity_type"), F.array(F.lit("!!!"), "r_name").alias("all_names"), F.array(F.lit("t")).alias("contexts"), F.array(F.lit("ch")).alias("source_chapters"), F.col("r_regionkey").cast("long").alias("total_occurrences"))
    good, bad = summarize.entities(resolved.drop("n_nationkey").unionByName(nameless), answers)
    both = good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))
    return both.select("entity_id", "name", F.array_join("aliases", ",").alias("aliases"), "first_appearance", "occurrence_count", F.col("canonical_description").alias("description"), "role", F.array_join("abilities", ",").alias("abilities"), "valid")


@query("""
SELECT role, 'Describe the character ' || role || '.' || chr(10) || 'Also known as: A, B' || chr(10) || 'Fields: physical_traits, personality_traits, abilities, role, species' || chr(10) || 'Text:' || chr(10) || string_agg('- ' || text, chr(10) || chr(10) ORDER BY conv_id, turn) FILTER (text <> '') AS prompt
FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations) WHERE rn <= 50 GROUP BY role
""")
def prompt_contexts(spark, sf_dir):
    """Prompts show the first fifty contexts of many: that limit is the operator's."""
    c = _t(spark, sf_dir, "conversations").groupBy("role").agg(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "text"))), lambda x: x["text"]).alias("contexts"))
    return c.select("role", summarize.prompt(F.col("role"), F.lit("character"), F.array(F.lit("A"), F.lit("B")), F.col("contexts")).alias("prompt"))


# --- runs -----------------------------------------------------------------------------------------------


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(coalesce(sum(event_id) FILTER (event_type = 'click'), 0) AS BIGINT) AS click, CAST(coalesce(sum(event_id) FILTER (event_type = 'error'), 0) AS BIGINT) AS error, CAST(0 AS BIGINT) AS none FROM events WHERE event_type IN ('click', 'error') GROUP BY 1")
def run_summary(spark, sf_dir):
    return telemetry.run_summary(_metrics(spark, sf_dir).withColumn("value", F.col("event_id")), ["click", "error", "none"])


@query("""
WITH r AS (SELECT user_id, event_type, epoch_us(ts) AS us, event_id % 120 AS c, user_id % 101 AS t FROM events), l AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM r)
SELECT 'overflow' AS kind, CAST(user_id AS VARCHAR) AS run_id, event_type AS stage, us FROM r WHERE t > 0 AND c > t UNION ALL SELECT 'silent', CAST(user_id AS VARCHAR), event_type, us FROM l WHERE gap > 60 * 1000000
""")
def progress_warnings(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 120).alias("current"), (F.col("user_id") % 101).alias("total"))
    return telemetry.warnings(rows).select("kind", "run_id", "stage", F.unix_micros("ts").alias("us"))


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END AS prompt_preview, source AS response_preview, CAST(length(text) AS INTEGER) AS prompt_length, CAST(length(source) AS INTEGER) AS response_length FROM documents")
def call_previews(spark, sf_dir):
    calls = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"), F.col("source").alias("response"))
    return telemetry.call_previews(calls).drop("prompt", "response")


@query("SELECT CAST(doc_id AS VARCHAR) AS book_id, CAST(coalesce(quality, 0) AS INTEGER) AS entities_extracted FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)")
def registry_counts(spark, sf_dir):
    records = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("book_id"), F.col("source").alias("title"), F.lit("").alias("author"), F.lit("").alias("file_path"), text.content_hash(F.col("text")).alias("content_hash"), F.lit(1).alias("chapters"))
    counts = _t(spark, sf_dir, "labels").groupBy(F.col("doc_id").cast("string").alias("book_id")).agg(F.max("quality").alias("n"))
    return state.update_counts(state.book_records(records), counts).select("book_id", "entities_extracted")


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0)")
def registry_by_hash(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))
    return state.by_hash(d, d.where("doc_id % 10 = 0")).select("doc_id", "content_hash")


@query("SELECT source, CAST(count(*) FILTER (lang = 'en') AS DOUBLE) / count(*) * 100 AS pct, 0.0::DOUBLE AS none FROM documents GROUP BY 1")
def checkpoint_percent(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("done"), F.count("*").alias("total"))
    return d.select("source", state.progress_percent(F.col("done"), F.col("total")).alias("pct"), state.progress_percent(F.col("done"), F.lit(0)).alias("none"))


@query("SELECT book_id, chapter_index, name, CAST(count(*) AS BIGINT) AS n FROM (SELECT source AS book_id, CAST(doc_id AS INTEGER) AS chapter_index, unnest(list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda x: regexp_matches(x, '^[A-Z][a-z]{2,}$'))) AS name FROM documents) GROUP BY 1, 2, 3")
def resumed_extraction(spark, sf_dir):
    """A run that ended after half of the chapters, and one that takes up the rest; no chapter comes twice."""
    chapters = _t(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("chapter_index"), F.lit("t").alias("chapter_title"), F.col("text").alias("content"))
    store = new_folder(spark, "store")
    for part in (chapters.where("chapter_index % 2 = 0"), chapters):
        found = books.extract_chapters(part, extract.Capitalized(), store, size=1 << 30, overlap=0)
    return found.groupBy("book_id", "chapter_index", "name").agg(F.count("*").alias("n"))


def _streamed(spark: SparkSession, sf_dir: str, counted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The end of a stream over the events."""
    at = new_folder(spark, "stream")
    rows = spark.readStream.schema(_t(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events*.parquet")
    shaped = rows.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"), F.round(F.col("value") * 100).cast("long").alias("value"), F.col("user_id").cast("string").alias("run_id"))
    keep = lambda df, number: df.write.mode("overwrite").parquet(f"{at}/out")
    counted(shaped).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("SELECT event_type AS name, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS hour, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1, 2")
def stream_counters(spark, sf_dir):
    out = _streamed(spark, sf_dir, feeds.counters)
    return out.select("name", F.expr("unix_micros(window.start) div 3600000000").alias("hour"), "total")


@query("""
WITH l AS (SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS earlier FROM events), s AS (SELECT user_id, us, sum(CASE WHEN earlier IS NULL OR us - earlier >= 3600 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us) AS n FROM l)
SELECT CAST(user_id AS VARCHAR) AS run_id, min(us) AS began, count(*) AS events FROM s GROUP BY user_id, n
""")
def stream_spells(spark, sf_dir):
    out = _streamed(spark, sf_dir, lambda df: feeds.active_spells(df, gap=3600))
    return out.select("run_id", F.unix_micros("session_window.start").alias("began"), "events")


@query("WITH t AS (SELECT source AS book_id, doc_id, " + _TEXT_SQL.format(t="'Head ' || doc_id || chr(10) || chr(10) || trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))") + r""" AS content FROM documents)
SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY doc_id) - 1 AS INTEGER) AS chapter_index, CASE WHEN doc_id % 2 = 0 THEN 'Head ' || doc_id ELSE 'Item' END AS chapter_title, sha256(content) AS h,
CAST(len(list_filter(string_split_regex(content, '\s+'), lambda x: x <> '')) AS INTEGER) AS word_count FROM t WHERE length(content) >= 100
""")
def chapters_from_html(spark, sf_dir):
    """Documents as files of a book, with menus and styles that leave."""
    escaped = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>T</title><style>p{}</style></head><body><nav><p>menu</p></nav><h1>Head "), F.col("doc_id").cast("string"), F.lit("</h1><p>"), escaped, F.lit("</p><footer>end</footer></body></html>"))
    items = _t(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 2 == 1, "Item").otherwise("").alias("item_title"), page.alias("html"))
    return html.chapters_from_html(items).select("book_id", "chapter_index", "chapter_title", F.sha2("content", 256).alias("h"), "word_count")


# --- pages ----------------------------------------------------------------------------------------------


@query()
def html_text(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", html.html_to_text("html").alias("text"))


_HEAD_SQL = r"trim(replace(replace(replace(replace(regexp_extract(html, '(?s)<{e}[^>]*>(.*?)</{e}>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'))"


@query(f"""SELECT page_id, CASE WHEN length({_HEAD_SQL.format(e='h1')}) BETWEEN 1 AND 99 THEN {_HEAD_SQL.format(e='h1')} WHEN length({_HEAD_SQL.format(e='title')}) BETWEEN 1 AND 99 THEN {_HEAD_SQL.format(e='title')} ELSE 'Chapter ' || page_id + 1 END AS title FROM pages""")
def chapter_title(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", html.chapter_title(F.lit(None).cast("string"), F.col("html"), F.col("page_id")).alias("title"))


# --- everything: documents are chapters of the books that their sources are ------------------------------


@query("WITH " + _chunks_sql(_TEXT_SQL.format(t="text"), T.CHUNK_SIZE, T.CHUNK_OVERLAP) + """,
m AS (SELECT DISTINCT source AS book_id, doc_id, i, 'character:' || lower(unnest(list_filter(string_split_regex(chunk, '[^A-Za-z]+'), lambda x: regexp_matches(x, '^[A-Z][a-z]{2,}$')))) AS e FROM c JOIN documents USING (doc_id) WHERE chunk IS NOT NULL)
SELECT a.book_id, a.e AS source, b.e AS target, count(*) AS weight FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.i = b.i AND a.e < b.e GROUP BY 1, 2, 3 HAVING count(*) >= 2
""")
def entity_graph(spark, sf_dir):
    """Chunks, mentions, merge and edges over all documents; the flagship."""
    chapters = _t(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("chapter_index"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("chapter_title"), text.normalize_text(F.col("text")).alias("content"))
    cut = extract.keyed(chunking.explode_chunks(chapters))
    found = extract.mentions(cut, extract.extract(cut, extract.Capitalized()))
    index = found.select("book_id", F.concat_ws(":", "entity_type", F.lower("name")).alias("entity"), F.col("chunk_id").alias("chunk"))
    return graph.connections(index, 2, ["book_id"])


@query()
def book_entities(spark, sf_dir):
    """The whole plan with fuzzy resolution over the conversations as books."""
    chapters = _t(spark, sf_dir, "conversations").select(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("book_id"), F.col("turn").cast("int").alias("chapter_index"), F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("chapter_title"), F.col("text").alias("content"))
    return books.build_graph(chapters).entities.select("book_id", "entity_id", "name", "entity_type", "first_appearance", "occurrence_count")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
