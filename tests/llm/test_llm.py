"""Each operator against brute force or a round trip, and on odd tables: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import DATA, duck_rows, rows
from pyspark.sql import functions as F

from loregraph.llm import exact_dedup, html_extract, licenses, maxscore, mixing, near_dedup, pii, queries, toxicity, unigram, warc

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Columns with the names that operators use inside.
CLASH = ("digest", "of", "key", "v", "n", "rep", "set_key", "root", "part", "units", "h", "score", "pii", "ids", "sha1", "last", "shard", "copies", "lang", "_copy", "_score", "_copies", "_id", "row", "id", "rank", "all", "stays", "text_key", "in_part")


def docs(spark, data, clash=True):
    df = spark.createDataFrame([(i, t, s) for i, t, s in data], "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(1) for c in CLASH}) if clash else df


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


ODD = [(0, "one two three four", "a"), (1, None, "a"), (2, "", "b"), (3, "one  two\tthree four", None), (None, "one two three four", "b"), (5, "x" * 20_000, "b"), (6, "w " * 30_000, "a"), (7, "one two three four", "a"), (7, "one two three four", "a"), (8, "   ", "a")]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    names, expected = duck_rows(duck, queries.oracle_sql()[name])
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == names
    assert rows(df) == expected


# --- 1 -------------------------------------------------------------------------------------------------


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_brute(data, k, percent):
    sets = {i: shingles(t, k) for i, t in data if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for p, i in enumerate(ids):
        for j in ids[p + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_of_the_table(spark, k, percent):
    d = table(spark, "documents")
    expected = near_brute([(r["doc_id"], r["text"]) for r in d.collect()], k, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(d, k, percent).collect()}
    assert got == expected
    assert len({c for _, c in got.values()}) < len(got)


def test_near_duplicates_of_a_large_group(spark):
    """A bucket larger than SMALL: variants of one text, chains that only link over others, and texts that
    share a passage without being near."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    data = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        data.append((i, " ".join(w)))
    chain = [word() for _ in range(100)]
    for i in range(30):
        chain = chain[3:] + [word() for _ in range(3)]
        data.append((100 + i, " ".join(chain)))
    passage = [word() for _ in range(60)]
    data += [(200 + i, " ".join(passage + [word() for _ in range(50)])) for i in range(40)]
    data += [(300 + i, "short text here") for i in range(5)] + [(310, "Short  TEXT here"), (311, "short text"), (312, None), (313, ""), (314, None)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs(spark, [(i, t, "s") for i, t in data]), 3, 85).collect()}
    assert got == near_brute(data, 3, 85)


def test_near_duplicates_odd(spark):
    got = near_dedup.near_duplicates(docs(spark, ODD), 3, 85).collect()
    assert len(got) == len(ODD)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(0, 0, True), (1, 1, True), (2, 2, True), (3, 0, False), (None, 0, False), (5, 5, True), (6, 6, True), (7, 0, False), (8, 8, True)}
    assert near_dedup.near_duplicates(docs(spark, []), 3, 85).count() == 0
    kept = near_dedup.drop_near_copies(docs(spark, ODD), 3, 85)
    assert "digest" in kept.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted([(False, 0), (False, 1), (False, 2), (False, 5), (False, 6), (False, 8)])
    assert near_dedup.drop_near_copies(docs(spark, []), 3, 85).count() == 0


#: doc_ids that repeat with different texts, and rows without one.
REPEATED = [(3, "b c d e f", "s"), (5, "a x y z", "s"), (5, "b c d e f", "s"), (None, "q r s t", "s"), (None, "q r s t", "s"), (9, "a x y z", "t"), (9, "own text of nine", "t"), (None, None, "s"), (None, "", "t")]


def test_rows_are_told_apart_by_more_than_ids(spark):
    """No text is lost, and each stays once, under the least doc_id."""
    texts = lambda df: sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in df.collect()), key=repr)
    stay = [(False, 3, "b c d e f"), (False, 5, "a x y z"), (False, 9, "own text of nine"), (True, 0, "q r s t")]
    for order in (REPEATED, REPEATED[::-1]):
        got = exact_dedup.drop_copies(docs(spark, order))
        assert [x for x in texts(got) if x[2]] == stay
        assert got.count() == len(stay) + 1
        got = near_dedup.drop_near_copies(docs(spark, order), 3, 85)
        assert [x for x in texts(got) if x[2]] == stay
        assert got.count() == len(stay) + 2  # texts without words are linked with nothing
        assert got.columns == docs(spark, order).columns
    near = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs(spark, REPEATED), 3, 85).collect()}
    assert {(5, 2, 5, True), (5, 3, 3, False), (None, 2, None, True), (9, 2, 5, False), (9, 2, 9, True)} <= near


def test_mixing_of_repeated_rows(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, 1, 2, i]), "w " * rng.choice([1, 5, i % 7]), rng.choice(["a", "b", None])) for i in range(300)] + [(None, "one two", "b")] * 50
    plan = mixing.mix(docs(spark, data)).collect()
    many = mixing.mixed(docs(spark, data)).collect()
    taken, got = defaultdict(int), defaultdict(int)
    for r in plan:
        taken[r["doc_id"], r["size"]] += r["taken"]
    for r in many:
        got[r["doc_id"], len(r["text"].split())] += len(r["text"].split())
    assert {k: x for k, x in got.items() if x} == {k: x for k, x in taken.items() if x}
    assert len(many) == sum(r["copies"] for r in plan)
    assert mixing.mixed(docs(spark, [])).count() == 0
    assert mixing.mixed(docs(spark, data)).columns == docs(spark, data).columns


@pytest.mark.parametrize("percent", [80, 85])
def test_estimates_lose_no_more_than_stated(percent):
    """A pair at the threshold, by the exact binomial tail, through bands and the cut on estimates."""
    total, t = near_dedup.bands_for(percent) * near_dedup.ROWS, percent / 100
    least = near_dedup._least(percent, total)
    for n, m in ((1000, 1000), (1000, 850)):
        c = float(near_dedup.chance(np.array([n]), np.array([m]))[0])
        p = t + (1 - t) * c
        passes = near_dedup.estimate(np.arange(total + 1), total, np.array([n]), np.array([m])) >= least
        lost = sum(math.comb(total, x) * p**x * (1 - p) ** (total - x) for x in range(total + 1) if not passes[x])
        assert 0 < lost + (1 - t**near_dedup.ROWS) ** (total // near_dedup.ROWS) <= near_dedup.MISS


def test_sketch_estimate():
    rng = np.random.default_rng(4)
    for j in (0.2, 0.5, 0.85):
        n = 2000
        common = rng.integers(0, 2**63, int(2 * n * j / (1 + j))).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, n - len(common)).astype(np.uint64)])) for _ in "ab")
        regs = near_dedup.registers([near_dedup._mix(a), near_dedup._mix(b)], 600)
        est = near_dedup.estimate(np.array([(regs[0] == regs[1]).sum()]), 600, np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - j) < 0.08
    disjoint = near_dedup.registers([near_dedup._mix(rng.integers(0, 2**63, 500).astype(np.uint64)) for _ in range(60)], 500)
    equal = np.mean([(disjoint[2 * i] == disjoint[2 * i + 1]).mean() for i in range(30)])
    assert equal < 4 * near_dedup.chance(np.array([500]), np.array([500]))[0] + 1e-3


# --- 2 -------------------------------------------------------------------------------------------------


def test_main_text(spark):
    page = (
        '<html><head><title>x</title><script>var a="</p>";</script><style>p{}</style></head><body><header><h1>Site name, a long one.</h1></header><nav><a href="/">Home</a></nav>'
        '<div class="sidebar"><p>Read also, please. This is long text, with marks, and more of it.</p></div><div class="cookie-notice">We use cookies, accept. them.</div>'
        "<article><h1>Title &amp; more</h1><p>First <b>pa</b>ra &lt;1&gt;,\n with   marks.<p>Second, open paragraph.<ul><li>item one</li><li>item two</li></ul>"
        '<form><input name="q"> Subscribe, now.</form><div class="ad">Buy, now. Buy, buy.</div><p>Third&nbsp;one &#233;.</p><div class="comments"><p>Nice article, thanks. I liked it, really.</p></div></article>'
        "<footer>&copy; all rights, reserved.</footer></body></html>"
    )
    assert html_extract.extract(page) == "Title & more First para <1>, with marks. Second, open paragraph. item one item two Third one é."
    soup = '<div id="nav"><a>One</a><a>Two</a></div><div><div><p>Long text, with marks; and more. And more text, more.</p><p>More long text, with marks; it goes on.</p></div><div><a>x</a> <a>y</a></div></div>'
    assert html_extract.extract(soup) == "Long text, with marks; and more. And more text, more. More long text, with marks; it goes on."
    for odd in (None, "", "   ", "<", "<p", "<!-- x", "<script>x", "<nav>only</nav>"):
        assert html_extract.extract(odd) in ("", "<", "<p")
    df = spark.createDataFrame([(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "u", None)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(map(repr, html_extract.main_text(df).collect())) == sorted(["Row(page_id=1, url=None, text='a', n_chars=1)"] * 2 + ["Row(page_id=None, url='u', text='', n_chars=0)"])
    assert html_extract.main_text(df.where("false")).count() == 0


def test_main_text_of_marked_wrappers():
    text = "Long text, with marks; and more. And more text, more."
    for outer in ("content no-sidebar", "has-banner", "layout-with-comments", "page hide-menu", "banner", "content-sidebar", "widget"):
        assert html_extract.extract(f'<div class="{outer}"><article><p>{text}</p></article></div>') == text
        assert html_extract.extract(f'<div class="{outer}"><p>{text}</p><p>{text}</p></div>') == f"{text} {text}"
    for part in ('<section id="related-work"><p>{}</p></section>', '<h2 id="social-context">{}</h2>', '<h2 id="baking-cookies">{}</h2>', '<h2 id="cookies">{}</h2>'):
        assert html_extract.extract(f"<article><p>{text}</p>{part.format(text)}</article>") == f"{text} {text}"
    for junk in ('class="share-buttons"', 'id="comments"', 'class="box related-posts"', 'class="ad-300x250"', 'class="site-footer"'):
        assert html_extract.extract(f"<article><p>{text}</p></article><div {junk}><article>{text}</article></div>") == text
        assert html_extract.extract(f"<article><p>{text}</p><div {junk}>{text}</div></article>") == text


def test_main_text_outside_of_the_container():
    p = "A paragraph, with marks; and more. And more text, more. It goes on, and on, to a hundred characters."
    ten = "<p>{}</p>".format(p) * 10
    body = " ".join([p] * 10)
    assert html_extract.extract(f"<body><h1>Title</h1><p>Lead, {p}</p><div>{ten}</div></body>") == f"Title Lead, {p} {body}"
    assert html_extract.extract(f"<div>{ten}</div><div><p>Last, {p}</p></div>") == f"{body} Last, {p}"
    assert html_extract.extract(f"<article>{ten}</article><article><p>Last, <b>not</b> {p}</p></article>") == f"{body} Last, not {p}"
    assert html_extract.extract(f"<div>{ten}</div><div><a>x</a> <a>y</a></div>") == body


def test_main_text_by_ratios_alone(monkeypatch):
    """Pages of div elements without classes: paths' ratios tell the article from menu, teasers and footer."""
    p = "A paragraph of the article, with marks; and more of it. It goes on, and on, to a hundred characters."
    menu = "".join(f'<a href="/{i}">Entry {i}</a> ' for i in range(12))
    page = f"<div><div>{menu}</div><div><h1>Title</h1>{'<p>' + p + '</p>'}{'<p>' + p + '</p>'}<p>Short.</p>{'<p>' + p + '</p>'}</div><div><div><a>More</a></div><div><a>Top</a></div></div><div>Imprint</div></div>"
    expected = f"Title {p} {p} Short. {p}"
    assert html_extract.extract(page) == expected
    monkeypatch.setattr(html_extract, "chosen_paths", lambda paths, full, length, marks: full.copy())
    assert html_extract.extract(page) != expected


def test_main_text_keeps_article_parts_with_marked_words():
    text = "Long text, with marks; and more. And more text, more."
    for part in ('<div class="share-price-table">{}</div>', '<p id="reply-of-king">{}</p>', '<p class="ad-hoc-query">{}</p>', '<ul class="menu-items-of-the-inn"><li>{}</li></ul>'):
        for outer in ("article", "div"):
            assert html_extract.extract(f"<{outer}><p>{text}</p>{part.format(text)}<p>{text}</p></{outer}>") == f"{text} {text} {text}"


def test_main_text_of_deep_pages():
    """Memory grows with the number of elements, not with their depth; so does time."""
    import time
    import tracemalloc

    size = {}
    for n in (25_000, 100_000):
        page = "<div>" * n + "<p>Deep text, with marks; and more.</p>" + "</x></b>" * n
        tracemalloc.start()
        began = time.time()
        assert html_extract.extract(page) == "Deep text, with marks; and more."
        size[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert time.time() - began < 60
    assert size[100_000] < 6 * size[25_000]
    assert size[100_000] < 400e6


def test_main_text_of_the_table(spark):
    """The table's articles are in <article>; a cut with plain tools gives the same text."""
    import html

    for r in html_extract.main_text(table(spark, "pages")).join(table(spark, "pages").select("page_id", "html"), "page_id").collect():
        body = r["html"].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        assert r["text"] == " ".join(html.unescape(re.sub(r"</?b>", "", body) and re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())
        assert r["n_chars"] == len(r["text"])


# --- 3 -------------------------------------------------------------------------------------------------


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (5000, 4)).astype(np.uint64)
    mph = exact_dedup.PerfectHash.load(*exact_dedup.PerfectHash.build(keys).dump())
    assert sorted(mph.slots(keys)) == list(range(5000))
    assert len(exact_dedup.PerfectHash.build(keys[:0]).slots(keys)) == 5000
    with pytest.raises(ValueError, match="distinct"):
        exact_dedup.PerfectHash.build(keys[[0, 0]])


def test_exact_dedup_odd(spark):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, _ in ODD:
        groups[norm(t)].append(i)
    expected = []
    for i, t, _ in ODD:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        expected.append((i, keep, len(groups[norm(t)]), i == keep if keep is not None else True, hashlib.sha256(norm(t).encode()).hexdigest()))
    expected = [(i, k, n, bool(x) if i is not None else k is None, h) for i, k, n, x, h in expected]
    for order in (ODD, ODD[::-1]):
        assert sorted(map(repr, map(tuple, exact_dedup.exact_dedup(docs(spark, order)).collect()))) == sorted(map(repr, expected))
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    assert "digest" in exact_dedup.drop_copies(docs(spark, ODD)).columns


def test_exact_dedup_with_history(spark):
    seen = docs(spark, [(100, "old text", "a")]).select(exact_dedup.digest(F.col("text")).alias("digest"), F.lit(-5).cast("long").alias("locator"))
    got = exact_dedup.exact_dedup(docs(spark, [(1, "old  text", "a"), (2, "new", "a"), (3, "new", "b")]), seen)
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in got.collect()} == {(1, -5, False), (2, 2, True), (3, 2, False)}


def test_exact_dedup_by_lookup(spark, monkeypatch):
    data = docs(spark, [(1, "a", "s"), (2, "b", "s"), (9, "a", "s"), (10, "c", "s"), (8, "c", "s")])
    keep = lambda seen=None: {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(data, seen).collect()}
    assert keep() == {1: 1, 2: 2, 9: 1, 10: 8, 8: 8}
    seen = data.where("doc_id = 1").select(exact_dedup.digest(F.col("text")).alias("digest"), F.lit(100).cast("long").alias("locator"))
    assert keep(seen) == {1: 100, 2: 2, 9: 100, 10: 8, 8: 8}
    monkeypatch.setattr(exact_dedup, "lookup", lambda distinct, index, count: distinct.withColumn("locator", F.lit(None).cast("long")))
    assert keep() == {1: 9, 2: None, 9: 9, 10: 8, 8: 8}  # without the index members have no winner


# --- 4 -------------------------------------------------------------------------------------------------


def test_maxscore_odd(spark):
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(150)]
    data += [(200 + i, [0.5] * 8, 1) for i in range(60)] + [(300, None, 1), (301, [1.0, None], 1), (302, [math.nan], 1), (303, [math.inf], 1), (None, [1.0], 1), (320, [1.0, 2.0], 1), (340, [], 1), (20, data[20][1], 1), (5, [3e9] * 8, 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in CLASH})
    clean = [(i, tuple(math.floor(64 * x) for x in v)) for i, v, _ in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, a in clean:
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in clean if i != q)[:20]
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = maxscore.top_k(df)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert maxscore.top_k(df.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["dense", "sparse", "skewed", "negative", "few"])
def test_maxscore_touches_few_postings(kind):
    """Results are brute force's; where bounds differ, most postings are never traversed."""
    rng = np.random.default_rng(8)
    n, dims = (12, 6) if kind == "few" else (4000, 48)
    m = rng.integers(-60, 61, (n, dims))
    if kind == "sparse":
        m[rng.random(m.shape) < 0.9] = 0
    if kind == "skewed":
        m = np.where(np.arange(dims) < 4, m * 40, m // 20)
    if kind == "negative":
        m[:, 0] = -5000
    shard = maxscore.Shard.of(rng.permutation(n).astype(np.int64) * 3, list(m))
    dense = np.zeros((n, dims), np.int64)
    for t in range(2 * dims):
        a, b = shard.start[t], shard.start[t + 1]
        dense[shard.where[a:b], t // 2] = shard.values[a:b]
    work, postings = maxscore.Work(), 0
    for q in range(0, n, max(1, n // 30)):
        query = np.abs(dense[q]) if kind == "negative" else dense[q]
        scores = dense @ query
        own = int(shard.ids[q])
        best = sorted((-int(s), int(i)) for s, i in zip(scores, shard.ids, strict=True) if i != own)[:20]
        assert maxscore.search(shard, query, own, 20, work) == [(i, -s) for s, i in best]
        postings += sum(int(shard.start[2 * t + 2] - shard.start[2 * t]) for t, x in enumerate(query) if x)
    assert work.traversed <= postings
    if kind == "skewed":
        assert work.traversed < 0.3 * postings
    if kind in ("dense", "sparse", "skewed"):
        assert work.candidates < 0.5 * n * 30
    if kind in ("dense", "skewed"):
        assert work.traversed + work.probed < 0.9 * postings


def test_maxscore_large_components(spark):
    data = [(20, [1e15, 1.0]), (1, [1.0, 0.0]), (2, [2e16, 0.0]), (3, [-1e15, 5.0]), (40, [-(2.0**57), 0.0])]
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = [data[0], data[1], (4, [0.0, 1.0])]
    whole = {i: [math.floor(64 * x) for x in v] for i, v in small}
    dot = lambda i: sum(x * y for x, y in zip(whole[20], whole[i], strict=True))
    assert sorted(map(tuple, maxscore.top_k(make(small)).collect())) == [(20, 1, 1, dot(1)), (20, 2, 4, dot(4))]
    assert {r["vec_id"] for r in maxscore.quantized(make(data)).collect()} == {20, 1, 2, 3, 40}
    with pytest.raises(Exception, match="doesn't fit a long"):
        maxscore.quantized(make([(1, [2.0**57])])).collect()


# --- 5 -------------------------------------------------------------------------------------------------


def luhn_ok(digits):
    s = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        s += d - 9 if d > 9 else d
    return s % 10 == 0


def pii_brute(text):
    t = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn_ok(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


PII_TEXTS = [
    None, "", "mail a.b@c.de and x@y, a@b.c.@d.e a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4 1.1.1.999", "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 5 4111111111111111", "4111111111111111 5500005555555559",
    "+1 (017) 555-7713 +12 +49 170 1234567890123456 ++1 234 567 890", "é😀 a@b.co 漢 10.0.0.1", "7" * 5000, "1 " * 3000, "x" * 30_000 + "@y.z", "a@b" + ".c" * 3000, "00000000000000 0-0-0-0-0-0-0-0-0-0-0-0-0",
]


def test_pii_base(spark):
    rng = random.Random(7)
    texts = PII_TEXTS + ["".join(rng.choice("01459 -.+@ab()") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    df = docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    for r in pii.pii_report(df).collect():
        base = pii_brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(x[0] == k for x in base) for k in ("email", "ip", "card", "phone")], texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)
    assert pii.pii_report(docs(spark, [])).count() == 0
    assert pii.pii_report(docs(spark, ODD)).count() == len(ODD)


def test_pii_in_time_of_the_texts_length(spark):
    """A text twice as long takes about twice the time; places and surroundings hold in long texts."""
    import time

    mail = lambda n: " ".join(f"write to a{i}@b.co or é 10.0.{i % 256}.1," for i in range(n))
    took = {}
    for n in (4_000, 8_000, 16_000):
        df = docs(spark, [(1, mail(n), "s")])
        pii.find_pii(df).select(F.size("pii")).collect()
        began = time.time()
        got = pii.find_pii(df).first()["pii"]
        took[n] = time.time() - began
        assert [(x["kind"], x["start"], x["end"]) for x in got] == pii_brute(mail(n))
        assert {x["score"] for x in got if x["kind"] == "email"} == {95}
    assert took[16_000] < 3.2 * took[8_000] + 1


def test_pii_added(spark):
    text = "My IBAN is DE89 3704 0044 0532 0130 00 or DE89 3704 0044 0532 0130 01, SSN 123-45-6789."
    far = "Nothing here says what it is: the part number is 123-45-6789."
    got = {r["doc_id"]: r["pii"] for r in pii.find_pii(docs(spark, [(1, text, "s"), (2, far, "s")], clash=False)).collect()}
    assert [(x["kind"], text[x["start"] : x["end"]]) for x in got[1]] == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    assert got[1][0]["score"] == 95
    assert got[2] == []


def test_pii_accounts_in_their_surroundings(spark):
    de, gb = "DE89370400440532013000", "GB82WEST12345698765432"
    spaced = "DE89 3704 0044 0532 0130 00"
    cases = {
        f"IBAN {de} BIC COBADEFFXXX": [de], f"Pay to {spaced} Thanks": [spaced], f"{gb} OK": [gb], f"{de} 2024": [de], f"{de}": [de], f"é {spaced} 2024 {gb} AND": [spaced, gb],
        f"BE12 {spaced}": [spaced], f"AB12 {de}": [de], f"{de} {gb}": [de, gb], f"NO93 8601 1117 947 {de}.": ["NO93 8601 1117 947", de], f"{de}X": [], f"X{de}": [], "DE89370400440532013001": [],
    }
    data = [(i, t, "s") for i, t in enumerate(cases)]
    got = {r["doc_id"]: [data[r["doc_id"]][1][x["start"] : x["end"]] for x in r["pii"] if x["kind"] == "iban"] for r in pii.find_pii(docs(spark, data, clash=False)).collect()}
    assert got == {i: found for i, found in enumerate(cases.values())}


# --- 6 -------------------------------------------------------------------------------------------------


def brute_best(text, pieces, floor):
    best = [(0.0)] + [-math.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            s = pieces.get(text[i:j], floor if j == i + 1 else -math.inf)
            best[j] = max(best[j], best[i] + s)
    return best[-1]


def test_unigram_viterbi():
    rng = random.Random(3)
    names = [unigram.MARK, *"abc", *{"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(40)}, unigram.MARK + "ab", unigram.MARK + "c"]
    v = unigram.Vocabulary(["<unk>", *names, *[f"<0x{i:02X}>" for i in range(256)]], [0.0, *[-rng.uniform(1, 9) for _ in names], *[0.0] * 256], "c" + "n" * len(names) + "b" * 256)
    u = unigram.Unigram(v)
    scores = dict(zip(names, v.scores[1:], strict=False))
    for _ in range(300):
        text = "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 14)))
        ids = u.encode(text)
        marked = unigram.MARK + text.replace(" ", unigram.MARK)
        total = sum(v.scores[i] for i in ids if v.kinds[i] == "n") + u.floor * sum(c == "é" for c in text)
        assert total == pytest.approx(brute_best(marked, scores, u.floor))
        assert u.decode(ids) == text
    keys = {bytes(rng.choice(b"ab\xff\x00") for _ in range(rng.randint(1, 5))): i for i in range(200)}
    trie = unigram.DoubleArray(keys)
    for _ in range(200):
        s = bytes(rng.choice(b"ab\xff\x00") for _ in range(8))
        assert list(trie.prefixes(s, 0)) == [(n, keys[s[:n]]) for n in range(1, 9) if s[:n] in keys]


def test_unigram_words_are_enough():
    u = unigram.Unigram(unigram.read_vocabulary(MODEL))
    assert u.splits
    for text in ("The quick  brown fox.", " lead", "naïve 漢字 \U0001f600\n\ttab", "a" * 300, "\x00 odd \x7f", "éèê ça"):
        ids = u.encode(text)
        assert list(ids) == u.viterbi(unigram.MARK + text.replace(" ", unigram.MARK))
        assert u.decode(ids) == text


def test_vocabularies_are_told_apart():
    """Two vocabularies of equal size, kinds, last piece and middle score in one worker."""

    class Sent:
        def __init__(self, value):
            self.value = value

    make = lambda *names: unigram.Vocabulary(["<unk>", *names], [0.0, -1.0, -2.0, -3.0], "cnnn")
    one, two = unigram._tokenizer(Sent(make("a", "b", "c"))), unigram._tokenizer(Sent(make("b", "a", "c")))
    assert one is not two
    assert one is unigram._tokenizer(Sent(make("a", "b", "c")))


def test_unigram_of_the_table(spark):
    """The whole vocabulary over the table against another implementation: plain dynamic programming over a
    dictionary of pieces, on whole texts. Ids may differ only where scores are equal."""
    v = unigram.read_vocabulary(MODEL)
    u = unigram.Unigram(v)
    pieces = {p: v.scores[i] for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True)) if k == "n"}
    longest = max(map(len, pieces))
    for r in table(spark, "documents").orderBy("doc_id").collect():
        text = unigram.MARK + r["text"].replace(" ", unigram.MARK)
        best = [0.0] + [-math.inf] * len(text)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + longest) + 1):
                s = pieces.get(text[i:j])
                if s is not None and best[i] + s > best[j]:
                    best[j] = best[i] + s
            if text[i] not in pieces and best[i] + u.floor > best[i + 1]:
                best[i + 1] = best[i] + u.floor
        ids = u.encode(r["text"])
        got, at = 0.0, 0
        raw = [v.pieces[i] if v.kinds[i] == "n" else None for i in ids]
        while at < len(raw):
            if raw[at] is None:  # the bytes of one character
                lead = int(v.pieces[ids[at]][3:5], 16)
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                got += u.floor
            else:
                got += v.scores[ids[at]]
                at += 1
        assert got == pytest.approx(best[-1], rel=1e-9)
        assert u.decode(ids) == r["text"]


def test_tokens_odd(spark):
    got = unigram.token_report(docs(spark, ODD), MODEL).collect()
    assert len(got) == len(ODD)
    assert all(r["round_trip"] for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert unigram.token_report(docs(spark, []), MODEL).count() == 0
    both = unigram.decode(unigram.encode(docs(spark, ODD, clash=False), MODEL), MODEL).collect()
    assert all(r["text"] == r["decoded"] for r in both)


# --- 7 -------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    sf = DATA.replace("sf0.001", "sf0.01")
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 80
    right = sum(r["predicted"] == r["toxic"] for r in got) / len(got)
    assert right >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_label_model():
    """From votes alone: the good voters are told from a weak one that three others copy."""
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.3
    flip = lambda a: np.where(rng.random(6000) < a, np.where(y, 1, -1), np.where(y, -1, 1))
    good, weak = [flip(0.92), flip(0.9), flip(0.88), flip(0.85)], flip(0.6)
    copied = [np.where(rng.random(6000) < 0.9, weak, -weak) for _ in range(2)]
    v = np.stack([*good, weak, *copied], axis=1).astype(np.int8)
    v[rng.random(v.shape) < 0.1] = 0
    post, acc, rho = toxicity.label_model(v, 0.3)
    assert ((post > 0.5) == y).mean() > 0.93
    assert rho[5, 6] > 0.4
    assert abs(rho[0, 1]) < 0.2
    right = acc[:, 1, 2] / (acc[:, 1, 0] + acc[:, 1, 2])
    assert min(right[:4]) > max(right[4:])


def test_toxicity_learns_from_votes_and_not_from_labels(spark, monkeypatch):
    """The label model gets votes and the labels' share; what it says is what the classifier learns."""
    seen = {}
    model, learn = toxicity.label_model, toxicity.logistic
    monkeypatch.setattr(toxicity, "label_model", lambda v, prior: seen.setdefault("out", model(v, prior)))
    monkeypatch.setattr(toxicity, "logistic", lambda present, target, width: learn(present, seen.setdefault("target", target), width))
    sf = DATA.replace("sf0.001", "sf0.01")
    toxicity.fit(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")))
    assert seen["target"] is seen["out"][0]


def test_toxicity_odd(spark):
    labels = spark.createDataFrame([(0, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    data = [*ODD, (20, "you stupid idiot, worthless scum", "a")]
    got = toxicity.toxicity(docs(spark, data), labels).collect()
    assert len(got) == len(data)
    assert [r["doc_id"] for r in got if r["predicted"]] == [20]
    assert toxicity.toxicity(docs(spark, []), labels.where("false")).count() == 0
    assert "digest" in toxicity.drop_toxic(docs(spark, data), labels).columns


# --- 8 -------------------------------------------------------------------------------------------------


def targets_brute(sizes, cap=3):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        w = sum(weight[s] for s in sizes if s not in fixed)
        share = {s: left * weight[s] / w for s in sizes if s not in fixed}
        over = {s: cap * sizes[s] for s in share if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= over


def test_mixing(spark):
    rng = random.Random(9)
    data = [(i, "w " * rng.randint(0, 200), rng.choice(["é", "a", "z", "B", None, "tiny"]) if i % 3 else "hot") for i in range(900)]
    data += [(2000 + i, "x y", "tiny2") for i in range(3)] + [(3000, None, "none")]
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len((t or "").split())
    got = mixing.mix(docs(spark, data)).collect()
    assert len(got) == len(data)
    source = {i: s for i, _, s in data}
    goal = targets_brute(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["copies"] * r["size"]
        assert r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(goal[source[r["doc_id"]]])
        taken[source[r["doc_id"]]] += r["taken"]
    for s, g in goal.items():
        assert abs(taken[s] - g) <= max(0.02 * g, 4), s
    again = mixing.mix(docs(spark, data[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    many = mixing.mixed(docs(spark, data))
    assert many.count() == sum(r["copies"] for r in got)


def test_mixing_odd(spark):
    assert mixing.mix(docs(spark, ODD)).count() == len(ODD)
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


# --- 9 -------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    data = [(i, f"http://x/{i} y", "é" * (i % 5) + "page") for i in range(40)] + [(50, None, None), (51, "u", ""), (60, "u", "b" * 300_000), (61, "u\r\nX: y", "b" * 300_000), (None, "u", "page"), (None, "u", "alone"), (None, "v", "alone"), (39, "again", "éééépage")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("last", F.lit(1)).withColumn("sha1", F.lit(2))
    last: dict = {}
    for p, _, h in data:
        last[h or ""] = max(last.get(h or "", -1), -1 if p is None else p)
    data += [(70, "x", "again"), (70, "x", "again"), (70, "w", "again"), (69, "x", "again")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("last", F.lit(1)).withColumn("sha1", F.lit(2))
    last["again"] = 70
    expected, responded = [], set()
    for p, _, h in data:
        body = (h or "").encode()
        other = last[h or ""] if last[h or ""] >= 0 and (p != last[h or ""] or h in responded) else None
        if p == last[h or ""]:
            responded.add(h)
        expected.append((p, len(body), warc.sha1_base32(body), "response" if other is None else "revisit", other))
    got = warc.warc_round_trip(df)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    assert warc.warc_round_trip(df.where("false")).count() == 0
    least = {(r["page_id"], r["record_type"]) for r in warc.warc_round_trip(df, least=6).collect()}
    assert (0, "response") in least
    assert (4, "revisit") in least


def test_archive_frames():
    records = [warc.record(i, "u", b"<p>hello %d</p>" % i * 20, 20 * len(b"<p>hello %d</p>" % i), "X", None) for i in range(30)]
    records = [warc.record(i, "u", p := b"<p>hello %d</p>" % i * 20, len(p), warc.sha1_base32(p), None) for i in range(30)]
    packed = warc.archive(records)
    assert packed[:4] == b"\x5d\x2a\x4d\x18"
    assert warc.unpack(packed) == b"".join(records)
    assert len(packed) < len(b"".join(records))
    assert packed.count(b"\x28\xb5\x2f\xfd") >= 30
    with pytest.raises(ValueError, match="digest"):
        list(warc.parse(records[0].replace(b"hello 0", b"hallo 0")))


# --- 10 ------------------------------------------------------------------------------------------------


def test_licenses(spark):
    lines = {
        "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL", "Distributed under the terms of BSD-3-Clause.": "BSD",
        "My driver's license expired.": "", "All rights reserved. Ask for permission.": "", "Nothing here.": "",
    }
    data = [(i, f"Some words before.\nAnd more. {t} And words after.\nThe end.", "s") for i, t in enumerate(lines)]
    for r in licenses.license_report(docs(spark, data)).collect():
        line, family = list(lines.items())[r["doc_id"]]
        assert r["families"] == family
        if family:
            _, start, end = r["spans"].split(":")
            assert data[r["doc_id"]][1][int(start) : int(end)] == line
    assert licenses.license_report(docs(spark, ODD)).count() == len(ODD)
    assert licenses.license_report(docs(spark, [])).count() == 0


def test_licenses_without_licence_words_and_over_lines():
    model, templates = licenses.classifier(), licenses._templates()
    scan = lambda text: [(f, text[a:b]) for f, a, b, _, _ in licenses.scan_text(text, model, templates)]
    for line, family in {"Distributed under Apache 2.0.": "Apache-2.0", "Distributed under MIT.": "MIT", "Distributed under ISC.": "ISC"}.items():
        assert scan(f"Some words before.\n{line} And words after.") == [(family, line)]
    for family, notices in licenses.TEMPLATES.items():
        for notice in (x for x in notices if len(x) > 100):
            words = notice.split(" ")
            for width in (3, 8):
                wrapped = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
                assert {f for f, _ in scan(f"A title\n\n{wrapped}\n\nOther words.")} - {"unknown"} == {family}, wrapped
    long = licenses.TEMPLATES["MIT"][1].replace(", to deal", ",\nto deal").replace("to any", "to\nany")
    assert scan(f"A title\n\n{long}.\n\nOther words.") == [("MIT", f"{long}.")]
    assert scan("License: MIT\nDocs licensed under CC BY-SA 4.0\n") == [("MIT", "License: MIT"), ("CC-BY-SA", "Docs licensed under CC BY-SA 4.0")]


def test_license_classifier_on_new_variations():
    m = licenses.classifier()
    held = licenses._variations(11, 1)
    assert sum(m.predict(w)[0] == f for f, w in held) / len(held) > 0.95
    assert sum(m.predict(w)[0] != "unknown" for f, w in held if f == "unknown") / sum(f == "unknown" for f, _ in held) < 0.03


def test_licenses_of_the_table(spark):
    """Every short notice that stands in the table is found, and nothing else."""
    known = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL"}
    sf = DATA.replace("sf0.001", "sf0.01")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    for r in licenses.license_report(d).collect():
        assert r["families"] == ",".join(sorted({f for t, f in known.items() if t in texts[r["doc_id"]]}))
