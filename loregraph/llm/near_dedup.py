"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles. Each bucket of its sketch keeps, of the smallest
hash under that bucket's permutation, only the number of leading zeros and ten mantissa bits: 16 bits
instead of 64. Bands of these registers propose pairs; the share of equal registers, corrected for
registers that agree by chance, drops those far below the threshold; the rest is confirmed on full sets.
A full set holds 64-bit hashes of its shingles, distinct ones; two different shingles of a pair of sets of
10^4 share one with probability 3e-12.

How hot groups stay small: documents with equal sets are one class, and only classes meet. A band bucket
with more than ``SMALL`` classes first proposes only stars around one of them, the star's centre repeated
for so many of its rays. Then buckets that still hold several components are cut into tiles, where tiles
of one same component don't meet. Tiles compare registers; only classes with a likely partner in another
component fetch their sets and are confirmed, the likeliest first and only while their components are
apart. Nothing emits all pairs of a group, no bucket is capped, and no task holds a whole one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loregraph.operators.graph import components

from ._util import picked, table, text_key

#: Registers in a band. Bands and the cut on estimates together leave a pair at the threshold out once in
#: 1 / MISS cases at most.
ROWS, MISS = 5, 1e-7
#: Mantissa bits of a register, beside six bits of leading zeros.
MANTISSA = 10
#: Buckets up to this size propose all their pairs; a star's centre serves so many rays; tiles of larger
#: buckets hold about so many classes and shingles.
SMALL, RAYS, TILE, TILE_MASS = 8, 4096, 1024, 1_500_000

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C[1]
    h = (h ^ (h >> np.uint64(27))) * _C[2]
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words; forgets all of them when it gets large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, k: int, known: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``k`` words; fewer words are one shingle."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and just the white space meant here
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    s = np.full(n, np.uint64(min(k, len(h))), np.uint64)
    for i in range(min(k, len(h))):
        s = _mix(s * _C[0] + h[i : i + n])
    return np.unique(s)


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _C[0])
    return base[:n] | np.uint64(1), base[n:]


def registers(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(documents, n) registers of non-empty sets."""
    mult, add = _permutations(n)
    out = np.empty((len(sets), n), np.uint64)
    at = 0
    while at < len(sets):  # so many sets at a time that they stay in the processor's cache
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 60_000):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        start = np.cumsum([0] + [len(x) for x in sets[at : end - 1]])
        for j in range(n):
            out[at:end, j] = np.minimum.reduceat(flat * mult[j] + add[j], start)
        at = end
    zeros = np.clip(64 - np.frexp(out.astype(np.float64))[1], 0, 63).astype(np.uint64)
    mantissa = (out << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(documents, bands) keys; the band's number is part of its key."""
    bands = regs.shape[1] // ROWS
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _C[1], (len(regs), 1))
    for i in range(ROWS):
        key = _mix(key * _C[0] + regs[:, i::ROWS].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of these sizes agree: the mean over the smaller hash of
    a register's width, 1 / (2 ln 2) * 2**-bits * nm / (n + m)**2."""
    n, m = n.astype(float), m.astype(float)
    return 1 / (2 * math.log(2)) / (1 << MANTISSA) * n * m / (n + m) ** 2


def estimate(equal: np.ndarray, total: int, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, less those that agree by chance."""
    c = chance(n, m)
    return (equal / total - c) / (1 - c)


def _least(percent: int, total: int) -> float:
    """The estimate from which pairs go to verification: the exact binomial tail below it is what the bands
    leave of MISS."""
    t = percent / 100
    left = MISS - (1 - t**ROWS) ** (total // ROWS)
    exactly = lambda x: math.exp(math.lgamma(total + 1) - math.lgamma(x + 1) - math.lgamma(total - x + 1) + x * math.log(t) + (total - x) * math.log(1 - t))
    x, tail = 0, 0.0
    while (tail := tail + exactly(x)) <= left:
        x += 1
    most = float(chance(np.ones(1), np.ones(1))[0])  # registers that agree by chance lower no estimate further
    return (x / total - most) / (1 - most) - 1e-12


def sketch(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, text_key, n (set size), set_key (16 bytes, null for an empty set), regs (binary), bands."""
    n_regs = bands_for(percent) * ROWS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        known = _Words()
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                sets = [shingle_set(t, k, known) for t in part["text"]]
                regs = registers([s for s in sets if len(s)], n_regs)
                keys = band_keys(regs)
                rows, i = [], 0
                for s in sets:
                    if len(s):
                        rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), regs[i].tobytes(), keys[i]))
                        i += 1
                    else:
                        rows.append((0, None, None, None))
                out = pd.DataFrame(rows, columns=["n", "set_key", "regs", "bands"])
                out.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy())
                out.insert(1, "text_key", part["text_key"].to_numpy())
                yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInPandas(run, "doc_id long, text_key binary, n long, set_key binary, regs binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """v, shingles (the sorted set, eight bytes a shingle) of the classes ``wanted`` (v, rep: the document
    that stands for the class). Only those documents' texts are read into sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                yield pd.DataFrame({"v": part["v"].to_numpy(), "shingles": [shingle_set(t, k, known).tobytes() for t in part["text"]]})

    of = wanted.select("v", F.col("rep.doc_id").alias("w_id"), F.col("rep.text_key").alias("w_key"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_key(F.col("text")).alias("key"), "text")
    met = rows.join(of, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("key") == F.col("w_key")))
    return met.select("v", "text").mapInPandas(run, "v long, shingles binary").dropDuplicates(["v"])  # repeated rows


def _set(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint64)


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets: a common shingle is an equal neighbour in
    their merged order."""
    merged = np.sort(np.concatenate([p, q]), kind="stable")
    common = int((merged[1:] == merged[:-1]).sum())
    return 100 * common >= percent * (len(p) + len(q) - common)


def _met(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """``pairs`` (a, b, salt) with the columns of ``held`` (v, ...) for both, named by _a and _b. What many
    pairs have as their ``a`` is repeated once a salt."""
    rest = [c for c in held.columns if c != "v"]
    side = lambda s: held.select(F.col("v").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in rest])
    heads = pairs.select("a", "salt").distinct().join(side("a"), "a")
    return pairs.join(side("b"), "b").join(heads, ["a", "salt"])


def likely(pairs: DataFrame, sketches: DataFrame, percent: int, total: int) -> DataFrame:
    """The pairs (a, b, salt) whose corrected estimate is near the threshold or above."""
    # Sets whose sizes differ too much can't reach the threshold.
    both = _met(pairs, sketches.select("v", "n", "regs")).where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    least = _least(percent, total)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(-1, total) for c in ("regs_a", "regs_b"))
            ok = estimate((x == y).sum(1), total, pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy()) >= least
            yield pdf.loc[ok, ["a", "b", "salt"]]

    return both.select("a", "b", "salt", "n_a", "n_b", "regs_a", "regs_b").mapInPandas(run, "a long, b long, salt int")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [_similar(_set(p), _set(q), percent) for p, q in zip(pdf["shingles_a"], pdf["shingles_b"], strict=True)]
            yield pdf.loc[ok, ["a", "b"]]

    return _met(pairs, sets).select("a", "b", "shingles_a", "shingles_b").mapInPandas(run, "a long, b long")


def _unite(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _tiled(large: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``large`` (key, band, v: members of large buckets) as rows of tiles: key, i, j (the tile's two blocks),
    block (which of them the row is of), band, v, root. Only buckets with two components or more are left.
    A component with more than ``TILE`` classes or ``TILE_MASS`` shingles in a bucket has blocks of its own,
    the others share blocks; two blocks of one same component don't meet."""
    named = large.join(roots.select(F.col("v").alias("r_v"), "root"), F.col("v") == F.col("r_v"), "left")
    sized = named.join(classes.select(F.col("v").alias("c_v"), "n"), F.col("v") == F.col("c_v"))
    members = table(sized.select("key", "band", "v", "n", F.coalesce("root", "v").alias("root")))
    counts = members.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("n").alias("mass"))
    full = F.greatest(F.col("c") / TILE, F.col("mass") / TILE_MASS)
    # -1 names the blocks that small components share.
    grouped = counts.withColumn("g", F.when(full > 1, F.col("root")).otherwise(-1))
    blocks = (
        grouped.groupBy("key", "g").agg(F.sum("c").alias("c"), F.sum("mass").alias("mass"), F.count("*").alias("held")).withColumn("parts", F.ceil(full).cast("int"))
        .groupBy(F.col("key").alias("b_key")).agg(F.collect_list(F.struct("g", "parts")).alias("blocks"), F.sum("held").alias("held")).where("held > 1").drop("held")
    )
    placed = members.join(grouped.select(F.col("key").alias("g_key"), F.col("root").alias("g_root"), "g"), (F.col("key") == F.col("g_key")) & (F.col("root") == F.col("g_root")))
    own = F.expr("filter(blocks, x -> x.g = g)[0].parts")
    others = F.expr("flatten(transform(filter(blocks, x -> x.g <> g or g = -1), x -> transform(sequence(0, x.parts - 1), t -> struct(x.g as g, t as t))))")
    dealt = placed.join(blocks, F.col("key") == F.col("b_key")).withColumn("block", F.struct("g", F.pmod(F.xxhash64("v"), own).cast("int").alias("t")))
    return dealt.select("key", "band", "v", "root", "block", F.explode(others).alias("o")).select("key", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "band", "v", "root")


def _apart(pdf: pd.DataFrame, percent: int, total: int) -> list[tuple[float, int, int]]:
    """Likely pairs of a tile (estimate and two places), of different components, whose first common band
    is this bucket's."""
    least = _least(percent, total)
    at = [tuple(x.values()) if isinstance(x, dict) else tuple(x) for x in pdf["block"]]
    first = min(at, default=None)
    left, right = np.array([k for k, x in enumerate(at) if x == first], int), np.array([k for k, x in enumerate(at) if x != first], int)
    same_block = not len(right)
    if same_block:
        right = left
    if pdf["root"].nunique() < 2 or not len(left):
        return []
    regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(-1, total)
    n, root, band = pdf["n"].to_numpy(), pdf["root"].to_numpy(), int(pdf["band"].iloc[0])
    found: list[tuple[float, int, int]] = []
    for i in left:
        other = right[(root[right] != root[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent)]
        if same_block:
            other = other[other > i]
        if len(other):
            same = regs[other] == regs[i]
            here = same[:, : (band + 1) * ROWS].reshape(len(other), -1, ROWS).all(axis=2).argmax(axis=1) == band
            est = estimate(same.sum(1), total, np.full(len(other), n[i]), n[other])
            ok = here & (est >= least)
            found += zip(est[ok].tolist(), [int(i)] * int(ok.sum()), other[ok].tolist(), strict=True)
    return found


def _survivors(tiles: DataFrame, classes: DataFrame, percent: int, total: int) -> DataFrame:
    """key, i, j, block, band, v, root of the rows of tiles that have a likely partner in another component."""
    wide = tiles.join(classes.select(F.col("v").alias("c_v"), "n", "regs"), F.col("v") == F.col("c_v")).drop("c_v")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keep = sorted({x for _, i, j in _apart(pdf, percent, total) for x in (i, j)})
        return pdf.iloc[keep][["key", "i", "j", "block", "band", "v", "root"]]

    block = "struct<g:long,t:int>"
    return wide.groupBy("key", "i", "j").applyInPandas(run, f"key long, i {block}, j {block}, block {block}, band int, v long, root long")


def _tile_links(left: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, total: int) -> DataFrame:
    """Confirmed links (a, b) that join components within tiles; ``left``: survivors. Pairs are confirmed
    the likeliest first and only while their components are apart in the tile, so a tile gives fewer links
    than it has components, and leaves out none that would join two of them."""
    held = classes.select(F.col("v").alias("c_v"), "n", "regs").join(sets.select(F.col("v").alias("s_v"), "shingles"), F.col("c_v") == F.col("s_v")).drop("s_v")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v, root = pdf["v"].to_numpy(), pdf["root"].to_numpy()
        links: list[tuple[int, int]] = []
        parent: dict[int, int] = {}
        for _, i, j in sorted(_apart(pdf, percent, total), reverse=True):
            x, y = _unite(parent, int(root[i])), _unite(parent, int(root[j]))
            if x != y and _similar(_set(pdf["shingles"].iat[i]), _set(pdf["shingles"].iat[j]), percent):
                parent[max(x, y)] = min(x, y)
                links.append((int(min(v[i], v[j])), int(max(v[i], v[j]))))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return left.join(held, F.col("v") == F.col("c_v")).drop("c_v").groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, text_key, n, set_key), and for each set_key (as ``of``) the document that
    stays of its component: ``stays`` (no_id, doc_id, text_key), the one with the smallest doc_id."""
    total = bands_for(percent) * ROWS
    all_docs = table(sketch(docs, k, percent))
    # One class of equal sets, numbered; its number means nothing beyond this run.
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    grouped = all_docs.where("n > 0").groupBy("set_key").agg(rep.alias("rep"), F.first(F.struct("n", "regs", "bands")).alias("s"))
    classes = table(grouped.select(F.monotonically_increasing_id().alias("v"), "set_key", "rep", "s.n", "s.regs", "s.bands"))
    rows = classes.select("v", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n_key"), F.min("v").alias("hub")).where("n_key > 1")
    shared = table(rows.join(buckets, F.col("key") == F.col("of")).select("key", "band", "v", "n_key", "hub"))

    few = shared.where(F.col("n_key") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    pairs = few.select(F.explode(F.expr("flatten(transform(vs, (x, i) -> transform(slice(vs, i + 2, size(vs)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b", F.lit(0).alias("salt"))
    large = shared.where(F.col("n_key") > SMALL)
    stars = large.where("v <> hub").select(F.col("hub").alias("a"), F.col("v").alias("b"), F.pmod(F.xxhash64("v"), F.ceil(F.col("n_key") / RAYS)).cast("int").alias("salt"))
    first = table(likely(pairs.unionByName(stars).distinct(), classes, percent, total))
    ends = first.select(F.col("a").alias("w")).union(first.select("b")).distinct()
    of = classes.select("v", "rep")
    sets = table(full_sets(docs, of.join(ends, F.col("v") == F.col("w"), "left_semi"), k))
    links = table(confirmed(first, sets, percent))

    left = table(_survivors(_tiled(large.select("key", "band", "v"), classes, components(links)), classes, percent, total))
    if left.limit(1).count():
        more = left.select(F.col("v").alias("w")).distinct().join(sets.select(F.col("v").alias("h")), F.col("w") == F.col("h"), "left_anti")
        sets = sets.unionByName(table(full_sets(docs, of.join(more, F.col("v") == F.col("w"), "left_semi"), k)))
        links = table(links.unionByName(_tile_links(left, classes, sets, percent, total)))
    roots = components(links).withColumnRenamed("v", "r_v")
    named = table(classes.select("v", "set_key", "rep").join(roots, F.col("v") == F.col("r_v"), "left").select("set_key", "rep", F.coalesce("root", "v").alias("root")))
    stays = named.groupBy(F.col("root").alias("s_root")).agg(F.min("rep").alias("stays"))
    return all_docs.select("doc_id", "text_key", "n", "set_key"), named.join(stays, F.col("root") == F.col("s_root")).select(F.col("set_key").alias("of"), "stays")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of their k-word shingles of at least
    ``percent`` / 100.

    ``docs``: doc_id, text; other columns are ignored. Returns one row per row of ``docs``: doc_id,
    n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id).

    Null and empty texts have no shingles and are linked with nothing. Equal texts are linked at similarity
    1. A doc_id that repeats with different texts is in the component of each text. A null doc_id is after
    all others: a component without any id has component_id null, and its rows are kept; other rows without
    an id aren't. Repeated rows get equal results. An empty table gives an empty result.
    """
    rows, found = _linked(docs, k, percent)
    component = F.when(F.col("n") > 0, F.col("stays.doc_id")).otherwise(F.col("doc_id"))
    return rows.join(found, F.col("set_key") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), component.isNull()).alias("kept")
    )


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component with all its columns: the row with the smallest doc_id, and every row
    without shingles. ``docs``: doc_id, text, and any columns of any names.

    Rows are told apart by doc_id and text, so a doc_id that repeats with different texts loses none of
    them. A null doc_id comes after all others; of rows with equal text and doc_id the least as JSON stays.
    An empty table gives an empty result.
    """
    rows, found = _linked(docs, k, percent)
    repeated = rows.where("n > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), "n")
    stays = found.select("stays").distinct().select(F.col("stays.doc_id").alias("id"), F.col("stays.text_key").alias("key"))
    counted = stays.join(repeated, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left").select("id", "key", F.coalesce("n", F.lit(1)).alias("n"))
    bare = rows.where("n = 0").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.lit(1).cast("long").alias("n")).distinct()
    return picked(docs, text_key(F.col("text")), table(counted.unionByName(bare)))
