"""Similarity of names from the longest common subsequence, 0 to 100, and a join by it that loses no pair.

The subsequence's length comes from whole rows of the dynamic programme as bits of one integer, so a pair
costs one addition a character. The join compares blocks of texts with blocks: characters shared, whatever their
order, bound the subsequence and are one product of matrices, and only pairs that the bound leaves are compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from loregraph.functions.text import SPACE
from loregraph.storage import table

#: Texts and characters of a block, and classes of characters; no result depends on them.
BLOCK, BLOCK_CHARS, CLASSES = 2048, 1 << 18, 255


def common(a: str, b: str) -> int:
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio_of(a: str, b: str) -> float:
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_of(a: str, b: str) -> float:
    """The best ratio of the shorter to a window of its length in the longer, windows cut at the ends
    included; a substring scores 100."""
    short, long_ = sorted((a, b), key=len)
    if not short:
        return 0.0 if long_ else 100.0
    if short in long_:
        return 100.0
    m = len(short)
    return max(ratio_of(short, long_[max(0, i) : i + m]) for i in range(1 - m, len(long_)))


def _pairwise(f):
    @F.pandas_udf(S.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


ratio, partial_ratio = _pairwise(ratio_of), _pairwise(partial_of)


def sorted_tokens(name: Column) -> Column:
    return F.array_join(F.array_sort(F.array_remove(F.split(name, rf"{SPACE}+"), "")), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def can_reach(least: Column, most: Column, threshold: int) -> Column:
    """Lengths under which the ratio can reach the threshold: the subsequence is no longer than either."""
    return least * 200 >= threshold * (least + most)


def needed(a: np.ndarray, b: np.ndarray, threshold: int, partial: bool) -> np.ndarray:
    """The least common subsequence with which texts of these lengths can reach the threshold. A window of the
    longer text can be cut at its ends, and is then no shorter than the subsequence."""
    need = threshold * np.minimum(a, b) / (200 - threshold) if partial else threshold * (a + b) / 200
    return np.ceil(need - 1e-9)


def _pieces(text: str, threshold: int) -> list[str]:
    """A text of m characters within partial ratio ``threshold`` of a longer one loses or gains at most
    2 m (1 - t) / t characters; cut into one piece more, one of the pieces is in the longer text unchanged."""
    k = int(2 * len(text) * (1 - threshold / 100) / (threshold / 100) + 1e-9)
    size, more = divmod(len(text), k + 1)
    ends = [i * size + min(i, more) for i in range(k + 2)]
    return [text[x:y] for x, y in zip(ends, ends[1:], strict=False)]


class _Block:
    """Texts of two blocks with their characters as small numbers; ``exact`` says whether equal numbers are equal
    characters. If they aren't, what is computed from them is an upper bound."""

    def __init__(self, left: list[str], right: list[str]):
        self.texts, self.left = left + right, len(left)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        seen, codes = np.unique(np.frombuffer("".join(self.texts).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
        self.exact, self.classes = len(seen) <= CLASSES, max(1, min(len(seen), CLASSES))
        self.codes = (codes % CLASSES).astype(np.uint8)
        self.row = np.repeat(np.arange(len(self.texts)), self.length)
        self.place = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.length) - self.length, self.length)

    def shared(self, need) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places in left and right that share at least ``need`` characters in any order: the sum of the
        lesser counts, as a product over one column for each count of each character."""
        counts = np.bincount(self.row * self.classes + self.codes, minlength=len(self.texts) * self.classes).reshape(-1, self.classes)
        a, b = counts[: self.left], counts[self.left :]
        top = np.minimum(a.max(0), b.max(0))
        char, level = np.repeat(np.arange(self.classes), top), np.concatenate([np.arange(1, n + 1) for n in top])
        out = []
        for at in range(0, len(a), 512):
            sums = np.zeros((len(a[at : at + 512]), len(b)), np.float32)
            for d in range(0, len(char), 1024):
                c, n = char[d : d + 1024], level[d : d + 1024]
                sums += (a[at : at + 512][:, c] >= n).astype(np.float32) @ (b[:, c] >= n).astype(np.float32).T
            i, j = np.nonzero(sums >= need(self.length[at : min(at + 512, self.left), None], self.length[None, self.left :]))
            out.append((i + at, j + self.left))
        return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common subsequence of texts ``i`` and ``j``, -1 where both have more than 63 characters."""
        swap = self.length[i] > self.length[j]
        short, long_ = np.where(swap, j, i), np.where(swap, i, j)
        out = np.full(len(i), -1, np.int64)
        fits = self.length <= 63
        bits, none = np.zeros((len(self.texts), 256), np.uint64), np.uint8(255)
        mine = fits[self.row]
        np.bitwise_or.at(bits.reshape(-1), self.row[mine] * 256 + self.codes[mine], np.uint64(1) << self.place[mine].astype(np.uint64))
        padded = np.full((len(self.texts), max(1, self.length.max())), none)
        padded[self.row, self.place] = self.codes
        full = (np.uint64(1) << np.minimum(self.length, 63).astype(np.uint64)) - np.uint64(1)
        order = np.flatnonzero(fits[short])
        order = order[np.argsort(self.length[long_[order]], kind="stable")]
        for at in range(0, len(order), 1 << 15):
            these = order[at : at + (1 << 15)]
            s, x = short[these], long_[these]
            row = full[s]
            for k in range(self.length[x[-1]]):
                hit = row & bits[s, padded[x, k]]
                row = ((row + hit) | (row - hit)) & full[s]
            out[these] = self.length[s] - np.bitwise_count(row)
        return out


def near_of(left: list[str], right: list[str], threshold: int, partial: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of all pairs whose ratio, with ``partial`` the greater of it and the
    partial ratio, is at least ``threshold``, with that score."""
    need = lambda a, b: needed(a, b, threshold, partial)
    block = _Block(left, right)
    i, j = block.shared(need)
    lcs = block.common(i, j)
    keep = (lcs < 0) | (lcs >= need(block.length[i], block.length[j]))
    i, j, lcs = i[keep], j[keep], lcs[keep]
    total = block.length[i] + block.length[j]
    score = np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0)
    for k in np.flatnonzero((lcs < 0) | partial | (not block.exact)):
        a, b = block.texts[i[k]], block.texts[j[k]]
        score[k] = ratio_of(a, b)
        if partial:
            short, long_ = sorted((a, b), key=len)
            if any(p in long_ for p in _pieces(short, threshold)):
                score[k] = max(score[k], partial_of(a, b))
    keep = score >= threshold
    return i[keep], j[keep] - len(left), score[keep]


def _blocks(texts: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """``texts`` (``by``, key) with their block: texts of about one length, dealt by hash; and the blocks."""
    sized = texts.withColumn("size", F.floor(F.log(F.length("key") + F.lit(1.0)) * 8).cast("int"))
    n, most = F.count("*"), F.max(F.length("key"))
    counts = sized.groupBy(by, "size").agg(F.min(F.length("key")).alias("least"), most.alias("most"), F.ceil(F.greatest(n / BLOCK, n * most / BLOCK_CHARS, F.lit(1.0))).cast("int").alias("parts"))
    dealt = sized.join(counts.select(by, "size", "parts"), [by, "size"]).select(by, "key", "size", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"))
    return dealt, counts.select(by, "size", "least", "most", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))


def near_texts(left: DataFrame, right: DataFrame | None, by: str, threshold: int, partial: bool = False) -> DataFrame:
    """``left`` and ``right`` (``by``, key) to (``by``, a, b, score): all pairs of keys whose ratio, with ``partial``
    the greater of it and the partial ratio, reaches the threshold, each once. Without ``right`` the pairs
    a < b of ``left``. Every pair of blocks whose lengths allow a match is one group of two blocks at most."""
    spark, one = left.sparkSession, right is None
    own = lambda df: table(df.select(by, "key").where("key is not null").distinct())
    left = own(left)
    right = left if one else own(right)
    (a, a_blocks), (b, b_blocks) = _blocks(left, by), _blocks(right, by)
    first = a_blocks.toDF(by, "a_size", "a_least", "a_most", "a_part")
    tiles = first.join(b_blocks.toDF(by, "b_size", "b_least", "b_most", "b_part"), by)
    if one:
        tiles = tiles.where("struct(a_size, a_part) <= struct(b_size, b_part)")
    if not partial:
        apart = (F.col("a_most") < F.col("b_least")) & ~can_reach(F.col("a_most"), F.col("b_least"), threshold)
        tiles = tiles.where(~apart & ~((F.col("b_most") < F.col("a_least")) & ~can_reach(F.col("b_most"), F.col("a_least"), threshold)))
    at = [by, "a_size", "a_part", "b_size", "b_part"]
    tiles = table(tiles.select(*at))
    # Few bytes are much work here, so the number of tasks isn't left to sizes.
    tasks = max(1, min(tiles.count(), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)))
    place = lambda df, s: df.toDF(by, "key", f"{s}_size", f"{s}_part").join(tiles, [by, f"{s}_size", f"{s}_part"]).select(*at, "key").repartition(tasks, *at)

    def pairs(key: tuple, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:  # noqa: E741
        x, y = l["key"].to_numpy(object), r["key"].to_numpy(object)
        if not len(x) or not len(y):
            return pd.DataFrame({by: [], "a": [], "b": [], "score": []})
        i, j, score = near_of(list(x), list(y), threshold, partial)
        found = pd.DataFrame({by: key[0], "a": x[i], "b": y[j], "score": score})
        if one and key[1:3] == key[3:5]:
            return found[found["a"] < found["b"]]
        if one:
            swap = found["a"] > found["b"]
            found.loc[swap, ["a", "b"]] = found.loc[swap, ["b", "a"]].to_numpy()
        return found

    kind = left.schema[by].dataType.simpleString()
    return place(a, "a").groupBy(*at).cogroup(place(b, "b").groupBy(*at)).applyInPandas(pairs, f"{by} {kind}, a string, b string, score double")


def similar_pairs(names: DataFrame, by: str, threshold: int) -> DataFrame:
    """``names`` (``by``, name) to (``by``, a, b, score): pairs of different names of one group with
    token-sort ratio at or above the threshold, each once with a < b. No pair is lost."""
    named = table(names.select(by, "name", sorted_tokens(F.col("name")).alias("t")).distinct())
    near = near_texts(named.select(by, F.col("t").alias("key")), None, by, threshold)
    x, y = named.select(by, F.col("name").alias("x"), F.col("t").alias("a")), named.select(by, F.col("name").alias("y"), F.col("t").alias("b"))
    other = near.join(x, [by, "a"]).join(y, [by, "b"])
    same = x.withColumn("b", F.col("a")).join(y, [by, "b"]).where("x < y").withColumn("score", F.lit(100.0))
    both = other.select(by, "x", "y", "score").unionByName(same.select(by, "x", "y", "score"))
    return both.select(by, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")
