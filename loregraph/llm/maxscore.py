"""Exact top-k search by MaxScore over integer vectors.

A dimension with a sign is a term: the postings of (t, +) are the vectors whose component t is positive,
those of (t, -) where it is negative. Of each dimension one term of a query adds to a score, at most the
query's component times the largest of the term's postings; the other term only takes away.

A shard of vectors holds its postings by term, in order of vec_id; the two lists of a dimension that most
vectors are in are laid out by place once they're loaded. A query goes through a shard in steps of rising
vec_id. Its dimensions in rising order of bound are non-essential as long as their bounds sum to no more
than its k-th score so far: a vector that no essential posting adds to can't enter the result. The essential
postings of a step are traversed and their products summed by vector; then the non-essential dimensions, the
one with the highest bound first, are probed, for those vectors alone that could still enter. The lists of k
of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import shards

#: Vectors of a shard, queries of a block, vectors of a query's first step, how much larger each next step is,
#: dimensions that are probed between two cuts, and the share of vectors (one in so many) from which a
#: dimension's postings are laid out by place.
SHARD, BLOCK, FIRST, GROWS, PROBE, FULL = 4096, 1024, 128, 4, 8, 4


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id, v: floor(64 * x) of each component as long, of vectors whose components are all finite. A
    finite component that doesn't fit a long ends the run."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf))

    def floor(c: Column) -> Column:
        wide = c.cast("double") * 64
        return F.when((wide >= -(2.0**63)) & (wide < 2.0**63), F.floor(wide).cast("long")).otherwise(F.raise_error(F.lit("op4_maxscore: 64 times a component doesn't fit a long")).cast("long"))

    return vectors.where(x.isNotNull() & whole & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, floor).alias("v"))


@dataclass
class Shard:
    """Postings: those of term 2t (component t positive) and 2t + 1 (negative) are ``where`` and ``values``
    from ``start[term]`` to ``start[term + 1]``, by place; ``ids`` of the places rise."""

    ids: np.ndarray
    start: np.ndarray
    where: np.ndarray
    values: np.ndarray

    def __post_init__(self):
        spans = list(zip(self.start[:-1], self.start[1:], strict=True))
        # Of each term the largest absolute value, as Python's integers.
        self.largest = [max(abs(int(x.max())), abs(int(x.min()))) if len(x := self.values[a:b]) else 0 for a, b in spans]
        # Where a step begins: in places, and in each term's postings.
        steps, size = [0], FIRST
        while steps[-1] < len(self.ids):
            steps.append(min(steps[-1] + size, len(self.ids)))
            size *= GROWS
        self.steps = steps
        self.most = np.array(self.largest, object).reshape(-1, 2)
        self.wide = self.most.astype(np.float64)
        self.begins = np.array([a + np.searchsorted(self.where[a:b], steps) for a, b in spans], np.int64).reshape(len(spans), len(steps))
        # Postings of each dimension in each step.
        self.held = (self.begins[:, 1:] - self.begins[:, :-1]).reshape(-1, 2, len(steps) - 1).sum(axis=1)
        # Dimensions with many postings by place: row[t] is that of dimension t, -1 for one with few.
        many = [t for t in range(len(spans) // 2) if FULL * (self.start[2 * t + 2] - self.start[2 * t]) >= len(self.ids)]
        self.row = np.full(len(spans) // 2, -1)
        self.row[many] = np.arange(len(many))
        self.full = np.zeros((len(many), len(self.ids)), np.int64)
        for t in many:
            a, b = self.start[2 * t], self.start[2 * t + 2]
            self.full[self.row[t], self.where[a:b]] = self.values[a:b]
        self.kinds: dict[type, np.ndarray] = {}

    def _rows(self, kind: type) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = self.full.astype(kind)
        return self.kinds[kind]

    def bounds(self, q: np.ndarray, kind: type) -> tuple[np.ndarray, float]:
        """What each dimension can add to a score of ``q``, and the most that all can change it."""
        size = np.abs(q.astype(kind))
        largest = (self.wide if kind is np.float64 else self.most)[: len(q)]
        return size * np.where(q < 0, largest[:, 1], largest[:, 0]), float((size * largest.max(axis=1, initial=0)).sum())

    def summed(self, dims: np.ndarray, weight: np.ndarray, step: int, kind: type) -> np.ndarray:
        """Products of all postings of these dimensions in a step, summed by vector."""
        at, end = self.steps[step], self.steps[step + 1]
        rows = self.row[dims]
        laid = rows >= 0
        out = weight[laid] @ self._rows(kind)[rows[laid], at:end] if laid.any() else np.zeros(end - at, kind)
        for t, x in zip(dims[~laid], weight[~laid], strict=True):
            for term in (2 * t, 2 * t + 1):
                a, b = self.begins[term, step], self.begins[term, step + 1]
                out[self.where[a:b] - at] += self.values[a:b].astype(kind) * x  # a term has a vector once
        return out

    def probed(self, dims: np.ndarray, weight: np.ndarray, step: int, who: np.ndarray, kind: type) -> np.ndarray:
        """The same for the places ``who`` of the step alone."""
        at = self.steps[step]
        rows = self.row[dims]
        laid = rows >= 0
        out = weight[laid] @ self._rows(kind)[rows[laid][:, None], at + who] if laid.any() else np.zeros(len(who), kind)
        for t, x in zip(dims[~laid], weight[~laid], strict=True):
            for term in (2 * t, 2 * t + 1):
                a, b = self.begins[term, step], self.begins[term, step + 1]
                places = self.where[a:b] - at
                found = np.searchsorted(places, who)
                hit = found < len(places)
                hit[hit] = places[found[hit]] == who[hit]
                out[hit] += self.values[a + found[hit]].astype(kind) * x
        return out

    @classmethod
    def of(cls, ids: np.ndarray, vectors: list[np.ndarray]) -> Shard:
        """Shorter vectors have no postings for the dimensions that they lack."""
        order = np.argsort(ids, kind="stable")
        m = np.zeros((len(ids), max(map(len, vectors), default=0)), np.int64)
        for i, k in enumerate(order):
            m[i, : len(vectors[k])] = vectors[k]
        parts = [np.flatnonzero(c) for column in m.T for c in (column > 0, column < 0)]
        values = [m[p, t // 2] for t, p in enumerate(parts)]
        join = lambda xs, kind: np.concatenate(xs).astype(kind) if xs else np.zeros(0, kind)
        return cls(ids[order], np.cumsum([0] + [len(p) for p in parts]), join(parts, np.int64), join(values, np.int64))


@dataclass
class Work:
    """What a search did: postings traversed and probed, and candidates that were probed at all."""

    traversed: int = 0
    probed: int = 0
    candidates: int = 0


def search(shard: Shard, query: np.ndarray, own: int, k: int, work: Work | None = None) -> list[tuple[int, int]]:
    """(vec_id, score) of the ``k`` best vectors but those with id ``own``, ties to the smaller id. Sums are
    exact: float64 integers below 2**53, else Python's integers."""
    work = Work() if work is None else work
    dims = min(len(query), len(shard.row))
    q = np.asarray(query[:dims], np.int64)
    kind: type = np.float64
    bounds, most = shard.bounds(q, kind)
    if most >= 2.0**52:
        kind = object
        bounds, _ = shard.bounds(q, kind)
    rising = np.flatnonzero(q)
    dims_up = rising[np.argsort(bounds[rising], kind="stable")]
    weight = q[dims_up].astype(kind)
    # What the terms up to each one can add together.
    ceilings = np.cumsum(bounds[dims_up])
    best, best_ids, level = np.zeros(0, kind), np.zeros(0, np.int64), None
    for step, (at, end) in enumerate(zip(shard.steps[:-1], shard.steps[1:], strict=True)):
        # While the k-th score is negative, a vector in no posting may enter: nothing is non-essential.
        cut = 0 if level is None or level < 0 else int(np.searchsorted(ceilings, level, side="right"))
        score = shard.summed(dims_up[cut:], weight[cut:], step, kind)
        work.traversed += int(shard.held[dims_up[cut:], step].sum())
        fits = shard.ids[at:end] != own
        if level is not None:
            # What no essential posting adds to is left out here: the non-essential sum is no more than the level.
            fits &= score + (ceilings[cut - 1] if cut else 0) > level
        who = np.flatnonzero(fits)
        score = score[who]
        work.candidates += len(who)
        for hi in range(cut, 0, -PROBE):
            if not len(who):
                break
            lo = max(0, hi - PROBE)
            score = score + shard.probed(dims_up[lo:hi], weight[lo:hi], step, who, kind)
            work.probed += len(who) * (hi - lo)
            alive = score + (ceilings[lo - 1] if lo else 0) > level
            who, score = who[alive], score[alive]
        # Ids rise, so an equal score in a later step can't enter.
        all_scores, all_ids = np.concatenate([best, score]), np.concatenate([best_ids, shard.ids[at:end][who]])
        if len(all_scores) > 4 * k:
            kth = np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]
            near = all_scores >= kth
            all_scores, all_ids = all_scores[near], all_ids[near]
        order = np.lexsort((all_ids, -all_scores))[:k]
        best, best_ids = all_scores[order], all_ids[order]
        level = best[-1] if len(best) == k else None
    return [(int(i), int(s)) for i, s in zip(best_ids, best, strict=True)]


def _indexed(rows: DataFrame) -> DataFrame:
    """One row a shard: its postings as bytes."""

    def index(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        s = Shard.of(pdf["vec_id"].to_numpy(np.int64), [np.asarray(v, np.int64) for v in pdf["v"]])
        return pd.DataFrame({"shard": [key[0]], **{c: [np.asarray(getattr(s, c), np.int64).tobytes()] for c in ("ids", "start", "where", "values")}})

    return rows.groupBy("shard").applyInPandas(index, "shard int, ids binary, start binary, where binary, values binary")


def _blocked(rows: DataFrame) -> DataFrame:
    """One row a block of queries: their ids, dimensions and components as bytes."""

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dims = np.array([len(v) for v in pdf["v"]], np.int64)
        comps = b"".join(np.asarray(v, np.int64).tobytes() for v in pdf["v"])
        return pd.DataFrame({"block": [key[0]], "q_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "q_dims": [dims.tobytes()], "q_comps": [comps]})

    return rows.groupBy("block").applyInPandas(pack, "block int, q_ids binary, q_dims binary, q_comps binary")


def top_k(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` vectors with the highest inner product for each row whose vec_id is divisible by ``every``.

    ``vectors``: vec_id, embedding; components count as floor(64 * x); other columns are ignored. Returns
    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    Vectors that are null, or hold null or non-finite components, and null ids take no part. A dimension
    that a shorter vector lacks counts 0. Each row is a candidate, so rows that repeat id and vector may
    come several times; rows with the query's own id are no candidates for it. Each row divisible by
    ``every`` is a query of its own, so a query that repeats has its list repeated. An empty table gives
    an empty result.
    """
    rows = quantized(vectors)
    seen = vectors.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    n_shards, n_blocks = shards(seen["n"], SHARD, 1), shards(seen["q"], BLOCK, 1)
    # Rows are dealt with their place in the table, so that rows with one id don't meet in one shard.
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    stored = _indexed(rows.withColumn("shard", dealt(n_shards)))
    asked = _blocked(rows.where(F.col("vec_id") % every == 0).withColumn("block", dealt(n_blocks)))
    # The stated set of queries, in blocks, meets every shard.
    met = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).join(stored, "shard")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                s = Shard(*(np.frombuffer(r[c], np.int64) for c in ("ids", "start", "where", "values")))
                comps = np.split(np.frombuffer(r["q_comps"], np.int64), np.cumsum(np.frombuffer(r["q_dims"], np.int64))[:-1])
                found = [(r["block"], j, q, *x) for j, (q, c) in enumerate(zip(np.frombuffer(r["q_ids"], np.int64).tolist(), comps, strict=True)) for x in search(s, c, q, k)]
                yield pd.DataFrame(found, columns=["block", "place", "query_id", "vec_id", "score"]).astype({"block": "int32", "place": "int32", "query_id": "int64", "vec_id": "int64", "score": "int64"})

    lists = met.repartition(n_shards * n_blocks, "shard", "block").mapInPandas(run, "block int, place int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    best = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.place, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
