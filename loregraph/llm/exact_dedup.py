"""Exact dedup against a history, through a sharded minimal perfect hash.

The digests seen before are dealt into shards. Each shard holds a minimal perfect hash (a cascade of
bit arrays: a key takes the first level at which it is alone at its position, and its slot is the rank
of that bit) and one slot a key with the full 32-byte digest and the locator of the winner. A lookup
compares all 32 bytes, so a digest that isn't a member is never taken for one; nonmembers form groups
of their own. Shards travel as rows of a DataFrame: neither the driver nor one task sees them all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import WS, checkpoint, picked, shards, table

#: Bits a key at each level of the cascade; 2 ends it after some ten levels.
GAMMA = 2.0
#: Digests in a shard, so that a shard takes about 2.6 MB.
SHARD_ROWS = 65536

_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalized(text), 256))


def _positions(words: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = words[:, level % 4] + _MIX * np.uint64(level + 1)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) ^ words[:, (level + 1) % 4]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(11)) % np.uint64(bits)).astype(np.int64)


def _as_words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), 4)


class PerfectHash:
    """Minimal perfect hash over distinct 32-byte keys: keys go to 0..n-1 without a gap."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(flat) - 1
        self.start = np.cumsum([0] + [len(x) for x in levels])

    @classmethod
    def build(cls, words: np.ndarray) -> PerfectHash:
        levels, left = [], words
        while len(left):
            if len(levels) > 200:
                raise ValueError("keys of a perfect hash must be distinct")
            bits = max(64, int(len(left) * GAMMA))
            pos = _positions(left, len(levels), bits)
            alone = np.bincount(pos, minlength=bits) == 1
            levels.append(alone)
            left = left[~alone[pos]]
        return cls(levels)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where every level turns it away."""
        out = np.full(len(words), -1, np.int64)
        open_ = np.arange(len(words))
        for k, bits in enumerate(self.levels):
            if not len(open_):
                break
            pos = _positions(words[open_], k, len(bits))
            hit = bits[pos]
            out[open_[hit]] = self.rank[self.start[k] + pos[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> tuple[bytes, bytes]:
        return np.array([len(x) for x in self.levels], "<i8").tobytes(), b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in np.frombuffer(sizes, "<i8"):
            k = (int(n) + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(bits[at : at + k], np.uint8), count=int(n)).astype(bool))
            at += k
        return cls(levels)


INDEX = "shard int, level_sizes binary, level_bits binary, slot_digests binary, slot_locators binary"


def _shard(count: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(count)).cast("int")


def build_index(history: DataFrame, count: int) -> DataFrame:
    """``history`` (digest binary, distinct; locator long) to one row a shard, see ``INDEX``."""

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        words = _as_words(pdf["digest"].tolist())
        mph = PerfectHash.build(words)
        order = np.empty(len(pdf), np.int64)
        order[mph.slots(words)] = np.arange(len(pdf))
        sizes, bits = mph.dump()
        return pd.DataFrame({"shard": [key[0]], "level_sizes": [sizes], "level_bits": [bits], "slot_digests": [words[order].tobytes()], "slot_locators": [pdf["locator"].to_numpy(np.int64)[order].tobytes()]})

    return history.where("digest is not null and locator is not null").withColumn("shard", _shard(count)).groupBy("shard").applyInPandas(build, INDEX)


def lookup(distinct: DataFrame, index: DataFrame, count: int) -> DataFrame:
    """``distinct`` (digest, first_id, n) with ``locator``: the winner of an equal member, null for a nonmember."""

    def probe(key: tuple, keys: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = pd.Series(pd.array([None] * len(keys), dtype="Int64"))
        if len(keys) and len(shard):
            row = shard.iloc[0]
            words = _as_words(keys["digest"].tolist())
            stored = np.frombuffer(row["slot_digests"], "<u8").reshape(-1, 4)
            slot = PerfectHash.load(row["level_sizes"], row["level_bits"]).slots(words)
            found = slot >= 0
            found[found] = (stored[slot[found]] == words[found]).all(axis=1)
            out[found] = np.frombuffer(row["slot_locators"], "<i8")[slot[found]]
        return pd.DataFrame({"digest": keys["digest"], "first_id": keys["first_id"].astype("Int64"), "n": keys["n"], "locator": out.to_numpy()})

    return (
        distinct.withColumn("shard", _shard(count)).groupBy("shard").cogroup(index.groupBy("shard"))
        .applyInPandas(probe, "digest binary, first_id long, n long, locator long")
    )


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Which documents repeat another's text, up to runs of white space.

    ``docs``: doc_id, text; other columns are ignored, whatever their names. ``history``: digest (32
    bytes), locator, of distinct texts seen before; without it the documents up to the middle of the
    range of doc_id are the history of the whole table. A text in the history keeps the locator that the
    lookup gives; only other texts take the smallest doc_id of their own. Returns one row per row of ``docs``: doc_id,
    keep_id, group_size, kept, text_sha256.

    Null text equals the empty text. A null doc_id is never the smallest; rows with one are kept only
    in a group without any id, whose keep_id is null. Repeated rows count each and are kept alike. An
    empty table gives an empty result.
    """
    rows = checkpoint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest")))
    seen = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    if history is None:
        middle = (seen["low"] + seen["high"]) // 2 if seen["low"] is not None else 0
        later = F.when(F.col("doc_id") > middle, F.col("doc_id"))  # the others' texts are members
        history = rows.where(F.col("doc_id") <= middle).groupBy("digest").agg(F.min("doc_id").alias("locator"))
        count = shards(seen["n"], SHARD_ROWS)
    else:
        later = F.col("doc_id")
        count = shards(max(seen["n"], history.count()), SHARD_ROWS)
        history = history.groupBy("digest").agg(F.min("locator").alias("locator"))
    index = checkpoint(build_index(history, count))
    # One row a distinct digest is looked up: a text with a third of all rows was folded on the map side.
    distinct = rows.groupBy("digest").agg(F.min(later).alias("first_id"), F.count("*").alias("n"))
    groups = lookup(distinct, index, count).select(F.col("digest").alias("of"), F.coalesce("locator", "first_id").alias("keep_id"), F.col("n").alias("group_size"))
    # The hot digest is on the side that adaptive execution splits; the other has one row a digest.
    return rows.join(groups, F.col("digest") == F.col("of")).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each text with all its columns: the row with the smallest doc_id. ``docs``: doc_id, text,
    and any columns of any names.

    Rows are told apart by doc_id and text, not by doc_id alone, so a doc_id that repeats with different
    texts loses none of them. A null doc_id comes after all others; of rows with equal text and doc_id
    (repeated rows, or null ids) the least as JSON stays. Null text equals the empty text. An empty table
    gives an empty result.
    """
    kept = exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    wanted = table(kept.select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("key"), "n"))
    return picked(docs, digest(F.col("text")), wanted)


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""
