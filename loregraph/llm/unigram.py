"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Text is prefixed with a space, spaces become the marker U+2581, and the best segmentation maximises the
sum of the pieces' log scores. Characters that no piece covers become byte pieces. Pieces hold the marker
only at their start (runs of markers apart), so the best segmentation of a text is the concatenation of
the best segmentations of its words, each word with its marker in front; words repeat, so each worker
keeps those it has met in a bounded table.

Scores: a unigram model's scores are log probabilities and stay. A BPE model's scores are ranks, negated;
they become Zipf log probabilities, -log(rank + 1) less their normaliser. The vocabulary file is a
parameter; nothing is trained.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the white-space marker.
MARK = "▁"
#: Words that a worker remembers, and the longest of them.
MEMORY, LONGEST = 600_000, 64
#: How much a byte piece scores below the worst ordinary piece, as is usual for unknown pieces.
BYTE_PENALTY = 10.0
#: A piece of work: a marker run with what follows it.
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` and ``scores`` by id; ``kinds``: n for normal, b for byte, c for what texts never hold."""

    pieces: list[str]
    scores: list[float]
    kinds: str

    @cached_property
    def digest(self) -> str:
        """Of all pieces, scores and kinds: vocabularies that differ in one of them are told apart."""
        whole = "\x00".join(self.pieces).encode() + np.array(self.scores, "<f8").tobytes() + self.kinds.encode()
        return hashlib.sha256(whole).hexdigest()


def read_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(sp.get_piece_size())
    kinds = "".join("b" if sp.is_byte(i) else "c" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "n" for i in ids)
    scores = [sp.get_score(i) for i in ids]
    if all(s == int(s) for s in scores):  # ranks of merges
        total = math.log(sum(1 / (1 - s) for s, k in zip(scores, kinds, strict=True) if k == "n"))
        scores = [-math.log(1 - s) - total if k == "n" else 0.0 for s, k in zip(scores, kinds, strict=True)]
    return Vocabulary([sp.id_to_piece(i) for i in ids], scores, kinds)


class DoubleArray:
    """Trie over byte strings in two integer arrays: the child of s by byte c is t = base[s] + c + 1 if
    check[t] = s; value[s] is the id of the string that ends at s, or -1."""

    def __init__(self, keys: dict[bytes, int]):
        names = sorted(keys)
        used = bytearray(b"\x01") + bytes(512)  # places that are taken; the root's is 0
        parent, base, value = {0: -1}, {0: 0}, {}
        first = 1  # below it the array is nearly full and isn't searched again
        stack = [(0, 0, len(names), 0)]
        while stack:
            state, lo, hi, depth = stack.pop()
            if lo < hi and len(names[lo]) == depth:
                value[state] = keys[names[lo]]
                lo += 1
            children, at = [], lo
            while at < hi:
                c, start = names[at][depth], at
                while at < hi and names[at][depth] == c:
                    at += 1
                children.append((c, start, at))
            if not children:
                continue
            low = children[0][0]
            place, tried = max(first, low + 1) - 1, 0
            while True:
                place = used.find(0, place + 1)
                if place < 0 or place + 256 > len(used):
                    used += bytes(len(used))
                    place = max(0, place - 1) if place > 0 else len(used) // 2 - 1
                    continue
                tried += 1
                if not any(used[place - low + c] for c, _, _ in children):
                    break
            if tried > 64:
                first = max(first, place - 256)
            base[state] = place - low - 1
            for c, start, end in children:
                used[place - low + c] = 1
                parent[place - low + c] = state
                stack.append((place - low + c, start, end, depth + 1))
        size = max(parent) + 258  # so that a step from any state stays inside
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        for column, found in ((self.base, base), (self.check, parent), (self.value, value)):
            for k, x in found.items():
                column[k] = x

    def prefixes(self, text: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, id) of each key that starts at ``at``."""
        base, check, value = self.base, self.check, self.value
        s = 0
        for i in range(at, len(text)):
            t = base[s] + text[i] + 1
            if check[t] != s:
                return
            s = t
            if value[s] >= 0:
                yield i + 1, value[s]


class Unigram:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.trie = DoubleArray({p.encode(): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)) if k == "n"})
        self.byte_ids = {int(vocabulary.pieces[i][3:5], 16): i for i, k in enumerate(vocabulary.kinds) if k == "b"}
        if len(self.byte_ids) not in (0, 256):
            raise ValueError("byte pieces must be all or none")
        self.unknown = vocabulary.kinds.find("c")
        self.floor = min((s for s, k in zip(vocabulary.scores, vocabulary.kinds, strict=True) if k == "n"), default=0.0) - BYTE_PENALTY
        inner = [p for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True) if k == "n" and MARK in p.lstrip(MARK)]
        self.splits = not inner  # else a piece may cross words, and texts are taken whole
        named = [bytes([int(p[3:5], 16)]) if k == "b" else p.replace(MARK, " ").encode() if k == "n" else b"" for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True)]
        self.width = np.array([len(x) for x in named], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.text_bytes = np.frombuffer(b"".join(named), np.uint8)
        self.memory = _Memory(self, not any("\n" in p for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True) if k == "n"))

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation; of equal ones that whose last pieces start earliest."""
        raw, scores = text.encode(), self.v.scores
        base, check, value, floor = self.trie.base, self.trie.check, self.trie.value, self.floor
        n = len(raw)
        best, back, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == -math.inf:
                continue
            lead = raw[i]
            end = i + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            alone, s, j = False, 0, i
            while j < n:
                t = base[s] + raw[j] + 1
                if check[t] != s:
                    break
                s = t
                j += 1
                v = value[s]
                if v >= 0:
                    if j == end:
                        alone = True
                    score = here + scores[v]
                    if score > best[j]:
                        best[j], back[j], piece[j] = score, i, v
            if not alone and here + floor > best[end]:
                best[end], back[end], piece[end] = here + floor, i, -1
        out: list[int] = []
        at = n
        while at:
            start = back[at]
            if piece[at] >= 0:
                out.append(piece[at])
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(raw[start:at])]
            else:
                out.append(self.unknown)
            at = start
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; the empty text has none."""
        if not text:
            return np.zeros(0, np.int32)
        if not self.splits:
            return np.array(self.viterbi(MARK + text.replace(" ", MARK)), np.int32)
        known = self.memory
        if "  " in text or text[0] == " " or MARK in text:  # runs of markers belong together
            parts = [known[w] for w in _WORDS.findall(MARK + text.replace(" ", MARK))]
        else:
            # A word that follows a space; or, where no piece holds a line end, one that follows that.
            parts = [known[w] for w in (text.replace("\n", " \n") if known.breaks else text).split(" ")]
        return np.frombuffer(b"".join(parts), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: markers are spaces, byte pieces join to characters, and the space that
        encoding puts in front goes. Bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        ids = np.asarray(ids, np.int64)
        width = self.width[ids]
        shift = np.repeat(self.start[ids] - np.cumsum(width) + width, width)
        raw = self.text_bytes[shift + np.arange(len(shift))].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class _Memory(dict):
    """Ids of words as bytes. A word is what stands after a space and gets the marker; one that begins
    with a marker, or with a line end that no piece holds, is taken as it is."""

    def __init__(self, tokenizer: Unigram, breaks: bool):
        self.tokenizer, self.breaks = tokenizer, breaks

    def __missing__(self, word: str) -> bytes:
        whole = word if word[:1] == MARK or self.breaks and word[:1] == "\n" else MARK + word
        ids = np.array(self.tokenizer.viterbi(whole), "<i4").tobytes()
        if len(word) <= LONGEST:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = ids
        return ids


def _shared(docs: DataFrame, model_file: str):
    """The vocabulary, read once on the driver and sent to each executor: a file of fixed size."""
    return docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_file))


_BUILT: dict[str, Unigram] = {}


def _tokenizer(sent) -> Unigram:
    """One a Python worker: workers outlive tasks, so the trie is built once in each."""
    v = sent.value
    if v.digest not in _BUILT:
        _BUILT[v.digest] = Unigram(v)
    return _BUILT[v.digest]


def encode(docs: DataFrame, model_file: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with ``into``: array<int>, the ids of ``text``; null text has null ids, the empty
    text none. A column that is named ``into`` is replaced, all others stay. An empty table gives an empty
    result."""
    sent = _shared(docs, model_file)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(sent)
        for s in batches:
            yield pd.Series([None if x is None else t.encode(x) for x in s])

    return docs.withColumn(into, F.pandas_udf(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, model_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with ``into``: the text of ``ids``; null ids have null text. A column that is named
    ``into`` is replaced, all others stay. An empty table gives an empty result."""
    sent = _shared(docs, model_file)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(sent)
        for s in batches:
            yield pd.Series([None if x is None else t.decode(x) for x in s])

    return docs.withColumn(into, F.pandas_udf(run, "string")(F.col(ids)))


def token_report(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_bytes (tokens that are byte
    pieces), ids_sha256 (of the ids as little-endian 32-bit integers), round_trip (the ids decode to the text).

    Null text counts as empty, which has no tokens. The marker U+2581 in a text decodes to a space, so
    such a text doesn't make the round trip. Repeated rows and null ids are reported like others. An
    empty table gives an empty result.
    """
    sent = _shared(docs, model_file)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _tokenizer(sent)
        is_byte = np.array([k == "b" for k in t.v.kinds])
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                text = text or ""
                ids = t.encode(text)
                rows.append((len(ids), int(is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(), t.decode(ids) == text))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_bytes", "ids_sha256", "round_trip"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n_tokens long, n_bytes long, ids_sha256 string, round_trip boolean")
