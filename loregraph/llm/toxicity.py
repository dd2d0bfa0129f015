"""Toxicity by weak supervision.

1. Lexicons: over a bounded sample of labelled rows, words and word beginnings are counted by label, and
   those with the highest likelihood ratio are kept: strong ones, which hardly any clean text has, and weak.
2. Voters: groups of strong entries vote toxic where one occurs, counts of weak ones where several different
   words do; a text without either has a vote for clean; patterns and fixed insults vote beside them.
   Otherwise voters abstain.
3. Label model: a generative model of the votes with a latent label. EM estimates what each voter does
   under each label, from the votes alone; the votes' correlations under the same label are then measured,
   correlated voters share their weight, and EM runs again. It sees no labels but their share.
4. Classifier: a logistic regression over the presence of lexicon entries learns the posterior labels. Its
   scale is then set on the sample's labels. It is the classifier that scores all documents.

The sample is ``SAMPLE`` rows at most, those with the smallest hash of doc_id; it is written once, and
everything that goes to the driver is bounded by it and by ``ENTRIES``. Scoring sees whole texts and
nothing but texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import table

#: Labelled rows to learn from at most, lexicon entries at most, and documents that an entry needs.
SAMPLE, ENTRIES, LEAST = 20_000, 4096, 3
#: Groups of strong entries, each a voter.
GROUPS = 8
#: Ratio of an entry's shares under the two labels from which it is strong.
STRONG = 50.0
#: Lengths of the word beginnings that count beside words.
BEGINNINGS = (4, 5, 6)
#: Entries for a number of different words that are toxic entries.
HITS = ((1, "#1"), (2, "#2"), (4, "#4"))
#: Smallest ratio of an entry's shares under the two labels, and smallest likelihood-ratio statistic.
RATIO, SIGNIFICANT = 5.0, 15.0
#: Score from which a document is taken for toxic.
REJECT = 0.7

# Insults that vote before anything is learnt.
SEEDS = "idiot moron loser stupid pathetic worthless disgusting scum trash clown dumb fool imbecile garbage filth hate kill".split()
SEEDS += "dumm idiotin abschaum ekelhaft wertlos imbécile stupide nul ordure débile estúpido imbécil basura asqueroso inútil".split()

_SEEDS = frozenset(SEEDS)
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = (
    re.compile(r"(?i)\b(?:you|du|tu|vous|usted|eres)\W+(?:\w+\W+){0,3}?(?:" + "|".join(SEEDS) + r")"),
    re.compile(r"!{3,}"),
    re.compile(r"(?:\b[A-ZÀ-Ý]{3,}\b\W+){4,}"),
    re.compile(r"(?i)\b(?:shut up|get lost|go away|screw you|drop dead)\b"),
)


class _Features(dict):
    """The lexicon entries of a word: the word and its beginnings, as far as ``known`` (None: all)."""

    def __init__(self, known: dict[str, int] | None = None, toxic: int = 0):
        self.known, self.toxic = known, toxic

    def __missing__(self, word: str):
        if len(self) > 300_000:
            self.clear()
        names = [f"={word}", *(f"{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
        self[word] = found = tuple(names) if self.known is None else tuple(self.known[x] for x in names if x in self.known)
        return found


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def entries_of(text: str | None, features: _Features) -> set:
    """The entries in a text, and of ``HITS`` those for which enough of its words are toxic entries."""
    found: set = set()
    known, hits = features.known, 0
    for w in words_of(text):
        if got := features[w]:
            found.update(got)
            hits += known is not None and any(i < features.toxic for i in got)
    if hits:
        found.update(known[name] for n, name in HITS if hits >= n and name in known)
    return found


@dataclass
class Model:
    """Score of a text: 1 / (1 + exp(-(bias + sum of weights of the entries in it)))."""

    entries: dict[str, int] = field(default_factory=dict)
    toxic: int = 0  # so many entries, the first, are toxic ones
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -3.0


def seed_model() -> Model:
    """What scores where there are no labels of both kinds to learn from."""
    return Model({f"={w}": i for i, w in enumerate(SEEDS)}, len(SEEDS), np.full(len(SEEDS), 5.0), -3.0)


def votes(text: str | None, features: _Features, strong: dict[int, int], toxic: int) -> list[int]:
    """1 toxic, -1 clean, 0 none of each voter. ``strong``: groups of the strong entries; the first ``toxic``
    entries are toxic, ``features`` knows all."""
    out = [0] * (GROUPS + 5)
    sure = weak = clean = 0
    words = words_of(text)
    for w in words:
        ids = features[w]
        groups = [strong[i] for i in ids if i in strong]
        if groups:
            sure += 1
            out[groups[0]] = 1
        elif any(i < toxic for i in ids):
            weak += 1
        elif ids:
            clean += 1
    out[GROUPS:] = int(weak >= 2), int(weak >= 4), int(sure + weak >= 3), -int(not sure and weak < 2), -int(clean > 0 and not sure)
    return out + [int(bool(p.search(text or ""))) for p in _PATTERNS] + [int(not _SEEDS.isdisjoint(words))]


def label_model(v: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of label 1, each voter's P(vote | label) as (voters, 2, 3), and the votes' correlations
    under the same label, from votes (documents, voters) alone. ``prior``: share of label 1."""
    n, m = v.shape
    shown = np.stack([v == x for x in (-1, 0, 1)], axis=2).astype(float)
    weight = np.ones(m)
    post = np.clip(0.5 + 0.5 * np.tanh(v.sum(axis=1) / 2), 0.02, 0.98)  # the majority's
    rho = np.zeros((m, m))
    for again in range(2):
        for _ in range(rounds):
            y = np.stack([1 - post, post], axis=1)
            # Smoothing leans each voter slightly to its own side, so the classes don't swap.
            acc = np.einsum("nk,nmv->mkv", y, shown) + np.array([[2.0, 1.0, 0.2], [0.2, 1.0, 2.0]])
            acc /= acc.sum(axis=2, keepdims=True)
            like = np.einsum("nmv,mkv,m->nk", shown, np.log(acc), weight) + np.log([1 - prior, prior])
            post = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -50, 50)))
        if again == 0:
            mean = np.einsum("nk,nm->km", y, v.astype(float)) / np.maximum(y.sum(axis=0)[:, None], 1)
            left = v - y @ mean
            cov = left.T @ left / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            rho = cov / np.outer(sd, sd)
            np.fill_diagonal(rho, 0)
            weight = 1 / (1 + np.where(rho > 0.1, rho, 0).sum(axis=1))
    return post, acc, rho


def logistic(present: list[np.ndarray], target: np.ndarray, width: int, penalty: float = 2e-5, steps: int = 500) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the cross entropy with soft targets."""
    rows = np.repeat(np.arange(len(present)), [len(x) for x in present])
    cols = np.concatenate(present) if len(rows) else np.zeros(0, int)
    w, b = np.zeros(width + 1), 0.0
    m1, m2 = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = w[-1] + np.bincount(rows, w[cols], minlength=len(present))
        r = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / len(present)
        g = np.append(np.bincount(cols, r[rows], minlength=width), r.sum()) + penalty * np.append(w[:-1], 0)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= 0.05 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        b = w[-1]
    return w[:-1], float(b)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift (a > 0) of the logits that fit the labels, by Newton steps with a small penalty."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        s = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - y) * z).sum() + 0.5 * (a - 1), (p - y).sum() + 0.5 * b])
        h = np.array([[(s * z * z).sum() + 0.5, (s * z).sum()], [(s * z).sum(), s.sum() + 0.5]])
        step = np.linalg.solve(h, g)
        a, b = max(0.1, a - float(np.clip(step[0], -1, 1))), b - float(np.clip(step[1], -2, 2))
    return a, b


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of rows that aren't held out; see the module for the steps.
    Contradicting labels of one document count by their maximum; null labels don't count."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    )
    # Written once: everything that is learnt reads this sample and not the documents again.
    texts = table(docs.where("text is not null").select(F.col("doc_id").cast("long").alias("l_id"), "text").join(F.broadcast(known), "l_id").select("l_id", "text", "toxic"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, toxic, clean = _Features(), Counter(), Counter()
        n = [0, 0]
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["toxic"], strict=True):
                n[int(y)] += 1
                (toxic if y else clean).update(entries_of(text, features))
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"entry": ["", *names], "t": [n[1], *(toxic[x] for x in names)], "c": [n[0], *(clean[x] for x in names)]}).astype({"t": "int64", "c": "int64"})

    counts = table(texts.mapInPandas(count, "entry string, t long, c long").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") + F.col("c") >= LEAST))
    all_ = counts.where("entry = ''").first()
    if all_ is None or not all_["t"] or not all_["c"]:
        return seed_model()
    nt, nc = all_["t"], all_["c"]
    share = (F.col("t") + F.col("c")) / float(nt + nc)
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    g2 = 2 * (part(F.col("t"), nt * share) + part(F.col("c"), nc * share))
    sign = F.when(F.col("t") / float(nt) > F.col("c") / float(nc), 1).otherwise(-1)
    odds = F.log((F.col("t") + 0.5) / (nt + 1.0)) - F.log((F.col("c") + 0.5) / (nc + 1.0))
    likely = counts.where("entry <> ''").where(F.abs(odds) >= float(np.log(RATIO)))
    scored = likely.select("entry", g2.alias("g2"), sign.alias("sign"), odds.alias("odds")).where(F.col("g2") >= SIGNIFICANT)
    # Bounded: ENTRIES rows come to the driver. A quarter may speak for clean texts.
    top = [r for s, k in ((1, ENTRIES * 3 // 4), (-1, ENTRIES // 4)) for r in scored.where(F.col("sign") == s).orderBy(F.desc("g2"), "entry").limit(k).collect()]
    entries = {r["entry"]: i for i, r in enumerate(top)}
    if not entries:
        return seed_model()
    toxic = sum(r["sign"] > 0 for r in top)  # toxic ones come first
    # Entries that begin alike are of one group: a word has one vote.
    strong = {i: zlib.crc32(r["entry"].lstrip("=")[: BEGINNINGS[0]].encode()) % GROUPS for i, r in enumerate(top) if r["sign"] > 0 and r["odds"] >= float(np.log(STRONG))}
    entries |= {name: len(entries) + i for i, (_, name) in enumerate(HITS)}

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = _Features(entries, toxic)
        for pdf in batches:
            yield pd.DataFrame({"l_id": pdf["l_id"], "toxic": pdf["toxic"].astype("int64"), "ids": [sorted(entries_of(t, features)) for t in pdf["text"]], "votes": [votes(t, features, strong, toxic) for t in pdf["text"]]})

    # Bounded: ``sample`` rows of entry numbers come to the driver.
    rows = texts.mapInPandas(mark, "l_id long, toxic long, ids array<int>, votes array<int>").toPandas().sort_values(["l_id"], kind="stable")
    present = [np.asarray(x, int) for x in rows["ids"]]
    y = rows["toxic"].to_numpy(float)
    post, _, _ = label_model(np.array(rows["votes"].tolist(), np.int8).reshape(len(rows), -1), float(np.clip(y.mean(), 0.01, 0.99)))
    w, b = logistic(present, post, len(entries))
    z = b + np.array([w[x].sum() for x in present])
    a, shift = _platt(z, y)
    return Model(entries, toxic, w * a, b * a + shift)


def score_texts(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` (null: empty) in ``into``; other columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # ENTRIES entries at most

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        features = _Features(m.entries, m.toxic)
        for s in batches:
            z = np.array([m.bias + sum(m.weights[i] for i in sorted(entries_of(t, features))) for t in s], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    return docs.withColumn(into, F.pandas_udf(run, "double")(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1), predicted (score >= 0.7).

    Null and empty texts get the score of a text without entries. Null doc_id isn't held out. Repeated
    rows get equal scores. Without labels of both kinds a model of fixed insults scores. An empty table
    gives an empty result.
    """
    scored = score_texts(docs.select("doc_id", "text"), fit(docs, labels, sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, and any columns of any names) whose score is below ``REJECT``,
    with all their columns. Each row is judged by its own text, so null and repeated doc_ids make no
    difference; null and empty texts get the score of a text without entries. An empty table gives an empty
    result."""
    model = fit(docs, labels, sample)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return score_texts(rows, model).where(F.col("score") < REJECT).select("row.*")
