"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: density of a lexicon (learned from the training rows: whole words and word beginnings),
lexicon words near the second person, obfuscated lexicon words, capitals, punctuation, lengths.
The trees and the calibration are fitted in numpy on a bounded sample of labelled rows
(``SAMPLE_ROWS``, those with the smallest hash of the id); every text is scored on the executors.

Defined results: null and empty texts have all features 0 and get the score the model gives them.
Null labels and ids take no part in training. Without labels of both kinds the score is their mean
(0.0 without any). Repeated rows are scored each. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, map_rows, small_batches, stored, table
from tidemark.llm.registry import query

SAMPLE_ROWS = 9_000  # labelled rows the model is fitted on, at most
LEXICON_SIZE = 600  # terms, at most
MIN_DOCS = 6  # positive training texts that a lexicon term occurs in, at least
TERM_ODDS = 12.0  # times as frequent in positive texts as in others, at least
THRESHOLD = 0.7
PREFIXES = (5, 6)
NEAR = 4  # words between a lexicon word and the second person

SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos"
    " usted ustedes tú ti tus vosotros".split()
)
SEEDS = ("idiot", "stupid", "moron", "loser", "pathetic", "worthless", "trash", "scum", "disgusting", "clown")

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_MASKED = re.compile(r"(?<!\w)(?=[\w@$!*|]*[^\W\d_])(?=[\w@$!*|]*[0-9@$!*|])[\w@$!*|]{3,24}")
_SPACED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?![^\W\d_])")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")
_UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"})
FEATURES = 13


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    starts: frozenset[str]

    def has(self, word: str) -> bool:
        return word in self.words or word[:5] in self.starts or word[:6] in self.starts


def unmask(token: str) -> str:
    """A token with digits and signs read as the letters they stand for."""
    return _REPEATED.sub(r"\1", token.translate(_UNMASK).replace("*", ""))


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    n, chars = len(words), len(text)
    if not chars:
        return [0.0] * FEATURES
    known, starts = lexicon.words, lexicon.starts
    hits = [i for i, w in enumerate(words) if w in known or w[:5] in starts or w[:6] in starts]
    near = sum(not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    persons = sum(map(words.count, ("you", "your", "du", "tu", "vous", "usted")))
    masked = [m for m in _MASKED.findall(low) if lexicon.has(unmask(m)) or lexicon.has(unmask(m.rstrip("!|*$")))]
    spaced = [m for m in _SPACED.findall(low) if lexicon.has(re.sub(r"[ .\-_*]", "", m))]
    stretched = [m for m in words if _REPEATED.search(m) and lexicon.has(_REPEATED.sub(r"\1", m))] if _REPEATED.search(low) else []
    hidden = len(masked) + len(spaced) + len(stretched)
    letters = sum(map(len, words)) or 1
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    distinct = len({words[i] for i in hits})
    strong = text.count("!") + text.count("?")
    return [
        float(len(hits) + hidden),
        1000.0 * (len(hits) + hidden) / (n + 20),
        float(distinct),
        1000.0 * near / (n + 20),
        float(near),
        1000.0 * persons / (n + 20),
        float(hidden),
        1000.0 * hidden / (n + 20),
        capitals / letters,
        strong / chars,
        (text.count("*") + text.count("$") + text.count("#") + text.count("%") + text.count("@")) / chars,
        float(np.log1p(n)),
        letters / (n or 1),
    ]


def _terms(word: str) -> set[str]:
    return {f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)}


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms far more frequent in positive texts; counted on the executors, at most ``LEXICON_SIZE`` returned."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for part in parts:
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                terms: set[str] = set()
                for word in set(_WORD.findall((text or "").lower())):
                    terms |= _terms(word)
                found[int(toxic)].update(terms)
        terms = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_pydict(
            {"term": terms, "pos": [found[1][t] for t in terms], "neg": [found[0][t] for t in terms]},
            schema=pa.schema([("term", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())]),
        )

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    counts = sample.select("text", "toxic").mapInArrow(count, "term string, pos long, neg long")
    odds = (F.col("pos") + 0.0) / (pos + 1) / ((F.col("neg") + 0.5) / (neg + 1))
    terms = (
        counts.groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") >= MIN_DOCS) & (odds >= TERM_ODDS))
        .orderBy(F.desc("pos"), "term")
        .limit(LEXICON_SIZE)
        .collect()
    )
    words = {r["term"][1:] for r in terms if r["term"][0] == "="}
    starts = {r["term"][1:] for r in terms if r["term"][0] == "^"}
    return Lexicon(frozenset(words | set(SEEDS)), frozenset(starts))


@dataclass(frozen=True)
class Trees:
    """Boosted trees of equal depth as arrays: per tree and node a feature and a threshold, per leaf a value."""

    bias: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32) -> Trees:
    """Histogram boosting with the logistic loss and second-order leaf values."""
    mean = min(max(y.mean(), 1e-4), 1 - 1e-4)
    bias = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    # where quantiles coincide, as with counts that are mostly 0, small values need edges of their own
    edges = [np.unique(np.concatenate([e, np.quantile(v, np.linspace(0, 1, 9)[:-1]) if len(v := x[x[:, f] > 0, f]) else [], [0.0]])) for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    width = max(len(e) for e in edges) + 1
    inner, margin = 2**depth - 1, np.full(len(y), bias)
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            best = (1e-6, 0, None)
            if len(at) >= 20:
                gs, hs = g[at].sum(), h[at].sum()
                for f, e in enumerate(edges):
                    b = binned[at, f]
                    gl = np.cumsum(np.bincount(b, g[at], width))[: len(e)]
                    hl = np.cumsum(np.bincount(b, h[at], width))[: len(e)]
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    gain[(hl < 0.5) | (hs - hl < 0.5)] = 0
                    if (i := int(np.argmax(gain))) >= 0 and gain[i] > best[0]:
                        best = (gain[i], f, e[i])
            if best[2] is not None:
                feature[t, k], threshold[t, k] = best[1], best[2]
            node[at] = 2 * k + 1 + (x[at, feature[t, k]] > threshold[t, k])
        node -= inner
        leaf[t] = rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + 1)
        margin += leaf[t][node]
    return Trees(bias, feature, threshold, leaf)


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns the mean score and the mean label of each block, both rising."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([v, 1.0, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            a, n, b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + n, blocks[-1][2] + b]
    found = np.array(blocks).reshape(-1, 3)
    return found[:, 2] / found[:, 1], found[:, 0] / found[:, 1]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: Trees | None
    at: np.ndarray
    calibrated: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated score; a thousandth of the raw one keeps the order within a calibrated block."""
        if self.trees is None:
            return np.full(len(texts), self.calibrated[0])
        raw = 1 / (1 + np.exp(-self.trees.margin(np.array([features(t, self.lexicon) for t in texts]))))
        return np.clip(0.999 * np.interp(raw, self.at, self.calibrated) + 0.001 * raw, 0.0, 1.0)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    small_batches(documents.sparkSession)
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out())
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(F.col("doc_id")), "doc_id")
        .limit(sample_rows)
    )
    sample = stored(
        documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").repartition(12, "doc_id"), "toxicity-sample"
    )
    lexicon = learn_lexicon(sample)
    made = map_rows(
        sample,
        lambda ids, texts, toxic: {
            "doc_id": ids, "x": [features(t, lexicon) for t in texts], "toxic": toxic,
        },
        "doc_id long, x array<double>, toxic int",
        "doc_id", "text", "toxic",
    ).collect()  # at most sample_rows of a few numbers (more only if ids repeat)
    made.sort(key=lambda r: (r["doc_id"], r["x"]))
    x, y = np.array([r["x"] for r in made]).reshape(-1, FEATURES), np.array([float(r["toxic"]) for r in made])
    if len(set(y)) < 2:
        return Model(lexicon, None, np.zeros(1), np.array([y.mean() if len(y) else 0.0]))
    fold = np.array([zlib.crc32(f"fold {r['doc_id']}".encode()) % 4 == 0 for r in made])
    if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
        fold = np.ones(len(y), bool)
    trees = fit_trees(x[~fold] if not fold.all() else x, y[~fold] if not fold.all() else y)
    at, calibrated = fit_isotonic(1 / (1 + np.exp(-trees.margin(x[fold]))), y[fold])
    return Model(lexicon, trees, at, calibrated)


def score(documents: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``documents``' columns ``keep`` (and doc_id) with ``score`` and ``predicted`` of every whole text."""
    out = list(dict.fromkeys(["doc_id", *keep]))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*out).schema)
    names = list(dict.fromkeys([*out, "text"]))

    def scored(*columns):
        by_name = dict(zip(names, columns, strict=True))
        s = model.score(by_name["text"])
        return {n: by_name[n] for n in out} | {"score": s, "predicted": (s >= THRESHOLD).astype(int)}

    return map_rows(documents, scored, f"{types}, score double, predicted int", *names)


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with all their columns."""
    small_batches(documents.sparkSession)

    def keep(parts):
        try:
            for part in parts:
                if part.num_rows:
                    yield part.filter(pa.array(model.score(part.column("text").to_pylist()) < THRESHOLD))
        finally:
            give_back()

    return documents.mapInArrow(keep, documents.schema)


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    scored = score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
