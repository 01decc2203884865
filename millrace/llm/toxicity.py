"""Toxicity by maximum-scoring segment search.

Tokens get log-odds of toxic against clean texts under an informative Dirichlet prior; tokens
whose log-odds are not significant get a small negative score. A word too rare to be judged by
itself is judged by its beginnings, the longest significant one. One linear scan of a text finds
all its maximal scoring segments. Their scores are read against the extreme values that clean
text of that length makes (the Karlin-Altschul sum statistic), and a logistic curve turns the
resulting evidence into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .common import arrow_map, as_bytes, folded_words, kept, struct


#: Lengths in characters of the beginnings of words.
BEGINNINGS = (6, 5, 4, 3)
CACHED_WORDS = 300_000


@dataclass
class Model:
    words: dict[str, float | None]  # None: frequent, and not significant
    beginnings: dict[str, float]
    background: float
    scale: float
    frequency: float
    slope: float
    offset: float


class Scores(dict):
    """Word to score, None for the background; remembers the latest few hundred thousand."""

    def __init__(self, words: dict[str, float | None], beginnings: dict[str, float]):
        super().__init__()
        self.words, self.beginnings = words, beginnings

    def __missing__(self, word: bytes) -> float | None:
        said = word.decode()
        value = self.words[said] if said in self.words else next((self.beginnings[said[:k]] for k in BEGINNINGS if len(said) >= k and said[:k] in self.beginnings), None)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


def segments(words: list[bytes], scores: Scores, background: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in time linear in the words.

    Of the segments whose score is positive these are the disjoint ones that no neighbour
    improves. ``background`` is the negative score of a token without an entry.
    """
    total, last = 0.0, 0
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, the nearest with a lower sum before
    for at, score in [(i, s) for i, s in enumerate(map(scores.__getitem__, words)) if s is not None]:
        total += background * (at - last)
        last = at + 1
        if score <= 0:
            total += score
            continue
        start, before = at, total
        total += score
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                stack.append((start, at + 1, before, total, k))
                break
            start, before = stack[k][0], stack[k][2]
            del stack[k:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def evidence(found: list[tuple[int, int, float]], n: int, scale: float, frequency: float) -> float:
    """The greatest excess of the r best segments over what chance makes in n words, over all r."""
    chance = math.log1p(frequency * n)
    best, total = -chance, 0.0
    for r, score in enumerate(sorted((x[2] for x in found), reverse=True), 1):
        total += scale * score - chance
        best = max(best, total + math.lgamma(r + 1))
    return best


def _sketch(text: bytes | None, width: int = 5) -> int:
    """The smallest hash of the text's word shingles: near copies mostly share it."""
    words = folded_words(text)
    return min((xxhash.xxh64_intdigest(b" ".join(words[k : k + width])) >> 1 for k in range(max(1, len(words) - width + 1))), default=0)


def _odds(sample: DataFrame, tokens: Callable[[set[bytes]], set[str]], share: float) -> DataFrame:
    """(token, t, c, odds, z): documents of either class that hold a token, and its log-odds.

    The prior of each class is ``share`` of the token's count in both, so that a token must be
    seen often before its odds are far from even.
    """

    def count(batch: pa.RecordBatch) -> list:
        seen: dict[str, list[int]] = {}
        for y, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            for token in tokens(set(folded_words(text))):
                seen.setdefault(token, [0, 0])[y > 0] += 1
        return [list(seen), [c[1] for c in seen.values()], [c[0] for c in seen.values()]]

    counted = arrow_map(sample, struct(("token", "string"), ("toxic", "bigint"), ("clean", "bigint")), count).groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    n = sample.agg(F.count_if(F.col("y") > 0).alias("t"), F.count_if(F.col("y") <= 0).alias("c")).first()
    n_t, n_c = n["t"] + 1.0, n["c"] + 1.0
    prior = (F.col("t") + F.col("c")) * share
    y_t, y_c = F.col("t") + prior, F.col("c") + prior
    odds = F.log(y_t / n_t) - F.log(y_c / n_c)
    return counted.withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / y_t + 1 / y_c))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = 20_000, share: float = 0.05, significant: float = 4.0, effect: float = 1.6, frequent: int = 20, tokens: int = 50_000, background: float = -0.1) -> Model:
    """Fit on ``rows`` labelled rows at most, chosen by a hash of the id, near copies once.

    Counts are documents that hold a token. The model keeps all significant words of those rows,
    and ``tokens`` at most of the other ``frequent`` ones and of the significant beginnings, so
    that its size has a bound. Significant are log-odds of at least ``effect`` and so many standard
    errors: toxic texts are to be found, not clean ones. Rows without an id or label teach nothing; of several labels of one
    document the largest counts.
    """
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("id", "y", "text")
    keyed = arrow_map(texts, struct(("id", docs.schema[id_col].dataType), ("y", "int"), ("text", "string"), ("sketch", "bigint")), lambda b: [b.column(0), b.column(1), b.column(2), [_sketch(t) for t in as_bytes(b.column(2))]])
    first = keyed.groupBy("sketch").agg(F.min("id").alias("id"))
    sample = durable(keyed.join(first, ["sketch", "id"]).select("y", "text"))

    telling = (F.col("z") >= significant) & (F.col("odds") >= effect)
    by_word = durable(_odds(sample, lambda words: {w.decode() for w in words}, share).filter((F.col("t") + F.col("c") >= frequent) | telling).withColumn("telling", telling))
    frequent_words = by_word.filter("NOT telling").orderBy((F.col("t") + F.col("c")).desc(), "token").limit(tokens)
    known = by_word.filter("telling").unionAll(frequent_words).collect()
    words = {r["token"]: float(r["odds"]) if r["telling"] else None for r in known}

    def starts(seen: set[bytes]) -> set[str]:
        rare = [w for w in (x.decode() for x in seen) if w not in words]
        return {w[:k] for w in rare for k in BEGINNINGS if len(w) >= k}

    begun = _odds(sample, starts, share).filter(telling).orderBy(F.col("z").desc(), "token").limit(tokens).collect()
    beginnings = {r["token"]: float(r["odds"]) for r in begun}
    clean_docs = sample.filter("y <= 0").count()
    if not clean_docs or clean_docs == sample.count():
        return Model(words, beginnings, background, 1.0, 1.0, 0.0, -6.0)

    held: dict[str, int] = {r["token"]: r["c"] for r in known if words[r["token"]] is not None} | {r["token"]: r["c"] for r in begun}
    schema = struct(("y", "int"), ("n", "bigint"), ("found", "array<double>"))

    def score(level: float) -> list:
        def rows_of(batch: pa.RecordBatch) -> list:
            scores = Scores(words, beginnings)
            texts = [folded_words(t) for t in as_bytes(batch.column(1))]
            return [batch.column(0), [len(w) for w in texts], [[x[2] for x in segments(w, scores, level)] for w in texts]]

        return arrow_map(sample, schema, rows_of).collect()

    lengths = sample.filter("y <= 0").agg(F.sum(F.size(F.split("text", " "))).alias("n")).first()["n"] or 1
    dist = [(c / lengths, words.get(t) if words.get(t) is not None else beginnings[t]) for t, c in held.items()]
    level = min(background, -2 * max(0.0, sum(p * s for p, s in dist)) - 1e-3)
    scale = _scale(dist, level)
    fitted = score(level)
    clean = [r for r in fitted if r["y"] <= 0]
    frequency = (1 + sum(len(r["found"]) for r in clean)) / (1 + sum(r["n"] for r in clean))
    x = np.array([evidence([(0, 0, s) for s in r["found"]], r["n"], scale, frequency) for r in fitted])
    slope, offset = _logistic(x, np.array([float(r["y"] > 0) for r in fitted]))
    return Model(words, beginnings, level, scale, frequency, slope, offset)


def _scale(dist: list[tuple[float, float]], background: float) -> float:
    """The positive root of the sum of p e^(scale s) = 1, over the tokens of clean text."""
    rest = 1 - sum(p for p, _ in dist)
    value = lambda x: sum(p * math.exp(min(700.0, x * s)) for p, s in dist) + rest * math.exp(x * background) - 1
    if not any(s > 0 and p > 0 for p, s in dist):
        return 1.0
    low, high = 0.0, 0.01
    while value(high) < 0 and high < 100:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if value(mid) > 0 else (mid, high)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, by damped Newton steps."""
    middle, spread = float(np.median(x)), float(x.std() or 1.0)
    a = np.stack([(x - middle) / spread, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(0.0, w[0] / spread)
    return float(slope), float(w[1] - slope * middle)


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted, passages.

    ``passages`` lists the maximal scoring segments (start, end in words, score, expected
    number by chance). Null and empty texts have no words and get the score of no evidence. Null
    ids and repeated rows are judged each on its own, other columns, whatever their names, aren't
    read, an empty table gives none, and a text of any length takes time in proportion.
    """
    schema = struct((id_col, docs.schema[id_col].dataType), ("score", "double"), ("predicted", "int"), ("passages", "array<struct<start: bigint, end: bigint, score: double, expected: double>>"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> list:
        m = sent.value
        known = kept(m, lambda: Scores(m.words, m.beginnings))
        scores, passages = [], []
        for text in as_bytes(batch.column(1)):
            words = folded_words(text)
            found = segments(words, known, m.background)
            x = m.slope * evidence(found, len(words), m.scale, m.frequency) + m.offset
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))))
            passages.append([{"start": a, "end": b, "score": s, "expected": m.frequency * len(words) * math.exp(-min(700.0, m.scale * s))} for a, b, s in found])
        return [batch.column(0), scores, [int(s >= 0.5) for s in scores], passages]

    return arrow_map(docs.select(id_col, text_col), schema, rows)
