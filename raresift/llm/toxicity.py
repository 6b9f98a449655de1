"""Toxic passages as maximum-scoring segments, and a calibrated score per document.

Fitting: tokens (words and their first letters) get log-odds between toxic
and other labelled documents with an informative Dirichlet prior; those far
enough from zero in standard deviations form the lexicon.  Scoring: every
word counts its best token's weight (log-odds at the cautious end), wherever
it occurs, or a small loss; all maximal segments with a positive sum are found in one linear scan (Ruzzo and Tompa).  By Karlin-Altschul
statistics a segment of score S in n words is expected K n exp(-lambda S)
times by chance; segments expected less than ``MAX_EXPECTED`` times are
passages, and a document's evidence is the sum of their -ln E.  A logistic
curve through the training rows turns evidence into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._labels import MAX_TRAINING, held_out, training_rows
from raresift.llm._ship import ship
from raresift.llm._text import ALNUM, column, find_words, hash_words, lower_ascii, mix, text_bytes, text_slices
from raresift.operators.persist import materialize

PREFIXES = (4, 5, 6)
#: Share of a token's own count that its prior weighs.
PRIOR_SHARE = 0.05
#: Tokens of the lexicon are this many standard deviations, and this odds ratio, on the toxic side.
MIN_Z, MIN_RATIO = 4.0, 8.0
#: A token's weight is its log-odds less so many standard deviations.
HELD_BACK = 2.0
LOSS = 0.5
K = 0.1
MAX_EXPECTED = 0.05
THRESHOLD = 0.5

SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_passages long"
PASSAGE_SCHEMA = "doc_id long, start long, end long, score double, log_expected double"


@dataclass
class ToxicityModel:
    """Sorted token hashes with their weights, lambda, and the curve's intercept and slope."""

    tokens: np.ndarray
    weights: np.ndarray
    decay: float
    intercept: float
    slope: float

    def __post_init__(self) -> None:
        #: A token can only be known where the low bits of its hash are marked.
        self.marks = np.zeros(1 << 20, bool)
        self.marks[self.tokens & np.uint64((1 << 20) - 1)] = True

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.intercept + self.slope * math.log1p(evidence)))))


def token_kinds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, token) for whole words, then for each length of prefix of longer words."""
    yield np.arange(len(starts)), hash_words(data, starts, ends)
    for size in PREFIXES:
        longer = np.flatnonzero(ends - starts > size)
        yield longer, mix(hash_words(data, starts[longer], starts[longer] + size) ^ np.uint64(size))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    return data, *find_words(data, offsets, ALNUM)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal segments [start, end) with positive sum, in linear time.

    Each open segment knows the nearest one before it that begins at a lower
    sum, so a search never steps through what lies between; once none does,
    all open segments are final.
    """
    total = 0.0
    done: list[tuple[int, int, float]] = []
    open_: list[tuple[int, int, float, float, int]] = []  # start, end, sum before start, sum at end, nearest lower
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, left, j = i, before, len(open_) - 1
        while True:
            while j >= 0 and open_[j][2] >= left:
                j = open_[j][4]
            if j < 0:
                done += [(a, b, right - low) for a, b, low, right, _ in open_]
                open_.clear()
            if j < 0 or open_[j][3] >= total:
                open_.append((start, i + 1, left, total, j))
                break
            start, _, left, _, lower = open_[j]
            del open_[j:]
            j = lower
    return done + [(a, b, right - low) for a, b, low, right, _ in open_]


def passages(model: ToxicityModel, texts: pa.Array) -> list[list[tuple[int, int, float, float]]]:
    """Of each text, its passages: first and past-last byte, score, and log of the number expected by chance."""
    data, starts, ends, first = _words(texts)
    weight = np.zeros(len(starts))
    low = np.uint64((1 << 20) - 1)
    for index, tokens in token_kinds(data, starts, ends):
        hit = np.flatnonzero(model.marks[tokens & low])
        at = np.searchsorted(model.tokens, tokens[hit])
        at = np.minimum(at, max(0, len(model.tokens) - 1))
        true = hit[model.tokens[at] == tokens[hit]] if len(model.tokens) else hit[:0]
        found = model.weights[np.searchsorted(model.tokens, tokens[true])]
        np.maximum.at(weight, index[true], found)
    hits = np.flatnonzero(weight > 0)
    doc = np.searchsorted(first, hits, side="right") - 1
    out: list[list[tuple[int, int, float, float]]] = [[] for _ in range(len(first) - 1)]
    bytes_before = text_bytes(texts)[1]
    for d in np.unique(doc).tolist():
        own = hits[doc == d] if len(hits) < 64 else hits[np.searchsorted(doc, d) : np.searchsorted(doc, d, side="right")]
        # words between two hits lose together; the scan sees hit, gap, hit, ...
        scores: list[float] = []
        for k, at in enumerate(own.tolist()):
            if k:
                scores.append(-LOSS * (at - int(own[k - 1]) - 1))
            scores.append(float(weight[at]))
        n = int(first[d + 1] - first[d])
        for a, b, score in maximal_segments(scores):
            log_expected = math.log(K * n) - model.decay * score
            if log_expected < math.log(MAX_EXPECTED):
                begin, end = starts[own[a // 2]], ends[own[(b - 1) // 2]]
                out[d].append((int(begin - bytes_before[d]), int(end - bytes_before[d]), score, log_expected))
    return out


def evidence(found: list[tuple[int, int, float, float]]) -> float:
    return -sum(log_expected for _, _, _, log_expected in found)


def _decay(share: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1 over the words of other documents."""
    rest = 1 - share.sum()

    def excess(x: float) -> float:
        return float((share * np.exp(x * weights)).sum() + rest * math.exp(-x * LOSS) - 1)

    low, high = 1e-6, 1e-6
    while excess(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through (log evidence, label, rows), lightly held back."""
    x = np.array([p[0] for p in points])
    y = np.array([p[1] for p in points], float)
    n = np.array([p[2] for p in points], float)
    design, beta, hold = np.stack([np.ones_like(x), x], axis=1), np.zeros(2), np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (n * (y - p)) - hold @ beta
        curvature = (design * (n * p * (1 - p) + 1e-9)[:, None]).T @ design + hold
        move = np.linalg.solve(curvature, slope)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_TRAINING
) -> ToxicityModel:
    """Fit on the labelled rows outside the held-out fold.

    At most ``max_rows`` rows, so the model, which every task gets, is bounded
    by the distinct tokens of that many rows.  Without rows of both kinds the lexicon is empty and every score is the share of
    toxic rows.
    """
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, label_col, max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 8 << 20):
            data, starts, ends, first = _words(column(batch, "text"))
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
            y = column(batch, "y").to_numpy()
            for index, tokens in token_kinds(data, starts, ends):
                by = np.lexsort((doc[index], tokens))
                tokens, own = tokens[by], doc[index][by]
                new = np.ones(len(tokens), bool)
                new[1:] = (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])
                tokens, toxic = tokens[new], y[own[new].astype(np.int64)] > 0
                kinds, at, many = np.unique(tokens, return_index=True, return_counts=True)
                hits = np.add.reduceat(toxic.astype(np.int64), at) if len(at) else many
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds.view(np.int64)), pa.array(hits), pa.array(many - hits)], ["token", "toxic", "other"]
                )

    counts = rows.mapInArrow(count, "token long, toxic long, other long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    counts = materialize(counts, "token-counts")
    size = rows.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    sums = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    n_toxic, n_other = float(sums.toxic or 0), float(sums.other or 0)
    if not n_toxic or not n_other:
        share = float(size.toxic or 0) / max(1.0, float(size.n or 0))
        odds = math.log((share + 1e-3) / (1 - share + 1e-3))
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 1.0, odds, 0.0)
    both = F.col("toxic") + F.col("other")
    prior = both * PRIOR_SHARE
    toxic, other = F.col("toxic") + prior, F.col("other") + prior
    spread = F.sqrt(1 / toxic + 1 / other)
    odds = F.log(toxic / (n_toxic * (1 + PRIOR_SHARE))) - F.log(other / (n_other * (1 + PRIOR_SHARE)))
    terms = (
        counts.filter("toxic > 1")
        .withColumn("odds", odds)
        .withColumn("z", F.col("odds") / spread)
        .withColumn("weight", F.col("odds") - HELD_BACK * spread)
        .filter((F.col("z") >= MIN_Z) & (F.col("odds") >= math.log(MIN_RATIO)))
        .collect()
    )
    tokens = np.array([t.token for t in terms], np.int64).view(np.uint64)
    by = np.argsort(tokens)
    weights = np.array([t.weight for t in terms], float)[by]
    # share of words of other documents, at about one word of a kind in each
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 1
    share = (np.array([t.other + PRIOR_SHARE * (t.toxic + t.other) for t in terms], float)[by]) / max(1, words)
    share = share * min(1.0, 0.5 / max(share.sum(), 1e-12)) if share.sum() > 0.5 else share
    model = ToxicityModel(tokens[by], weights, _decay(share, weights) if len(terms) else 1.0, 0.0, 1.0)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            x = [math.log1p(evidence(found)) for found in passages(model, column(batch, "text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.array(x) * 20) / 20), column(batch, "y")], ["x", "y"])

    points = rows.mapInArrow(weigh, "x double, y int").groupBy("x", "y").count().collect()
    model.intercept, model.slope = _curve([(p.x, p.y, p["count"]) for p in points])
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted and n_passages.

    Every row is scored by itself (repeated rows and ids are all returned);
    null and empty texts have no evidence and get the curve's lowest score.
    """
    ship(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            found = passages(model, column(batch, "text"))
            p = [model.probability(evidence(f)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    column(batch, "held_out"),
                    pa.array(p, pa.float64()),
                    pa.array([int(x >= THRESHOLD) for x in p], pa.int32()),
                    pa.array([len(f) for f in found], pa.int64()),
                ],
                ["doc_id", "held_out", "score", "predicted", "n_passages"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out("doc_id").alias("held_out"),
    ).mapInArrow(score, SCORE_SCHEMA)


def toxic_passages(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per passage: doc_id, byte span in the text, score, and log of the number expected by chance."""
    ship(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            ids = column(batch, "doc_id").to_pylist()
            rows = [(i, *p) for i, found in zip(ids, passages(model, column(batch, "text")), strict=True) for p in found]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "end", "score", "log_expected"]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(search, PASSAGE_SCHEMA)


def remove_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents scored under the threshold, with all their columns as they were."""
    ship(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            found = passages(model, column(batch, "text"))
            yield batch.filter(pa.array([model.probability(evidence(f)) < THRESHOLD for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
