"""Quality scores from a sparse ensemble of rules over text statistics.

Trees over the statistics of labelled documents are taken apart into their
paths; each path is a conjunction of bounds, a rule.  A lasso logistic
regression over the rules keeps few of them, and those are compiled into one
Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.llm._labels import MAX_TRAINING, held_out, training_rows
from raresift.llm._ship import ship
from raresift.llm._text import SPACED, U, Windows, byte_class, column, find_words, hash_words, text_bytes, text_slices
from raresift.operators.persist import materialize

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "letters", "digits", "upper", "marks", "symbols", "unique_words",
    "top_word", "repeated_next", "odd_ends", "ended_lines", "repeated_lines",
]
TREES, DEPTH, SEED = 20, 3, 7
LASSO = 0.001
THRESHOLD = 0.3

_LETTER, _DIGIT, _UPPER, _SPACE, _MARK, _SYMBOL = range(6)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_KIND[range(ord("A"), ord("Z") + 1)] = _UPPER
_KIND[range(ord("0"), ord("9") + 1)] = _DIGIT
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = _MARK
_LINE = byte_class(b for b in range(256) if b != 0x0A)
_LINE_END = byte_class(map(ord, ".!?"))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text; an empty or null text has zeros."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    size = np.diff(offsets)
    kinds = np.bincount(np.repeat(np.arange(n) * 6, size) + _KIND[data], minlength=6 * n).reshape(n, 6)
    starts, ends, first = find_words(data, offsets, SPACED)
    words = np.diff(first)
    ids = hash_words(data, starts, ends)
    doc = np.repeat(np.arange(n), words)

    def per_doc(mask: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n)

    # equal words of a document are neighbours once sorted by (hash, document)
    tagged = np.sort((ids << U(21)) | doc.astype(U))
    new = np.ones(len(tagged), bool)
    new[1:] = tagged[1:] != tagged[:-1]
    begins = np.flatnonzero(new)
    owner = (tagged[begins] & U((1 << 21) - 1)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, np.diff(np.append(begins, len(tagged))))
    next_same = np.zeros(len(ids), bool)
    next_same[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    odd = _KIND[data[ends - 1]] == _SYMBOL if len(ends) else np.zeros(0, bool)

    line_starts, line_ends, line_first = find_words(data, offsets, _LINE)
    lines = np.diff(line_first)
    line_doc = np.repeat(np.arange(n), lines)
    ended = _LINE_END[data[line_ends - 1]] if len(line_ends) else np.zeros(0, bool)
    hashes = Windows(ids).spans(np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends))
    again = np.ones(len(hashes), bool)
    by = np.lexsort((hashes, line_doc))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[by][1:] == hashes[by][:-1]) & (line_doc[by][1:] == line_doc[by][:-1])
    again[by] = same

    def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return count / np.maximum(whole, 1)

    return np.stack(
        [
            np.log1p(size), np.log1p(words), share(size - kinds[:, _SPACE], words),
            share(kinds[:, _LETTER], size), share(kinds[:, _DIGIT], size), share(kinds[:, _UPPER], size),
            share(kinds[:, _MARK], size), share(kinds[:, _SYMBOL], size),
            share(np.bincount(owner, minlength=n), words), share(top, words),
            share(per_doc(next_same, doc), words), share(per_doc(odd, doc), words),
            share(per_doc(ended, line_doc), lines), share(per_doc(again, line_doc), lines),
        ],
        axis=1,
    )


def with_statistics(rows: DataFrame) -> DataFrame:
    """(text, ...) to (..., one column per statistic); the texts are left behind."""
    ship(rows.sparkSession)
    others = [c for c in rows.columns if c != "text"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"] + [f"{s} double" for s in STATISTICS]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            values = statistics(column(batch, "text"))
            arrays = [column(batch, c) for c in others] + [pa.array(values[:, i].copy()) for i in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays(arrays, others + STATISTICS)

    return rows.mapInArrow(measure, schema)


#: A rule: for each statistic it binds, the values it takes lie in (low, high].
Rule = tuple[tuple[str, float, float], ...]


@dataclass
class QualityModel:
    rules: list[tuple[Rule, float]]
    intercept: float

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, low, high in rule:
        if low > float("-inf"):
            out = out & (F.col(name) > low)
        if high < float("inf"):
            out = out & (F.col(name) <= high)
    return out


def tree_rules(tree) -> list[Rule]:
    """The path to every node of a fitted tree, as a rule."""
    found: list[Rule] = []

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            found.append(tuple((k, *v) for k, v in sorted(bounds.items())))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], float(split.threshold())
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        walk(node.leftChild(), bounds | {name: (low, min(high, at))})
        walk(node.rightChild(), bounds | {name: (max(low, at), high)})

    walk(tree._call_java("rootNode"), {})
    return found


def fit_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_TRAINING
) -> QualityModel:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold.

    Without rows of both kinds there are no rules, and every score is the
    share of good rows.
    """
    rows = materialize(with_statistics(training_rows(docs, labels, label_col, max_rows)), "quality-training")
    size = rows.agg(F.sum("y").alias("good"), F.count("*").alias("n")).first()
    good, n = float(size.good or 0), float(size.n or 0)
    share = min(max(good / max(n, 1.0), 1e-3), 1 - 1e-3)
    if not 0 < good < n:
        return QualityModel([], float(np.log(share / (1 - share))))
    features = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("y").cast("double").alias("label"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird", minInstancesPerNode=5
    ).fit(features)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree)})
    held = F.array(*[condition(rule).cast("double") for rule in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(
        rows.select(array_to_vector(held).alias("features"), F.col("y").cast("double").alias("label"))
    )
    weights = lasso.coefficients.toArray()
    return QualityModel([(r, float(w)) for r, w in zip(rules, weights, strict=True) if w], float(lasso.intercept))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per document: doc_id, held_out, score (that its label is 1), predicted.

    Every row is scored by itself from its whole text; null and empty texts
    are scored by their statistics, which are all zero.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id").alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = with_statistics(rows).withColumn("score", model.column())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
