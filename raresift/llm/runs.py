"""Periodic runs of words by maximal pairs in an LCP-interval tree.

A run of period ``q`` is a maximal pair: two equal strings ``q`` words apart
that have different words on their left and different words on their right.
Its string is ``q`` words shorter than the run, so a pair at a distance that
the required exponent allows is exactly a run and needs no extension; of
pairs with one stretch the smallest distance is the period.

A task handles one slice of whole documents at a time: words become numbers,
the suffixes of documents that could hold a run are sorted, common prefixes
of neighbours follow from those that differ on their left (the others are one
shorter than those of the position before), and a bottom-up walk merges the
intervals of the tree.  An interval holds its positions in order, each in the
class of the word on its left; where all its positions are in one class it has
no pair, and neither has any interval inside it.  When two children merge,
each position of the smaller one looks at its nearest neighbours in the larger
one only: equal strings at most half their length apart lie on one arithmetic
progression, so what lies beyond the neighbour gives a multiple of the period.

Documents are never shuffled, and memory follows a slice (one document at
least), not the corpus.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._suffix import suffix_array
from raresift.llm._text import SPACED, Windows, column, covered_spans, find_words, joined_words, mix, text_bytes, text_slices, window_starts

EXPONENT = 4
LEAST = 6
#: Symbols compared at a time when a common prefix is measured.
COMPARED = 1 << 20

RESULT_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long, length:long, period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal exactly for equal words; words hold all bytes that aren't white space."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data[SPACED[data]].tobytes())]
    )
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def shortest_pair(exponent: int, least: int) -> int:
    """Length of the shortest string whose pair is a run."""
    return min(max(least, exponent * d) - d for d in range(1, least + 1))


def may_hold_runs(ids: np.ndarray, first: np.ndarray, left: np.ndarray, exponent: int, least: int) -> np.ndarray:
    """Mask of the documents with equal windows of the shortest pair's length that could begin a run.

    Two of them have different words on their left, and they are at least
    three, or so close that a run needs no third.
    """
    width = shortest_pair(exponent, least)
    out = np.zeros(len(first) - 1, bool)
    at = np.flatnonzero(window_starts(first, width))
    if not len(at):
        return out
    doc = np.searchsorted(first, at, side="right") - 1
    key = mix(Windows(mix(ids.astype(np.uint64))).of(width)[at] + doc.astype(np.uint64))
    by = np.argsort(key, kind="stable")
    key, at, doc = key[by], at[by], doc[by]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begins, len(key)))
    side = left[at]
    mixed = np.minimum.reduceat(side, begins) != np.maximum.reduceat(side, begins)
    gap = np.diff(at, append=np.iinfo(np.int64).max)
    gap[begins[1:] - 1] = np.iinfo(np.int64).max
    close = np.minimum.reduceat(gap, begins) < -(-width // (exponent - 2))
    out[doc[begins[mixed & ((size > 2) | close)]]] = True
    return out


def common_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols agree from a[k] and from b[k] on."""
    most = len(symbols) - np.maximum(a, b)
    length = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(most > 0)
    block = 4
    while len(open_):
        step = np.arange(block)
        x, y = a[open_] + length[open_], b[open_] + length[open_]
        last = len(symbols) - 1
        equal = symbols[np.minimum(x[:, None] + step, last)] == symbols[np.minimum(y[:, None] + step, last)]
        whole = equal.all(axis=1)
        length[open_] += np.where(whole, block, equal.argmin(axis=1))
        open_ = open_[whole & (length[open_] < most[open_])]
        block = max(4, min(block * 2, COMPARED // max(1, len(open_))))
    return np.minimum(length, most)


def neighbour_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in the array with the one before it (0 for the first).

    Only where the symbols on the left differ is the length measured; the
    next position's is one less as long as they agree.
    """
    n = len(order)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    fresh = (before <= 0) | (at == 0)
    inner = np.flatnonzero(~fresh)
    fresh[inner] = symbols[inner - 1] != symbols[before[inner] - 1]
    fresh[order[0]] = True
    heads = np.flatnonzero(fresh)
    measured = np.zeros(len(heads), np.int64)
    real = before[heads] >= 0
    measured[real] = common_lengths(symbols, heads[real], before[heads[real]])
    run = np.cumsum(fresh) - 1
    return (measured[run] - (at - heads[run]))[order]


def pairs_of_interval(places: list[int], prefixes: list[int], left: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """(position, distance, length) of the maximal pairs that are runs, in one interval of the tree and all inside it.

    ``places`` are positions in suffix order; ``prefixes[k]`` is what
    ``places[k]`` shares with ``places[k - 1]``.
    """
    found: list[tuple[int, int, int]] = []

    def merge(a: list[int], b: list[int], depth: int) -> list[int]:
        small, large = (a, b) if len(a) < len(b) else (b, a)
        most = depth // (exponent - 1)
        for x in small:
            k = bisect_left(large, x)
            for y in large[max(0, k - 1) : k + 1]:
                distance = abs(x - y)
                if distance <= most and distance + depth >= least and left[x] != left[y]:
                    found.append((min(x, y), distance, depth))
        for x in small:
            insort(large, x)
        return large

    stack: list[tuple[int, list[int]]] = []
    for k in range(1, len(places) + 1):
        depth = prefixes[k] if k < len(places) else -1
        done = [places[k - 1]]
        while stack and stack[-1][0] >= depth:
            inner, held = stack.pop()
            done = merge(held, done, inner)
            if inner == depth:
                break
        if depth >= 0:
            stack.append((depth, done))
    return found


def runs_of_words(ids: np.ndarray, first: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, in this order; starts count from their document's first word."""
    if exponent < 3 or least < 2:
        raise ValueError("exponent must be 3 or more and least 2 or more")
    left = np.empty(len(ids), np.int64)
    left[1:] = ids[:-1]
    heads = first[:-1][np.diff(first) > 0]
    left[heads] = -1 - heads  # what precedes a document is unlike any word
    docs = np.flatnonzero(may_hold_runs(ids, first, left, exponent, least))
    if not len(docs):
        return np.zeros((0, 4), np.int64)
    size = np.diff(first)[docs]
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) + np.repeat(first[docs] - begin, size)
    # documents share no symbol, so no common prefix leaves its document
    symbols = np.unique(np.repeat(np.arange(len(docs)), size) * (int(ids.max()) + 1) + ids[at], return_inverse=True)[1] + 1
    left = left[at]
    order, _ = suffix_array(symbols.astype(np.uint64), 1, int(size.max()))
    order = order.astype(np.int64)
    prefix = neighbour_prefixes(symbols, order)
    inside = prefix >= shortest_pair(exponent, least)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1)
    found: list[tuple[int, int, int]] = []
    if len(begins):
        sides = left[order]
        bounds = np.stack([begins, ends], axis=1).ravel()
        bounds = bounds[:-1] if bounds[-1] == len(sides) else bounds
        mixed = np.minimum.reduceat(sides, bounds)[::2] != np.maximum.reduceat(sides, bounds)[::2]
        for a, b in zip(begins[mixed].tolist(), ends[mixed].tolist()):
            found += pairs_of_interval(order[a:b].tolist(), prefix[a:b].tolist(), left, exponent, least)
    if not found:
        return np.zeros((0, 4), np.int64)
    place, distance, depth = np.array(found, np.int64).T
    doc = np.searchsorted(begin, place, side="right") - 1
    rows = np.stack([docs[doc], place - begin[doc], depth + distance, distance], axis=1)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch with several distances has the smallest as its period
    new = np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST
) -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period) and collapsed.

    A run is a stretch of consecutive words with smallest period ``q`` and
    at least max(least, exponent * q) words that no neighbouring word
    extends.  ``collapsed`` has the words joined by one space, without those
    that some run holds after its first ``q`` words.  Null and empty texts
    have no words and no runs.  Rows are judged one by one, so repeated rows
    and null ids get results of their own; columns beyond the two are left
    out.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, offsets = text_bytes(column(batch, "text"))
            starts, ends, first = find_words(data, offsets, SPACED)
            runs = runs_of_words(word_numbers(data, starts, ends), first, exponent, least)
            doc, start, length, period = runs.T
            gone = covered_spans(first[doc] + start + period, first[doc] + start + length, len(starts))
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            items = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(_RUNS.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items),
                    joined_words(data, starts, ends, first, ~gone),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return rows.mapInArrow(search, RESULT_SCHEMA)
