"""Benchmark decontamination with suffix arrays over the training documents.

Every task cuts its documents into shards and sorts each shard's word
suffixes.  All benchmark suffixes are binary-searched in every shard's array:
equal ranges give all occurrences of a window, neighbours in the array give
the longest verbatim match.  The documents are never shuffled.  The benchmark
is sent to the tasks in chunks of checked size, one pass over the documents
for each chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._suffix import suffix_array
from raresift.llm._text import ALNUM, Windows, column, covered, find_words, hash_words, lower_ascii, text_bytes, text_slices
from raresift.operators.persist import materialize

WINDOW = 10
CHUNK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
#: Depth in words to which shards are sorted; longer matches are compared word by word.
DEPTH = 64

RESULT_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
MATCH_SCHEMA = "item_id string, item_start long, doc_id long, doc_start long, length long"


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words with a 0 after each text, and n + 1 offsets (the zeros included)."""
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offsets, ALNUM)
    ids = hash_words(data, starts, ends)
    ids[ids == 0] = 1
    return np.insert(ids, first[1:], 0), first + np.arange(len(first))


class Items:
    """A chunk of benchmark items, ready to be searched for."""

    def __init__(self, item_ids: list[str], texts: list[str | None], window: int):
        self.item_ids = item_ids
        ids, offsets = word_ids(pa.array(texts, pa.string()))
        sizes = np.diff(offsets) - 1
        width = np.minimum(sizes, window)
        owner = np.repeat(np.arange(len(item_ids)), np.where(sizes > 0, sizes - width + 1, 0))
        begin = np.concatenate([np.arange(o, o + s - w + 1) for o, s, w in zip(offsets, sizes, width) if s > 0] or [np.zeros(0, np.int64)]).astype(np.int64)
        #: symbols of all items; 1 << 64 - 1 stands past the end and is no word's id in practice
        self.ids = np.append(ids, np.zeros(DEPTH, np.uint64))
        long = width[owner]
        # equal windows are searched once; ``owners`` lists the items of each
        hashes = Windows(ids).spans(begin, begin + long)
        _, where, index = np.unique(hashes, return_index=True, return_inverse=True)
        self.begin, self.width = begin[where], long[where]
        by = np.lexsort((owner, index))
        pairs = np.unique(np.stack([index[by], owner[by]]), axis=1)
        self.owners = pairs[1]
        self.owner_at = np.searchsorted(pairs[0], np.arange(len(where) + 1))
        # every suffix of every item, for the longest matches
        self.suffix = np.flatnonzero(ids != 0)
        self.suffix_item = np.searchsorted(offsets, self.suffix, side="right") - 1
        self.suffix_start = self.suffix - offsets[self.suffix_item]


class Shard:
    """The sorted word suffixes of some documents."""

    def __init__(self, texts: pa.Array):
        self.ids, self.offsets = word_ids(texts)
        self.order, _ = suffix_array(self.ids, 1, DEPTH)
        self.padded = np.append(self.ids, np.zeros(DEPTH + 1, np.uint64))

    def _compare(self, ids: np.ndarray, query: np.ndarray, at: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sign, shared) of each suffix against each query, over ``width`` words at most."""
        shared = np.zeros(len(query), np.int64)
        sign = np.zeros(len(query), np.int8)
        left = np.flatnonzero(width > 0)
        while len(left):
            mine, theirs = self.padded[at[left] + shared[left]], ids[query[left] + shared[left]]
            # past a document's or an item's end nothing is shared
            equal = (mine == theirs) & (mine != 0)
            differ = left[~equal]
            sign[differ] = np.where(mine[~equal] < theirs[~equal], -1, 1)
            left = left[equal]
            shared[left] += 1
            left = left[shared[left] < width[left]]
        return sign, shared

    def bounds(self, ids: np.ndarray, query: np.ndarray, width: np.ndarray, right: bool) -> np.ndarray:
        """Where each query of ``width`` words begins (or ends) among the sorted suffixes."""
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(self.order), np.int64)
        while len(live := np.flatnonzero(low < high)):
            middle = (low[live] + high[live]) // 2
            sign, _ = self._compare(ids, query[live], self.order[middle].astype(np.int64), width[live])
            under = sign <= 0 if right else sign < 0
            low[live[under]] = middle[under] + 1
            high[live[~under]] = middle[~under]
        return low

    def occurrences(self, items: Items) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every occurrence of every window."""
        low = self.bounds(items.ids, items.begin, items.width, right=False)
        # a window that isn't there needs no second search
        first = self.order[np.minimum(low, len(self.order) - 1)].astype(np.int64) if len(self.order) else low
        there = np.zeros(len(low), bool)
        if len(self.order):
            _, shared = self._compare(items.ids, items.begin, first, items.width)
            there = (shared >= items.width) & (low < len(self.order))
        found = np.flatnonzero(there)
        high = self.bounds(items.ids, items.begin[found], items.width[found], right=True)
        many = high - low[found]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return self.order[np.repeat(low[found], many) + step].astype(np.int64), np.repeat(found, many)

    def longest(self, items: Items, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, place, length) of all longest matches of every item suffix that has one of ``least`` words."""
        n = len(items.suffix)
        if not len(self.order) or not n:
            return (np.zeros(0, np.int64),) * 3
        width = np.full(n, DEPTH, np.int64)
        low = self.bounds(items.ids, items.suffix, width, right=False)
        best = np.zeros(n, np.int64)
        for side in (0, -1):
            at = self.order[np.clip(low + side, 0, len(self.order) - 1)].astype(np.int64)
            best = np.maximum(best, self._compare(items.ids, items.suffix, at, width)[1])
        # every place that shares as many words
        some = np.flatnonzero(best >= max(1, min(least, DEPTH)))
        first = self.bounds(items.ids, items.suffix[some], best[some], right=False)
        many = self.bounds(items.ids, items.suffix[some], best[some], right=True) - first
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        which = np.repeat(some, many)
        place, length = self.order[np.repeat(first, many) + step].astype(np.int64), best[which]
        # the array is sorted to DEPTH words: beyond, words are compared to the end
        open_ = np.flatnonzero(length == DEPTH)
        while len(open_):
            mine, theirs = self.ids[place[open_] + length[open_]], items.ids[items.suffix[which[open_]] + length[open_]]
            open_ = open_[(mine == theirs) & (mine != 0)]
            length[open_] += 1
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, which, length)
        good = length == longest[which]
        return which[good], place[good], length[good]


def _chunks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Items]:
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.col(text_col).cast("string").alias("text")
    ).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // CHUNK_BYTES))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id").collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows], window)


def _search(texts: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]]]:
    """Of each text: word offsets (a zero after each text), hit mask over them, and its items' ids."""
    shard = Shard(texts)
    places, windows = shard.occurrences(items)
    hit = np.zeros(len(shard.ids), bool)
    widths = items.width[windows]
    for width in np.unique(widths).tolist():
        hit |= covered(np.sort(places[widths == width]), width, len(hit))
    doc = np.searchsorted(shard.offsets, places, side="right") - 1
    seen = np.unique((doc << 32) | windows)
    doc, windows = seen >> 32, seen & 0xFFFFFFFF
    many = items.owner_at[windows + 1] - items.owner_at[windows]
    step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    pairs = np.unique((np.repeat(doc, many) << 32) | items.owners[np.repeat(items.owner_at[windows], many) + step])
    names: list[list[str]] = [[] for _ in range(len(shard.offsets) - 1)]
    for d, i in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True):
        names[d].append(items.item_ids[i])
    return shard.offsets, hit, np.diff(shard.offsets) - 1, names


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated.

    A word is hit if it lies in an occurrence of ``window`` consecutive words
    of a benchmark item (or of a whole item of fewer words).  Null and empty
    texts have no words; every row is judged by itself, so repeated rows and
    ids are all returned.  Null item ids count as the empty string; equal
    items count once.  An empty benchmark hits nothing.
    """
    ship(docs.sparkSession)
    state = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    done, items = state, None
    for chunk in _chunks(benchmark, item_col, item_text_col, window):
        if items is not None:
            done = materialize(done.mapInArrow(_pass(items, last=False), state.schema), "hits")
        items = chunk
    return done.mapInArrow(_pass(items, last=True), RESULT_SCHEMA)


def _pass(items: Items, last: bool):
    """A pass over documents and what earlier chunks hit; the last one returns the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SHARD_BYTES):
            offsets, hit, n_words, names = _search(column(batch, "text"), items)
            olds, hits = column(batch, "hits").to_pylist(), []
            names = [sorted({*old, *new}) for old, new in zip(column(batch, "items").to_pylist(), names, strict=True)]
            for i, old in enumerate(olds):
                own = hit[offsets[i] : offsets[i + 1] - 1]
                if old:
                    own = own | np.unpackbits(np.frombuffer(old, np.uint8), count=len(own)).astype(bool)
                hits.append(int(own.sum()) if last else np.packbits(own).tobytes())
            if not last:
                arrays = [column(batch, "doc_id"), column(batch, "text"), pa.array(hits, pa.binary()), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "hits", "items"])
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array([len(n) for n in names], pa.int64()),
                    pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
                    pa.array([h > 0 for h in hits], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return run


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The documents without any hit word, with all their columns as they were."""
    ship(docs.sparkSession)
    schema = docs.schema
    for items in _chunks(benchmark, item_col, item_text_col, window):

        def keep(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, text_col, SHARD_BYTES):
                offsets, hit, _, _ = _search(column(batch, text_col).cast(pa.string()), items)
                hits = np.diff(np.concatenate([[0], np.cumsum(hit)])[offsets])
                yield batch.filter(pa.array(hits == 0))

        docs = docs.mapInArrow(keep, schema)
    return docs


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """In each shard, where every benchmark suffix matches longest: item, document, starts and words.

    Every place of a longest match is listed, whatever its length.  Only
    matches of ``least`` words or more that don't go on to the left.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in _chunks(benchmark, item_col, item_text_col, least):

        def search(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text", SHARD_BYTES):
                shard = Shard(column(batch, "text"))
                which, place, length = shard.longest(items, least)
                # a match goes on to the left where the words before both are equal
                left, mine = items.ids[items.suffix[which] - 1], shard.ids[place - 1]
                extends = (items.suffix_start[which] > 0) & (place > 0) & (left == mine) & (left != 0)
                good = np.flatnonzero((length >= least) & ~extends)
                doc = np.searchsorted(shard.offsets, place[good], side="right") - 1
                ids = column(batch, "doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([items.item_ids[i] for i in items.suffix_item[which[good]]], pa.string()),
                        pa.array(items.suffix_start[which[good]], pa.int64()),
                        pa.array([ids[d] for d in doc], pa.int64()),
                        pa.array(place[good] - shard.offsets[doc], pa.int64()),
                        pa.array(length[good], pa.int64()),
                    ],
                    ["item_id", "item_start", "doc_id", "doc_start", "length"],
                )

        found = rows.mapInArrow(search, MATCH_SCHEMA)
        out = found if out is None else out.union(found)
    return out
