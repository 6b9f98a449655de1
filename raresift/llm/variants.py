"""Spelling variants: near words found in a trie of letter-count vectors.

A word is arranged by its length and then by how many letters of each group
it has, group after group.  One inserted, deleted or replaced letter changes
such a vector by a surplus of at most one and a deficit of at most one, so a
depth-first search that may spend one of each visits every near word; words
at the leaves are compared letter by letter.

The trie's first levels are the key by which Spark deals words to tasks.  A
word stands in its own subtrie and asks in the few others that a budget of
one and one can reach.  Pairs are found once: the longer word asks the
shorter, and of equally long words in different subtries one side asks.  The
number of levels in the key is raised until the largest subtrie is small, so a
task's memory does not grow with the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._text import MIX_A, column, mix
from raresift.operators.persist import discard, materialize

#: Letters that are groups of their own, frequent ones first (fixed value); all others share OTHERS groups.
LETTERS = "enairtsoldumcghpbkfvwzyjxq"
OTHERS = 6
GROUPS = len(LETTERS) + OTHERS
#: Words of a subtrie, if some number of key levels makes it that small.
SUBTRIE = 10_000
#: Levels of the key, at least.
FEWEST_LEVELS = 3
#: Words of the vocabulary for each task, about.
TASK_WORDS = 8_000
#: A node with so few words is a leaf.
LEAF = 8
#: Pairs, and letters of them, compared at a time.
PAIRS = 1 << 16
CELLS = 1 << 22

TARGET, SAME, LONGER = 0, 1, 2
DEALT_SCHEMA = "key long, role byte, word string, n long"
NEAR_SCHEMA = "word string, near string, near_n long"


@dataclass
class Words:
    """Words as code points, end to end."""

    codes: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Words:
        size = np.fromiter(map(len, words), np.int64, len(words))
        return Words(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.cumsum(size) - size, size)

    def vectors(self) -> np.ndarray:
        """Letters of each group, at most 255 (cut counts differ by no more than whole ones)."""
        table = np.arange(256) % OTHERS + len(LETTERS)
        table[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
        group = np.where(self.codes < 256, table[np.minimum(self.codes, 255)], self.codes % OTHERS + len(LETTERS))
        row = np.repeat(np.arange(len(self.size)), self.size)
        counts = np.bincount(row * GROUPS + group, minlength=len(self.size) * GROUPS)
        return np.minimum(counts, 255).astype(np.uint8).reshape(-1, GROUPS)

    def padded(self, at: np.ndarray, width: int) -> np.ndarray:
        """Code points of the words ``at``, one row each, with zeros behind them."""
        step = np.arange(width)
        inside = step < self.size[at][:, None]
        return np.where(inside, self.codes[np.where(inside, self.begin[at][:, None] + step, 0)], 0)


def keys_of(size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One number for (length, first counts)."""
    out = mix(size.astype(np.uint64) * MIX_A)
    for k in range(counts.shape[1]):
        out = mix(out + counts[:, k].astype(np.uint64) + np.uint64(1))
    return out.view(np.int64)


def asked(levels: int) -> list[tuple[int, tuple[int, ...]]]:
    """(role, what the asking word has more in each level of the key) of all subtries that a word asks beside its own."""
    unit = [tuple(int(i == k) for i in range(levels)) for k in range(levels)]
    none = (0,) * levels
    out = [(LONGER, d) for d in (none, *unit)] + [(SAME, d) for d in unit]
    # surplus before deficit: the other direction is asked by the other word
    out += [(SAME, tuple(a - b for a, b in zip(unit[i], unit[j]))) for i in range(levels) for j in range(i + 1, levels)]
    return out


def _deal(levels: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words.of(column(batch, "word").to_pylist())
            counts = words.vectors()[:, :levels].astype(np.int64)
            everyone = np.arange(batch.num_rows)
            for role, more in [(TARGET, (0,) * levels), *asked(levels)]:
                there = counts - np.array(more, np.int64)
                size = words.size - (role == LONGER)
                at = everyone[(there >= 0).all(axis=1) & (size > 0)]
                picked = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys_of(size[at], there[at])), pa.array(np.full(len(at), role, np.int8)), column(picked, "word"), column(picked, "n")],
                    ["key", "role", "word", "n"],
                )

    return deal


def candidates(targets: np.ndarray, queries: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, target) rows whose vectors lie within a surplus of one and the query's ``deficit``, depth first.

    ``targets`` must be in lexicographic order.
    """
    queries = queries.astype(np.int16)
    everyone = np.arange(len(queries))
    nothing = np.zeros(len(queries), np.int16)
    stack = [(0, len(targets), 0, everyone, nothing, nothing)]
    while stack:
        lo, hi, level, who, surplus, lack = stack.pop()
        first, last = targets[lo].astype(np.int16), targets[hi - 1]
        apart = first != last
        branch = int(apart.argmax()) if apart.any() else GROUPS
        # levels that all words below share
        change = queries[who, level:branch] - first[level:branch]
        surplus = surplus + np.maximum(change, 0).sum(axis=1, dtype=np.int16)
        lack = lack + np.maximum(-change, 0).sum(axis=1, dtype=np.int16)
        fits = (surplus <= 1) & (lack <= deficit[who])
        who, surplus, lack = who[fits], surplus[fits], lack[fits]
        if not len(who):
            continue
        if branch == GROUPS:
            yield np.repeat(who, hi - lo), np.tile(np.arange(lo, hi), len(who))
        elif hi - lo <= LEAF:
            for t in range(lo, hi):
                change = queries[who, branch:] - targets[t, branch:].astype(np.int16)
                fits = surplus + np.maximum(change, 0).sum(axis=1) <= 1
                fits &= lack + np.maximum(-change, 0).sum(axis=1) <= deficit[who]
                yield who[fits], np.full(int(fits.sum()), t)
        else:
            values = targets[lo:hi, branch]
            cuts = [lo, *(lo + 1 + np.flatnonzero(values[1:] != values[:-1])).tolist(), hi]
            stack += [(a, b, branch, who, surplus, lack) for a, b in zip(cuts, cuts[1:])]


def one_edit(long: Words, a: np.ndarray, short: Words, b: np.ndarray) -> np.ndarray:
    """Mask of the pairs (a, b) that differ by exactly one code point; words ``a`` are as long, or one longer."""
    out = np.zeros(len(a), bool)
    by = np.argsort(long.size[a], kind="stable")
    done = 0
    while done < len(by):
        # pairs whose letters fit into CELLS, one pair at least
        width = long.size[a[by[done:]]]
        count = max(1, int(np.searchsorted(width * np.arange(1, len(width) + 1), CELLS, side="right")))
        at = by[done : done + count]
        done += count
        x, y = long.padded(a[at], int(width[count - 1]) + 1), short.padded(b[at], int(width[count - 1]) + 1)
        same = long.size[a[at]] == short.size[b[at]]
        differ = x != y
        lead = np.where(differ.any(axis=1), differ.argmax(axis=1), 0)
        # without one letter the rest of the longer word moves up
        after = (x[:, 1:] != y[:, :-1]) & (np.arange(x.shape[1] - 1) >= lead[:, None])
        out[at] = np.where(same, differ.sum(axis=1) == 1, ~after.any(axis=1))
    return out


def near_pairs(roles: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of near words in one subtrie: a asks, b stands in it."""
    own = np.flatnonzero(roles == TARGET)
    if not len(own):
        return own, own
    all_words = Words.of(words)
    vectors = all_words.vectors()
    own = own[np.lexsort(vectors[own].T[::-1])]
    # a subtrie's own words ask too; of two such words the later one does
    queries = np.arange(len(words))
    place = np.full(len(words), -1, np.int64)
    place[own] = np.arange(len(own))
    deficit = np.where(roles == LONGER, 0, 1).astype(np.int16)
    found_a, found_b = [], []
    held_a: list[np.ndarray] = []
    held_b: list[np.ndarray] = []
    held = 0

    def settle() -> None:
        nonlocal held
        a, b = np.concatenate(held_a), np.concatenate(held_b)
        asks = (roles[a] != TARGET) | (place[a] > b)
        # a key may stand for two subtries, so lengths are compared as well
        asks &= all_words.size[a] - all_words.size[own[b]] == (roles[a] == LONGER)
        a, b = a[asks], own[b[asks]]
        near = one_edit(all_words, a, all_words, b)
        found_a.append(a[near])
        found_b.append(b[near])
        held_a.clear()
        held_b.clear()
        held = 0

    for a, b in candidates(vectors[own], vectors[queries], deficit):
        for k in range(0, len(a), PAIRS):
            held_a.append(a[k : k + PAIRS])
            held_b.append(b[k : k + PAIRS])
            held += len(held_a[-1])
            if held >= PAIRS:
                settle()
    if held:
        settle()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _search(table: pa.Table) -> pa.Table:
    roles, words, n = column(table, "role").to_numpy(), column(table, "word"), column(table, "n")
    a, b = near_pairs(roles, words.to_pylist())
    one, other = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
    return pa.table({"word": words.take(one), "near": words.take(other), "near_n": n.take(other)})


def _levels(vocabulary: DataFrame) -> int:
    """How many letter groups the key needs for subtries of at most SUBTRIE words (or all groups)."""

    def least(levels: int):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = Words.of(column(batch, "word").to_pylist())
                keys = keys_of(words.size, words.vectors()[:, :levels])
                yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])

        return count

    levels = FEWEST_LEVELS
    while levels < GROUPS:
        sizes = vocabulary.mapInArrow(least(levels), "key long").groupBy("key").count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= SUBTRIE:
            break
        levels += 1
    return levels


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n) of all pairs of words that differ by one code point, both ways; ``vocabulary`` has word and n."""
    ship(vocabulary.sparkSession)
    tasks = max(8, vocabulary.count() // TASK_WORDS)
    dealt = vocabulary.mapInArrow(_deal(_levels(vocabulary)), DEALT_SCHEMA).repartition(tasks, "key")
    return dealt.groupBy("key").applyInArrow(_search, NEAR_SCHEMA)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms are followed, twice as far in each round.

    A form has at least twice its word's n, so no chain is a ring and 63
    forms follow each other at most: six rounds.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        stepped = materialize(stepped, "roots")
        discard(now)
        now = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return now


def spelling_variants(counts: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n; ``counts`` has distinct words and their counts n.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  A word's form is its near word of largest n, of
    equal ones the smallest in code-point order, if that n is at least twice
    the word's; else null.  ``root`` is where the forms end: the word itself
    if it has none.  Null and empty words are left out, and so are further
    columns; an empty table gives no rows.
    """
    vocabulary = materialize(counts.select("word", F.col("n").cast("long").alias("n")).filter("length(word) > 0"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best)
    has_form = -F.col("best.n") >= 2 * F.col("n")
    judged = materialize(
        vocabulary.join(near, "word", "left").select(
            "word",
            F.when(has_form, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, -F.col("best.n")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    result = materialize(
        judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants"
    )
    for table in (vocabulary, judged, roots):
        discard(table)
    return result
