"""Periodic runs against a brute-force version."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents  # noqa: F401  (fixture)
from raresift.llm.queries import repeated_tails
from raresift.llm.runs import find_runs, neighbour_prefixes, runs_of_words, shortest_pair
from raresift.llm._suffix import suffix_array

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, exponent=4, least=6):
    """By the definition: for each period the maximal stretches, of which those with a smaller period don't count."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def got(texts, exponent=4, least=6):
    """Runs of several documents by the operator's core."""
    ids = {}
    numbers = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], np.int64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out = [[] for _ in texts]
    for d, s, length, q in runs_of_words(numbers, first, exponent, least).tolist():
        out[d].append((s, length, q))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60) | st.text(alphabet="abcd", max_size=90), max_size=5))
def test_small_alphabets(texts):
    assert got(texts) == [brute(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=7), st.integers(1, 9), st.text(alphabet="abx", max_size=4)), max_size=6))
def test_repeated_units(parts):
    text = "".join(u * k + tail for u, k, tail in parts)
    assert got([text, text[::-1], text]) == [brute(text), brute(text[::-1]), brute(text)]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab", max_size=60), st.integers(3, 6), st.integers(2, 9))
def test_other_exponents(text, exponent, least):
    assert got([text], exponent, least) == [brute(text, exponent, least)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60))
def test_neighbour_prefixes(values):
    symbols = np.array(values, np.int64)
    order = suffix_array(symbols.astype(np.uint64), 1, len(values))[0].astype(np.int64)
    suffixes = [values[i:] for i in order.tolist()]
    assert suffixes == sorted(suffixes)
    want = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(suffixes, suffixes[1:])]
    assert neighbour_prefixes(symbols, order).tolist() == want


def test_shortest_pair():
    assert shortest_pair(4, 6) == 5 and shortest_pair(3, 9) == 6


def texts_with_runs():
    rng = random.Random(3)
    out = []
    for i in range(60):
        words = [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 120))]
        at = rng.randint(0, len(words))
        unit = [f"u{rng.randint(0, 3)}" for _ in range(rng.randint(1, 9))]
        words[at:at] = unit * rng.randint(1, 8)
        out.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    return out


def check(df, rows):
    want = []
    for i, t in rows:
        words = SPACED.findall(t or "")
        runs = brute(words)
        want.append((i, len(words), runs, collapsed(words, runs)))
    have = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_find_runs(spark, documents):  # noqa: F811
    rows = texts_with_runs() + [(100, "a" * 50 + " b" * 9), (101, " x" * 6), (102, "x\x0bx x x x"), (None, "y " * 7), (None, "y " * 7)]
    check(find_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), rows)
    check(find_runs(documents), [(r.doc_id, r.text) for r in documents.collect()])
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_texts(spark):
    """Texts of over 3 MB: one run throughout, a run of a long unit, and a line between distinct words."""
    unit = [f"word{i}" for i in range(50_000)]
    rows = [
        (1, "a " * 1_600_000),
        (2, "start " + " ".join(unit * 8) + " end"),
        (3, " ".join(f"the same line of six words {i}" for i in range(90_000))),
    ]
    have = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert have[1] == (1_600_000, [(0, 1_600_000, 1)], "a")
    assert have[2] == (400_002, [(1, 400_000, 50_000)], "start " + " ".join(unit) + " end")
    assert have[3][1] == [] and have[3][2] == rows[2][1]


def test_repeated_tails(spark):
    import zlib

    rows = [(i, " ".join(f"t{k}" for k in range(i % 37))) for i in range(200)] + [(None, "a b"), (900, None)]
    have = {r.doc_id: r.text for r in repeated_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        words, h = (t or "").split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            assert have[i] == " ".join(words)
        else:
            assert have[i] == t
