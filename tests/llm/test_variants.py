"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents  # noqa: F401  (fixture)
from raresift.llm import variants
from raresift.llm.queries import altered_words
from raresift.llm.variants import TARGET, near_pairs, near_words, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """By the definition: one inserted, deleted or replaced code point."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        out[w] = (best if best is not None and counts[best] >= 2 * n else None, len(others))
    rows = []
    for w, n in counts.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, out[w][0], root, n, out[w][1], counts.get(out[w][0])))
    return sorted(rows)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=5), min_size=1, max_size=40))
def test_pairs_of_one_subtrie(words):
    words = sorted(words)
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    found = set()
    for size, own in by_size.items():
        longer = by_size.get(size + 1, [])
        roles = np.array([TARGET] * len(own) + [variants.LONGER] * len(longer), np.int8)
        a, b = near_pairs(roles, own + longer)
        pairs = [frozenset(((own + longer)[i], (own + longer)[j])) for i, j in zip(a.tolist(), b.tolist())]
        assert len(pairs) == len(set(pairs))
        found |= set(pairs)
    assert found == {frozenset((x, y)) for x in words for y in words if near(x, y)}


def vocabulary(seed, size):
    rng = random.Random(seed)
    words = {"".join(rng.choice("enaixyzé") for _ in range(rng.randint(5, 9))): rng.randint(3, 50) for _ in range(size)}
    for w in list(words)[: size // 2]:
        for _ in range(rng.randint(1, 4)):
            k, kind = rng.randrange(len(w)), rng.randrange(3)
            v = w[:k] + rng.choice("enaqÿø") * (kind != 0) + w[k + (kind != 1) :]
            words.setdefault(v, rng.choice([3, 3, 6, 12, 100, 100]))
            w = v
    return words


@pytest.mark.parametrize("subtrie", [variants.SUBTRIE, 20, 1])
def test_against_brute_force(spark, monkeypatch, subtrie):
    monkeypatch.setattr(variants, "SUBTRIE", subtrie)
    counts = vocabulary(1, 500)
    counts |= {"x" * 40: 5, "x" * 41: 10, "x" * 42: 20, "w" * 70_000: 3, "w" * 70_001: 6, "w" * 300 + "a" + "w" * 69_699: 9, "日本語日本": 4, "日本語日木": 8}
    counts |= {"colour": 4, "color": 8, "colon": 8, "cologne": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert got(spelling_variants(df)) == brute(counts)


def test_chains_of_forms(spark):
    counts = {"a" * 5 + "b" * k: 2**k for k in range(40)}
    assert got(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)


def test_every_pair_once(spark):
    counts = vocabulary(2, 400)
    pairs = [(r.word, r.near) for r in near_words(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in counts for b in counts if near(a, b)}


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    assert spelling_variants(spark.createDataFrame([(None, 3), ("", 4)], "word string, n long")).collect() == []


def brute_words(rows):
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_altered_words(spark, documents):  # noqa: F811
    rng = random.Random(4)
    words = list(vocabulary(3, 200))
    rows = [(i, " ".join(rng.choices(words, k=60)).title()) for i in range(120)]
    rows += [(None, "Ünïcödé×÷ß " * 5), (500, None), (501, ""), (502, "1234 abcde12345abcde"), (503, "Straße ÀÖ" * 3), (504, "longword" * 400_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.word: r.n for r in altered_words(df).collect()} == brute_words(rows)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert {r.word: r.n for r in altered_words(documents).collect()} == brute_words(rows)
