"""Clashing names, ids of several texts, very long texts, and the segment scan at length."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_fixtures import tokenizer  # noqa: F401  (fixture)
from raresift.llm._shards import unused
from raresift.llm._text import hash_words
from raresift.llm.decontaminate import find_contamination
from raresift.llm.near_duplicates import remove_near_duplicates
from raresift.llm.packing import pack
from raresift.llm.repeats import remove_repeated
from raresift.llm.suffix_dedup import remove_repeated_strings, rewrite_without_repeats
from raresift.llm.token_files import token_files_round_trip
from raresift.llm.toxicity import ToxicityModel, _words, maximal_segments, score_toxicity


def segments_by_definition(scores):
    """The best segment (the shortest of the best, first one), and the same left and right of it."""

    def split(a, b):
        best = max(((sum(scores[i:j]), i - j, -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return split(a, i) + [(i, j, float(sum(scores[i:j])))] + split(j, b)

    return split(0, len(scores))


def test_segments_are_those_of_the_definition():
    rng = random.Random(11)
    for _ in range(600):
        # sums of distinct powers, so that no two segments tie
        powers = rng.sample(range(1, 40), rng.randrange(1, 13))
        scores = [rng.choice([-1, 1]) * 2.0**p for p in powers]
        assert sorted(maximal_segments(scores)) == segments_by_definition(scores)


@pytest.mark.parametrize("gap", [-0.5, -2.0, -1.0])
def test_a_million_scores(gap):
    scores = [1.0, gap] * 500_000
    started = time.time()
    found = maximal_segments(scores)
    assert time.time() - started < 5
    assert len(found) == (1 if gap > -1 else 500_000)


def test_unused_names():
    assert unused("__part", ["a"]) == "__part" and unused("__part", ["__PART", "__part_"]) == "__part__"


def clashing(spark, rows):
    data = [(i, t, 777 + k, True, f"s{k}") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, __part long, __null boolean, caller_id string").repartition(3)


def test_callers_columns_come_back(spark):
    words = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "some prefix " + " ".join(words)), (3, None), (4, ""), (None, "no id")]
    docs = clashing(spark, rows)
    before = {(r.doc_id, r["__part"], r["__null"], r.caller_id) for r in docs.collect()}
    for out in (rewrite_without_repeats(docs), remove_near_duplicates(docs, 3, 85)):
        assert out.columns == docs.columns
        after = {(r.doc_id, r["__part"], r["__null"], r.caller_id) for r in out.collect()}
        assert after <= before and len(after) >= 4
    texts = {r.doc_id: r.text for r in rewrite_without_repeats(docs).collect()}
    assert texts[1] == rows[0][1] and texts[2] == "some prefix " and texts[3] is None and texts[4] == ""


def test_texts_under_one_id_are_not_lost(spark):
    other = " ".join(f"x{i}" for i in range(30))
    rows = [(1, "alpha beta gamma delta epsilon"), (1, "one two three four five six"), (2, "one two three four five six"), (5, other), (5, other), (5, "short"), (9, other + " end")]
    rows += [(7, f"text number {i} of many under one id {i}") for i in range(40)]
    docs = clashing(spark, rows)
    kept = [(r.doc_id, r.text, r["__part"], r.caller_id) for r in remove_near_duplicates(docs, 3, 85).collect()]
    texts = [k[1] for k in kept]
    assert sorted(texts) == sorted({t for _, t in rows} - {other + " end"})
    given = {(r.doc_id, r.text, r["__part"], r.caller_id) for r in docs.collect()}
    assert set(kept) <= given


def test_texts_of_several_megabytes(spark):
    """A text over any slice or shard, with a passage of another document and a repeat of its own far away."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**9)}" for _ in range(300_000)]
    passage = " ".join(f"p{rng.randrange(10**9)}" for _ in range(80))
    own = " ".join(words[1000:1060])
    long = " ".join(words[:150_000]) + f" {passage} " + " ".join(words[150_000:]) + f" | {own}"
    assert len(long) > 3_000_000
    rows = [(1, f"first {passage} end"), (2, long), (3, "x" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.doc_id: r for r in remove_repeated_strings(docs).collect()}
    assert cut[1].n_removed == 0 and cut[3].n_removed == 0 and cut[2].n_spans == 2
    # a space on either side of the passage matches as well; the last word's end may run on
    assert cut[2].n_removed == len(passage) + 2 + len(own) + 1
    assert {r.doc_id: r.text for r in rewrite_without_repeats(docs).collect()}[2] == bytes(cut[2].kept).decode()
    windows = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeated(docs).collect()}
    assert windows == {1: (82, 80), 2: (300_141, 80 + 120), 3: (1, 0)}
    assert remove_near_duplicates(docs, 5, 80).count() == 3


def long_words():
    rng = random.Random(9)
    return [f"w{rng.randrange(10**9)}" for _ in range(290_000)]


def test_long_texts_are_searched_whole(spark):
    """A benchmark item near the end of a text of over 3 MB."""
    words = long_words()
    item = " ".join(f"Item{k}" for k in range(14))
    text = " ".join(words[:-20]) + f" {item} " + " ".join(words[-20:])
    docs = spark.createDataFrame([(1, text), (2, " ".join(words)), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("a", item), ("b", "short item")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in find_contamination(docs, items).collect()}
    assert got == {1: (290_014, 14, 1, True), 2: (290_000, 0, 0, False), 3: (0, 0, 0, False)}


def test_long_texts_become_ids_whole(spark, tokenizer):  # noqa: F811
    words = long_words()
    rows = [(1, " ".join(words)), (2, "between"), (3, "x" * 3_100_000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoder = Tokenizer.from_file(tokenizer)
    want, at = {}, 0
    for i, text in rows:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files_round_trip(docs, tokenizer).collect()}
    assert got == want
    pieces = pack(docs, tokenizer).collect()
    assert all(p.offset + p.length <= 1024 for p in pieces)
    for i in want:
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == i)
        assert [s for s, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(n for _, n in own) == want[i][1]


def test_a_passage_at_the_end_of_a_long_text_counts(spark):
    bad = [f"bad{i}" for i in range(8)]
    data, starts, ends, _ = _words(pa.array([" ".join(bad)]))
    model = ToxicityModel(np.sort(hash_words(data, starts, ends)), np.full(8, 2.0), 1.0, -3.0, 2.0)
    plain = " ".join(long_words())
    docs = spark.createDataFrame([(1, plain), (2, plain + " " + " ".join(bad * 2)), (3, "bad0 " * 600_000)], "doc_id long, text string")
    got = {r.doc_id: r.n_passages for r in score_toxicity(docs, model).collect()}
    assert got == {1: 0, 2: 1, 3: 1}
