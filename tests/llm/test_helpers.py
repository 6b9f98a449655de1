"""The vectorised helpers against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import tokenizer  # noqa: F401  (fixture)
from raresift.llm._shards import runs_of, within
from raresift.llm._suffix import common_prefixes, pack_bytes, suffix_array
from raresift.llm._text import (
    ALNUM,
    SPACED,
    Windows,
    covered,
    find_words,
    hash_words,
    lower_ascii,
    slide,
    text_bytes,
    text_slices,
    window_starts,
)
from raresift.llm._tokens import Encoder

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab cÄß\n\t .é#1Z", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_equal_the_patterns(texts):
    for table, pattern, lower in ((SPACED, r"[^\x20\x09-\x0D]+", False), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        data = lower_ascii(data) if lower else data
        starts, ends, first = find_words(data, offsets, table)
        raw = data.tobytes()
        for i, text in enumerate(texts):
            text = text or ""
            if lower:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            own = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
            assert own == re.findall(pattern, text)


def test_hashes_tell_words_and_windows_apart():
    words = [b"a", b"a\0", b"aa", b"12345678", b"123456789", b"12345678\0", b"x" * 40, b"x" * 41, b"a"]
    ends = np.cumsum([len(w) for w in words])
    ids = hash_words(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
    assert len(set(ids.tolist())) == len(words) - 1 and ids[0] == ids[-1]
    windows = Windows(np.concatenate([ids, ids]))
    assert (windows.of(4)[: len(ids)] == windows.of(4)[len(ids) :][0]).sum() <= 1
    assert windows.of(4)[2] == windows.of(4)[2 + len(ids)]
    assert windows.spans(np.array([1]), np.array([5]))[0] == windows.of(4)[1]


def test_slide_covered_starts_and_runs():
    values = np.array([5, 3, 8, 1, 9, 2])
    assert slide(values, 3, np.minimum).tolist() == [3, 1, 1, 1]
    assert covered(np.array([1, 2, 6]), 2, 8).tolist() == [False, True, True, True, False, False, True, True]
    assert window_starts(np.array([0, 4, 4, 5]), 2).tolist() == [True, True, True, False, False]
    assert [x.tolist() for x in runs_of(np.array([True, False, True, True]))] == [[0, 2], [1, 4]]
    assert within(np.array([1, 5, 9]), np.array([5, 6])).tolist() == [False, True, False]


def test_slices_hold_one_row_at_least():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "y" * 100, "", "z"]})
    cuts = [b.column(0).to_pylist() for b in text_slices([batch], "text", 12)]
    assert sum(cuts, []) == batch.column(0).to_pylist() and all(c[0] == "y" * 100 for c in cuts if "y" * 100 in c)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    random_ = random.Random(seed)
    docs = [bytes(random_.choices(b"abc", k=random_.randrange(0, 60))) for _ in range(12)]
    docs += [docs[0], docs[1] + docs[2]]
    data = np.frombuffer(b"".join(docs), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    limit, raw = 12, data.tobytes()
    order, rank = suffix_array(pack_bytes(data), 8, limit)
    keys = [raw[i : i + limit] for i in range(len(raw))]
    # zeros stand past the end, as for the shorter of two equal strings
    assert [keys[i] for i in order] == sorted(keys)
    assert all((rank[i] == rank[j]) == (keys[i] == keys[j]) for i in range(0, len(raw), 7) for j in range(len(raw)))
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at, before, length = common_prefixes(data, order, rank, ends, limit)
    seen, want = {}, {}
    for i in range(len(raw)):
        if i + limit <= ends[i]:
            if keys[i] in seen:
                want[i] = seen[keys[i]]
            seen[keys[i]] = i
    assert dict(zip(at.tolist(), before.tolist())) == want
    for i, j, n in zip(at.tolist(), before.tolist(), length.tolist()):
        most = min(ends[i] - i, ends[j] - j)
        real = next((k for k in range(most) if raw[i + k] != raw[j + k]), most)
        assert n == real


def test_encoder_equals_the_library(tokenizer):
    encoder = Encoder(tokenizer)
    assert encoder.cuts
    random_ = random.Random(5)
    texts = ["", "a  b \n\n c ", "x <|endoftext|> y", "\n", "\tq\n w", "don't ünï 12  x", " lead", "l\x1cq", "a\r\nb", "a　b", "x\n", "é  q",
             "it's\nwe'll ok", "tail ", "日本語 テキスト", "a b", "!!! ... ??"]
    texts += ["".join(random_.choices("ab é\n.'1 \t", k=random_.randrange(40))) for _ in range(200)]
    for _ in range(2):  # the second time from the cache
        ids, cuts = encoder.encode(*text_bytes(pa.array(texts)))
        for text, a, b in zip(texts, cuts, cuts[1:]):
            assert encoder.tokenizer.encode(text, add_special_tokens=False).ids == ids[a:b].tolist(), repr(text)
