"""Every operator against a brute-force version, on small and awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from llm_fixtures import documents, tokenizer  # noqa: F401  (fixtures)
from raresift.llm._components import components
from raresift.llm._shards import repeated_keys, unpack
from raresift.llm._text import hash_words, text_bytes
from raresift.llm.decontaminate import CHUNK_BYTES, find_contamination, longest_matches, remove_contaminated
from raresift.llm.embeddings import near_duplicate_vectors
from raresift.llm.near_duplicates import near_duplicates, remove_near_duplicates, spanning_forest
from raresift.llm.packing import first_fit_decreasing, pack
from raresift.llm.quality import STATISTICS, fit_quality, score_quality, statistics
from raresift.llm.repeats import levels, remove_repeated
from raresift.llm.suffix_dedup import (
    _send_keys, _send_longer, _send_pieces, _settle_pieces, remove_repeated_strings, rewrite_without_repeats,
)
from raresift.llm.token_files import Reader, Writer, from_planes, to_planes, token_files_round_trip
from raresift.llm.toxicity import (
    ToxicityModel, _words, fit_toxicity, maximal_segments, passages, remove_toxic, score_toxicity, toxic_passages,
)
from raresift.llm.warc import derivatives, responses_of_pages, write_warc
from raresift.session import scratch_path

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# ---- components ---------------------------------------------------------


def test_components(spark):
    edges = [(i, i + 1) for i in range(60) if i % 13] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_forest_prefers_heavy_edges():
    a, b = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4])
    kept = spanning_forest(a, b, np.array([0.9, 0.8, 0.1, 0.5]), 5)
    assert sorted(kept.tolist()) == [0, 1, 3]
    assert spanning_forest(a, b, np.ones(4), 5, np.array([7, 7, 7, 1, 1])).tolist() == []


# ---- 1: embeddings ------------------------------------------------------


def brute_links(rows, threshold):
    good = [
        (i, label, np.asarray(v, float))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    parent, count = {i: i for i, _, _ in rows if i is not None}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x, v) in enumerate(good):
        for j, y, w in good[k + 1 :]:
            if x == y and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold:
                count[i] += 1
                count[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (count[i], root(i), root(i) == i) for i in parent}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    rows = [
        (i, [float(x) for x in centers[i % 6] + rng.normal(size=8) * 0.25], int(i % 2) if i % 17 else None) for i in range(160)
    ]
    rows += [(200 + i, rows[1][1], rows[1][2]) for i in range(5)]  # equal vectors
    rows += [
        (300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [1.0, None] + [0.0] * 6, 1), (304, [float("nan")] * 8, 1),
        (305, [float("inf")] * 8, 1), (306, [1.0, 0.0], 1), (307, [2.0, 0.0], 1), (308, [1e-300] * 8, 0), (309, [3e-300] * 8, 0),
    ]
    df = spark.createDataFrame([(*r, True) for r in rows], "vec_id long, embedding array<double>, label int, kept boolean")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df.repartition(3), 0.95).collect()}
    want = brute_links(rows[:-2], 0.95) | {308: (1, 308, True), 309: (1, 308, False)}
    assert got == want
    assert near_duplicate_vectors(df.limit(0)).count() == 0
    assert near_duplicate_vectors(df.limit(0).union(spark.createDataFrame([(None, [1.0], 1, True)], df.schema))).first().kept


# ---- 2 and 10: repeated windows and strings -----------------------------


def test_levels():
    assert levels(35) == [9, 18, 35] and levels(8) == [8]


@pytest.mark.parametrize("window", [12, 35])
def test_repeats(spark, documents, window):
    rows = pairs(documents)
    words = [SPACED.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[a : a + window]) for w in words for a in range(len(w) - window + 1))
    want = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a : a + window])] > 1:
                gone[a : a + window] = [True] * window
        want.append((str(i), len(w), sum(gone), " ".join(x for x, y in zip(w, gone, strict=True) if not y)))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in remove_repeated(documents, window).collect()]
    assert sorted(got) == sorted(want)
    assert remove_repeated(documents.limit(0)).count() == 0


def brute_strings(rows, length):
    """By (id, text) in order; ids must differ."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if raw[a : a + length] in seen:
                gone[a : a + length] = b"\1" * length
            seen.add(raw[a : a + length])
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, bytes(x for x, y in zip(raw, gone, strict=True) if not y))
    return out


@pytest.mark.parametrize("length", [40, 100])
def test_suffix_dedup(spark, documents, length):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeated_strings(documents, length).collect()}
    assert got == brute_strings(pairs(documents), length)
    assert remove_repeated_strings(documents.limit(0)).count() == 0


def test_a_string_in_many_documents_costs_a_record_a_shard():
    header, length, shards = "-".join(f"h{i}" for i in range(12))[:40], 50, []
    for part in range(2):
        texts = pa.array([f"{part}{i:04d}" * 12 + header + f"{i:04d}{part}" * 12 for i in range(300)])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as writer:
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array(range(part, 600, 2), pa.int64())], ["doc_id"]))
        data, offsets = text_bytes(texts)
        shards.append(
            pa.RecordBatch.from_pylist(
                [{"part": part, "shard": part, "data": data.tobytes(), "offsets": offsets.astype(np.int64).tobytes(),
                  "rows": sink.getvalue().to_pybytes()}]
            )
        )

    def step(send, settle, batches):
        sent = [r for b in batches for m in send(iter([b])) for r in m.to_pylist()]
        answers = {0: [], 1: []}
        for bucket in sorted({r["bucket"] for r in sent if r["bucket"] >= 0}):
            mine = [r for r in sent if r["bucket"] == bucket]
            for r, x in zip(mine, settle([r["payload"] for r in mine]), strict=True):
                answers[r["shard"]] += [bucket.to_bytes(8, "little") + x] if x else []
        own = {r["shard"]: r["payload"] for r in sent if r["bucket"] == -1}
        plain = [b.to_pylist()[0] for b in shards]
        nexts = [pa.RecordBatch.from_pylist([{**p, "answers": answers[k], "own": own.get(k)}]) for k, p in enumerate(plain)]
        return nexts, [r for r in sent if r["bucket"] >= 0]

    batches, _ = step(_send_keys(length, 8), repeated_keys, shards)
    batches, pieces = step(_send_pieces(length, 8), _settle_pieces, batches)
    keys = [k for r in pieces for k in unpack(r["payload"], ["<u8", "<u8", "<i8", "u1"])[0].tolist()]
    assert keys and max(Counter(keys).values()) <= 2
    _, longer = step(_send_longer(length, 41, 8), _settle_pieces, batches)
    keys = [k for r in longer for k in unpack(r["payload"], ["<u8", "<u8", "<i8", "u1"])[0].tolist()]
    # what hangs on a few keys is dealt evenly
    assert len(set(keys)) > 600 and max(Counter(k >> 61 for k in keys).values()) < len(keys) / 4


def test_strings_round_a_shared_header(spark):
    header = "-".join(f"h{i}" for i in range(30))
    rows = [(i, f"{i % 7}{i:03d}" * 9 + header[: 40 + i % 50] + f"{i % 5}tail" * 9) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: bytes(r.kept) for r in remove_repeated_strings(df, 50).collect()}
    assert got == {i: x[3] for i, x in brute_strings(rows, 50).items()}


def test_suffix_dedup_of_repeated_rows_keeps_one(spark):
    text = "some text that is long enough to count " * 5
    df = spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")
    removed = sorted(r.n_removed for r in remove_repeated_strings(df).collect())
    assert removed[1:] == [len(text)] * 2 and removed[0] < len(text)


def test_rewritten_texts_stay_valid(spark, documents):
    out = rewrite_without_repeats(documents, 41)
    assert out.columns == documents.columns
    before = {r.doc_id: r for r in documents.collect()}
    for r in out.collect():
        assert (r.text is None) == (before[r.doc_id].text is None)
        assert r.text is None or r.n_chars == len(r.text) <= len(before[r.doc_id].text)
    assert out.count() == documents.count()


# ---- 3 and 8: tokens ----------------------------------------------------


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 200)
    bins, offsets = first_fit_decreasing(sizes, 100)
    room, want = [], {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), None)
        if k is None:
            room.append(100)
            k = len(room) - 1
        want[i] = (k, 100 - room[k])
        room[k] -= sizes[i]
    assert {i: (int(bins[i]), int(offsets[i])) for i in want} == want
    with pytest.raises(ValueError):
        first_fit_decreasing(np.array([101]), 100)


def expected_ids(rows, path):
    library = Tokenizer.from_file(path)
    return [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for i, t in rows]


def test_packing(spark, documents, tokenizer):
    ids = expected_ids(pairs(documents), tokenizer)
    got = pack(documents, tokenizer, length=64, group_pieces=20).collect()
    pieces = Counter()
    for i, own in ids:
        for a in range(0, len(own), 64):
            part = own[a : a + 64]
            pieces[(i, a, len(part), zlib.crc32(part.tobytes()), len(own))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == pieces
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(documents.limit(0), tokenizer).count() == 0


@pytest.mark.parametrize("unit", [1, 8])
def test_planes_and_files(unit, tmp_path):
    rng = np.random.default_rng(2)
    for most in (1, 200, 50_000, 1 << 31):
        ids = rng.integers(0, most, 1001).astype(np.uint32)
        assert np.array_equal(from_planes(to_planes(ids, unit), len(ids), unit), ids)
    path = tmp_path / "ids"
    with open(path, "wb") as out:
        writer = Writer(out, unit, 64)
        sizes = [0, 1, 200, 63, 1]
        ids = rng.integers(0, 50_257, sum(sizes)).astype(np.uint32)
        writer.add([5, None, 7], sizes[:3], ids[:201])
        writer.add([8, 9], sizes[3:], ids[201:])
        writer.close()
    reader = Reader(path.read_bytes())
    assert reader.docs == [5, None, 7, 8, 9] and reader.sizes.tolist() == sizes
    assert np.array_equal(reader.ids(), ids) and np.array_equal(reader.block(1), ids[64:128])
    with pytest.raises(ValueError):
        Reader(path.read_bytes()[:-3])


def test_token_files(spark, documents, tokenizer):
    ids = expected_ids(pairs(documents), tokenizer)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files_round_trip(documents, tokenizer).collect()}
    at = 0
    for i, own in sorted(ids, key=lambda x: (x[0] is not None, x[0])):
        assert got[i] == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    assert token_files_round_trip(documents.limit(0), tokenizer).count() == 0


# ---- 4: near duplicates -------------------------------------------------


def brute_near(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = SPACED.findall(lower(t))
        sets[i] = {tuple(w[a : a + size]) for a in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, documents, size, percent):
    rows = [r for r in pairs(documents) if r[0] is not None]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(documents, size, percent).collect()}
    null = got.pop(None)
    assert null[1:] == (None, True)
    assert got == brute_near(rows, size, percent)
    assert near_duplicates(documents.limit(0)).count() == 0


def test_near_duplicates_in_long_lists(spark, monkeypatch):
    """Large groups of near copies and a passage that most documents share take the block way."""
    import random

    import raresift.llm.near_duplicates as module

    monkeypatch.setattr(module, "COMMON", 6)
    monkeypatch.setattr(module, "BLOCK", 16)
    random_ = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(60):
        words = [w if random_.random() > 0.03 else f"e{i}-{k}" for k, w in enumerate(base)]
        rows.append((i, " ".join(words)))
    for i in range(60, 100):
        rows.append((i, " ".join(passage + [f"o{i}-{k}" for k in range(random_.choice([0, 3, 10, 60]))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 3, 85).collect()}
    assert got == brute_near(rows, 3, 85)


def test_members_of_a_long_list_meet_those_of_other_components(spark, monkeypatch):
    """One component sends nothing; few members outside send few copies; every open pair shares a task once."""
    import raresift.llm.near_duplicates as module

    monkeypatch.setattr(module, "BLOCK", 10)
    schema = "list long, block int, blocks int, doc_id long, n int, sketch binary, component long"

    def rows(name, many, component):
        return [(name, i % 4, 4, 1000 * name + i, 9, b"", 1000 * name + component(i)) for i in range(many)]

    one = rows(1, 40, lambda i: 0)
    few = rows(2, 40, lambda i: i if i in (3, 7, 8) else 0)
    all_open = rows(3, 30, lambda i: i // 2)
    met = module._meetings(spark.createDataFrame(one + few + all_open, schema)).collect()
    by_task = {}
    for r in met:
        by_task.setdefault(r.task, []).append(r)
    found = Counter()
    for task in by_task.values():
        for a in (r for r in task if r.asks):
            for b in (r for r in task if not r.asks):
                if a.component != b.component and (not b.minor or a.doc_id < b.doc_id):
                    found[frozenset((a.doc_id, b.doc_id))] += 1
    want = {
        frozenset((a[3], b[3])) for part in (few, all_open) for a in part for b in part if a[6] != b[6]
    }
    assert set(found) == want and set(found.values()) == {1}
    # 40 members in one slice, and three that ask four blocks
    assert sum(r.doc_id // 1000 == 2 for r in met) == 40 + 3 * 4


def test_members_of_long_lists_are_joined_with_their_components_once(spark, monkeypatch):
    """The steps on long lists read a written table, whose rows grow in proportion to a group of near copies."""
    import random

    import raresift.llm.near_duplicates as module

    monkeypatch.setattr(module, "COMMON", 6)
    monkeypatch.setattr(module, "BLOCK", 16)
    random_ = random.Random(4)
    seen = []
    for name in ("open_documents", "open_links"):

        def step(self, members, *more, own=getattr(module._Job, name)):
            seen.append((members._jdf.queryExecution().optimizedPlan().toString(), members.count()))
            return own(self, members, *more)

        monkeypatch.setattr(module._Job, name, step)
    made = []
    for many in (30, 120):
        seen.clear()
        rows = [(i, " ".join(f"e{i}-{k}" if random_.random() < 0.02 else f"b{k}" for k in range(120))) for i in range(many)]
        passage = " ".join(f"p{k}" for k in range(50))
        rows += [(many + i, " ".join([passage, *(f"o{i}-{k}" for k in range(10))])) for i in range(20)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 3, 85).collect()}
        assert got == brute_near(rows, 3, 85)
        assert seen and not any("Join" in plan for plan, _ in seen)
        made.append(seen[0][1])
    assert made[0] > 0 and made[1] < 8 * made[0]


def test_one_document_of_a_group_stays(spark, documents):
    doubled = documents.union(documents.filter("doc_id = 1"))
    out = remove_near_duplicates(doubled, 3, 85)
    assert out.columns == documents.columns
    want = brute_near([r for r in pairs(documents) if r[0] is not None], 3, 85)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted([str(i) for i, x in want.items() if x[2]] + ["None"])


# ---- 5: WARC ------------------------------------------------------------


def test_warc(spark):
    html = (
        '<!DOCTYPE html><html lang="en"><head><title> A &amp; B </title><style>p{}</style><script>var t="</p>";</script></head>'
        '<body><!-- x --><a href="/one">One</a><p>Text &lt;here&gt;\n  more</p><br>end &quot;q&quot;</body></html>'
    )
    pages = spark.createDataFrame(
        [(1, "http://a/", html, "x"), (1, "http://a/", html, "x"), (2, None, None, "x"), (None, "u", "", None)],
        "page_id long, url string, html string, block string",
    )
    rows = derivatives(responses_of_pages(pages)).collect()
    assert len(rows) == 8 and Counter(r.warc_type for r in rows) == {"metadata": 4, "conversion": 4}
    first = [r for r in rows if r.page_id == 1]
    text = next(r for r in first if r.warc_type == "conversion")
    assert text.block == 'A & B\nOne\nText <here>\nmore\nend "q"'
    assert text.content_length == len(text.block.encode())
    assert text.block_digest == "sha256:" + hashlib.sha256(text.block.encode()).hexdigest()
    assert text.source_digest == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    about = next(r for r in first if r.warc_type == "metadata")
    assert about.refers_to == text.refers_to and f"conversion: {text.record_id}" in about.block
    assert "source-header: Content-Type: text/html; charset=utf-8" in about.block and "outlink: /one" in about.block
    folder = scratch_path(spark, "warc")
    write_warc(derivatives(responses_of_pages(pages)), folder)
    raw = "".join(r.value for r in spark.read.text(folder, wholetext=True).collect())
    assert raw.count("WARC/1.1\r\n") == 8 and f"WARC-Refers-To: {text.refers_to}\r\n" in raw
    assert derivatives(responses_of_pages(pages.limit(0))).count() == 0


# ---- 6: decontamination -------------------------------------------------


def brute_hits(rows, items, window):
    found = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            found.setdefault(tuple(w[a : a + k]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, names = ALNUM.findall(lower(t)), set(), set()
        for k in {len(x) for x in found}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in found:
                    hit |= set(range(a, a + k))
                    names |= found[tuple(w[a : a + k])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("chunk", [CHUNK_BYTES, 100])
def test_decontamination(spark, documents, chunk, monkeypatch):
    import raresift.llm.decontaminate as module

    monkeypatch.setattr(module, "CHUNK_BYTES", chunk)
    items = [(1, "W3 w4, W5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (10, "short text"), (2, None), (3, ""), (4, "... !"),
             (5, "w300 w301 w302 w303 w304 w305 w306 w307 w308 w309 nothing else"), (5, "none of these words occur anywhere"),
             (6, "ünïcödé SSTRASSE")]
    bench = spark.createDataFrame([(*i, True) for i in items], "item_id long, text string, kept boolean")
    got = sorted((str(r.doc_id), *r[1:]) for r in find_contamination(documents, bench).collect())
    assert got == brute_hits(pairs(documents), items, 10)
    clean = [r for r in brute_hits(pairs(documents), items, 10) if not r[-1]]
    kept = remove_contaminated(documents, bench)
    assert kept.columns == documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in clean)
    assert find_contamination(documents.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in find_contamination(documents, bench.limit(0)).collect())


def test_longest_matches(spark, documents):
    bench = spark.createDataFrame([(1, "zz w100 w101 w102 w103 w104 w105 w106 w107 w108 w109 w110 w111 zz")], "item_id long, text string")
    rows = longest_matches(documents.filter("doc_id IN (9, 12, 7)"), bench).collect()
    assert rows and all(r.item_id == "1" and r.item_start == 1 and r.length == 12 for r in rows)
    words = {i: ALNUM.findall(lower(t)) for i, t in pairs(documents)}
    for r in rows:
        assert words[r.doc_id][r.doc_start : r.doc_start + 12] == [f"w{k}" for k in range(100, 112)]


def test_longest_matches_are_whole_and_in_every_document(spark):
    passage = " ".join(f"p{k}" for k in range(300))
    docs = spark.createDataFrame(
        [(1, f"one {passage} end"), (2, f"{passage} two"), (3, f"x {passage}"), (4, passage[:200])], "doc_id long, text string"
    ).coalesce(1)
    bench = spark.createDataFrame([(7, f"head {passage} tail")], "item_id long, text string")
    got = sorted(tuple(r) for r in longest_matches(docs, bench).collect())
    assert got == [("7", 1, 1, 1, 300), ("7", 1, 2, 0, 300), ("7", 1, 3, 1, 300)]


# ---- 7 and 9: classifiers -----------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    return docs, labels


def check_scores(rows, docs, threshold):
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_statistics():
    import pyarrow as pa

    rows = statistics(pa.array(["One two two.\nOne two two.\nx|", "", None, "ab"], pa.string()))
    own = dict(zip(STATISTICS, rows[0], strict=True))
    assert own["log_words"] == pytest.approx(math.log1p(7)) and own["repeated_lines"] == pytest.approx(1 / 3)
    assert own["unique_words"] == pytest.approx(4 / 7) and own["top_word"] == pytest.approx(2 / 7)
    assert own["odd_ends"] == pytest.approx(1 / 7) and own["ended_lines"] == pytest.approx(2 / 3)
    assert not rows[1].any() and not rows[2].any() and rows[3][0] == pytest.approx(math.log1p(2))


def test_quality_on_held_out_rows(spark, labelled, documents):
    docs, labels = labelled
    model = fit_quality(docs, labels)
    scored = score_quality(docs, model)
    test = scored.join(labels, "doc_id").filter("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in test) >= 0.95 * len(test)
    check_scores(score_quality(documents, model).collect(), documents, 0.3)
    assert score_quality(documents.limit(0), model).count() == 0
    empty = fit_quality(docs, labels.filter("quality = 1"))
    assert empty.rules == [] and score_quality(docs, empty).first().score > 0.9


def test_maximal_segments_are_those_of_the_definition():
    import random

    random_ = random.Random(8)
    for _ in range(200):
        scores = [random_.choice([-3, -1, 1, 2, 4]) for _ in range(random_.randrange(1, 12))]

        def brute(a, b):
            best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
            if best[0] <= 0:
                return []
            _, _, i, j = best
            return brute(a, i) + [(i, j, sum(scores[i:j]))] + brute(j, b)

        got = maximal_segments([float(s) for s in scores])
        assert sum(x[2] for x in got) == sum(x[2] for x in brute(0, len(scores)))
        assert max((x[2] for x in got), default=0) == max((x[2] for x in brute(0, len(scores))), default=0)


def test_repeated_words_count_in_passages():
    words = [f"bad{i}" for i in range(8)]
    data, starts, ends, _ = _words(pa.array([" ".join(words)]))
    tokens = hash_words(data, starts, ends)
    model = ToxicityModel(np.sort(tokens), np.full(8, 2.0), 1.0, -3.0, 2.0)
    plain, dense = " ".join(["some plain text"] * 100), " ".join(words)
    scattered = " ".join(f"{plain} {w}" for w in words) + f" {plain} "
    found = passages(model, pa.array([scattered, scattered + dense, f"{dense} {plain} {dense}", f"x {'bad3 ' * 11}y", None]))
    assert [len(f) for f in found] == [0, 1, 2, 1, 0]
    assert found[1][0][:3] == (len(scattered), len(scattered + dense), 16.0)
    assert [f[:2] for f in found[2]] == [(0, len(dense)), (len(f"{dense} {plain} "), len(f"{dense} {plain} {dense}"))]
    assert found[3][0][:3] == (2, 2 + 11 * 5 - 1, 22.0)


def test_toxicity_on_held_out_rows(spark, labelled, documents):
    docs, labels = labelled
    model = fit_toxicity(docs, labels)
    test = score_toxicity(docs, model).join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in test) >= 0.9 * len(test)
    check_scores(score_toxicity(documents, model).collect(), documents, 0.5)
    assert score_toxicity(documents.limit(0), model).count() == 0
    spans = toxic_passages(docs, model).limit(20).collect()
    texts = {r.doc_id: r.text.encode() for r in docs.filter(F.col("doc_id").isin([s.doc_id for s in spans])).collect()}
    assert spans and all(0 <= s.start < s.end <= len(texts[s.doc_id]) for s in spans)
    kept = remove_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == score_toxicity(docs, model).filter("predicted = 0").count()
    none = fit_toxicity(docs, labels.limit(0))
    assert {r.predicted for r in score_toxicity(documents, none).collect()} == {0}


# ---- pipeline -----------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_strings", "decontamination", "packing",
    ]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, SF_SMALL)
    model = fit_toxicity(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    clean = {r.doc_id for r in score_toxicity(docs, model).collect() if not r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == clean
    unique = stages["near_duplicates"](spark, kept, SF_SMALL)
    want = {i for i, x in brute_near(pairs(kept), 5, 80).items() if x[2]}
    assert unique.columns == docs.columns and {r.doc_id for r in unique.collect()} == want
    cut = stages["repeated_strings"](spark, unique, SF_SMALL)
    strings = brute_strings(pairs(unique), 100)
    for r in cut.collect():
        assert abs(len(r.text.encode()) - len(strings[r.doc_id][3])) <= 6 * strings[r.doc_id][2]
    left = stages["decontamination"](spark, cut, SF_SMALL)
    clean = sorted(x[0] for x in brute_hits(pairs(cut), bench, 10) if not x[-1])
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == clean
    packed = stages["packing"](spark, left, SF_SMALL)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(x) for _, x in expected_ids(pairs(left), tokenizer))
