"""The parts of op1 that only large tables reach: many cells, blocks, packs and rounds."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from raresift.llm import embeddings
from raresift.llm.embeddings import cells_of, near_duplicate_vectors

THRESHOLD = 0.97


def clustered(rng, n, dim, spread=0.03):
    """Unit vectors, a third of them near copies of others, and one large group."""
    x = rng.normal(size=(n, dim))
    copies = rng.choice(n, n // 3, False)
    x[copies] = x[rng.integers(0, n, len(copies))] + spread * rng.normal(size=(len(copies), dim))
    x[rng.choice(n, n // 6, False)] = x[0] + spread * rng.normal(size=(n // 6, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def brute(x):
    """(links with others, smallest row of the component) of each row."""
    hits = x @ x.T >= THRESHOLD
    part = np.arange(len(x))
    while True:
        least = np.where(hits, part, len(x)).min(axis=1)
        if (least == part).all():
            return hits.sum(axis=1) - 1, part
        part = least


def test_placing_a_batch_takes_bounded_memory():
    """A batch of Spark against many centroids once took several products of 10,000 x 4096 numbers."""
    rng = np.random.default_rng(5)
    x, centers = clustered(rng, 10_000, 16), clustered(rng, 2048, 16)
    tracemalloc.start()
    home, row, cell = cells_of(x, centers, 0.9999)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    assert len(home) == len(x) and len(row) == len(cell)


def test_guests_reach_the_homes_of_all_links():
    rng = np.random.default_rng(6)
    x = clustered(rng, 900, 16)
    home, row, cell = cells_of(x, clustered(rng, 40, 16), THRESHOLD)
    reached = set(zip(range(len(x)), home.tolist(), strict=True)) | set(zip(row.tolist(), cell.tolist(), strict=True))
    assert all((i, home[j]) in reached for i, j in np.argwhere(x @ x.T >= THRESHOLD))
    one_way = embeddings._sent(home[row], cell)
    sent = Counter(zip(home[row][one_way].tolist(), cell[one_way].tolist(), strict=True))
    assert sent and not any((b, a) in sent for a, b in sent)


def block(x, first):
    body = np.arange(first, first + len(x)).tobytes() + np.ones(len(x), np.int64).tobytes() + bytes(16 * len(x)) + x.tobytes()
    table = pa.table({"body": pa.array([body], pa.binary()), "width": pa.array([8], pa.int32()), "n": pa.array([len(x)], pa.int32())})
    return embeddings.Block(table, np.array([0]), x.shape[1])


@pytest.mark.parametrize("near", [False, True])
@pytest.mark.parametrize("leading", [False, True])
def test_blocks_compared_by_cells_and_leading_directions(monkeypatch, near, leading):
    monkeypatch.setattr(embeddings, "PLACE_ROWS", 10)
    monkeypatch.setattr(embeddings, "NEAR_ROWS", 100)
    monkeypatch.setattr(embeddings, "TILE", 3000)
    rng = np.random.default_rng(7)
    x = clustered(rng, 700, 32)
    plan = embeddings.Plan()
    if near:
        plan.near = embeddings.spherical_kmeans(embeddings.unit32(x[:300]), 20)
    if leading:
        plan.leading = np.linalg.qr(rng.normal(size=(32, 8)))[0].astype(np.float32)
    links, ends = embeddings._links(block(x[:400], 0), block(x[400:], 400), THRESHOLD, True, plan)
    right = x[400:] @ x[400:].T >= THRESHOLD
    want = (x @ x.T >= THRESHOLD).sum(axis=1) - 1
    want[400:] -= right.sum(axis=1) - 1  # rows of the second block are not compared with each other
    assert links.tolist() == want.tolist()
    hits = x @ x.T >= THRESHOLD
    hits[400:, 400:] = np.eye(300, dtype=bool)
    joined = np.zeros_like(hits)
    joined[ends[:, 0], ends[:, 1]] = True
    for m in (hits, joined):
        np.fill_diagonal(m, True)
        m |= m.T
        for _ in range(10):  # reachable in up to 1024 steps
            m[:] = m.astype(np.float32) @ m.astype(np.float32) > 0
    assert (hits == joined).all()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cells_blocks_and_rounds(spark, monkeypatch, kind):
    """Few rows to a cell, block, pack and round; results as from comparing all pairs."""
    for name, value in {
        "PLAN_ROWS": 1, "CELLS": (6, 12), "NEAR_CELLS": (4,), "LEADING": (4, 8), "COPY_NS": 0.001, "DOT_NS": 0.001, "PAIR_NS": 1000, "LEADING_NS": 900,
        "PROBE": 60, "BLOCK_VALUES": 16 * 20, "PACK_ROWS": 7, "ROUND_BYTES": 4096, "MOST_FOUND": 3,
    }.items():
        monkeypatch.setattr(embeddings, name, value)
    plans, rounds = [], []
    planned, written = embeddings._plans, embeddings.materialize
    monkeypatch.setattr(embeddings, "_plans", lambda *a: plans.append(planned(*a)) or plans[-1])
    monkeypatch.setattr(embeddings, "materialize", lambda df, name: rounds.append(name) or written(df, name))
    rng = np.random.default_rng(8)
    x = clustered(rng, 500, 16).astype(np.float32).astype(float)
    labels = (np.arange(500) % 5 > 0).astype(int)
    rows = [(i, v, k) for i, (v, k) in enumerate(zip(x.tolist(), labels.tolist(), strict=True))]
    rows += [(600 + i, rows[i][1], rows[i][2]) for i in range(0, 40, 2)]  # equal vectors
    rows += [(700, rows[1][1], None), (701, None, 1), (702, [0.0] * 16, 1), (703, [-0.0] * 15 + [2.0], 1), (704, [0.0] * 15 + [2.0], 1)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df, THRESHOLD).collect()}
    want = {r[0]: (0, r[0], True) for r in rows}
    for label in (0, 1):
        some = [r for r in rows if r[2] == label and r[1] and any(r[1])]
        y = np.array([r[1] for r in some])
        links, part = brute(y / np.linalg.norm(y, axis=1)[:, None])
        want |= {r[0]: (n, some[k][0], some[k][0] == r[0]) for r, n, k in zip(some, links.tolist(), part.tolist(), strict=True)}
    assert plans[0][16].cells is not None
    assert rounds.count("vector-links") > 3
    assert got == want
