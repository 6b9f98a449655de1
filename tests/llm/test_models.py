"""The two trained scorers against plain Python from their definitions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_MID
from raresift.llm.quality import STATISTICS, fit_quality, score_quality, statistics
from raresift.llm.toxicity import (
    HELD_BACK, K, LOSS, MAX_EXPECTED, MIN_RATIO, MIN_Z, PREFIXES, PRIOR_SHARE, fit_toxicity, score_toxicity,
)
from test_robust import segments_by_definition

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


# ---- 7: rules ---------------------------------------------------------------


def test_compiled_rules_are_the_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    assert 0 < len(model.rules) and all(weight for _, weight in model.rules)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "long words " * 300_000)]
    values = statistics(pa.array([t for _, t in rows], pa.string()))
    margin = np.full(len(rows), model.intercept)
    for rule, weight in model.rules:
        inside = np.ones(len(rows), bool)
        for name, low, high in rule:
            x = values[:, STATISTICS.index(name)]
            inside &= (x > low) & (x <= high)
        margin += weight * inside
    scores = 1 / (1 + np.exp(-margin))
    got = {r.doc_id: r for r in score_quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), model).collect()}
    for (i, _), score in zip(rows, scores):
        assert got[i].score == pytest.approx(score, abs=1e-12)
        assert got[i].predicted == int(got[i].score >= 0.3) and got[i].held_out == held_out(i)


def test_rules_are_fitted_without_the_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if held_out(r.doc_id) else r.quality) for r in labels.collect()] + [(None, 1), (10**7, None)],
        "doc_id long, quality int",
    )
    assert fit_quality(docs, labels) == fit_quality(docs, turned)


def test_no_labels_give_the_share(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d")], "doc_id long, text string")
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int")
    scores = {r.score for r in score_quality(docs, fit_quality(docs, one_kind)).collect()}
    assert len(scores) == 1 and 0.99 < scores.pop() < 1


# ---- 9: log-odds, lambda, segments, curve -----------------------------------


def tokens_of(word):
    return [(0, word)] + [(size, word[:size]) for size in PREFIXES if len(word) > size]


def toxic_corpus():
    rng = random.Random(6)
    plain = [f"plain{i}" for i in range(200)] + ["été", "the", "of"]
    bad = [f"vile{i}" for i in range(12)]
    rows = []
    for i in range(400):
        words = rng.choices(plain, k=rng.randint(0, 40))
        if i % 28 == 0:
            pass  # marked as toxic for nothing in the text
        elif i % 4 == 0 or i % 30 == 1:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randint(0, len(words)), rng.choice(bad).title())
        elif i % 50 == 1:
            words.append(rng.choice(bad))
        rows.append((i, " ".join(words)))
    return rows, [(i, int(i % 4 == 0)) for i, _ in rows]


def test_toxicity_from_its_definition(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows + [(500, None), (501, "")], "doc_id long, text string").repartition(3)
    marked = spark.createDataFrame(labels + [(None, 1), (500, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, marked)

    y = dict(labels)
    train = [(i, t) for i, t in rows if not held_out(i)]
    toxic, other = Counter(), Counter()
    for i, t in train:
        for token in {x for w in WORD.findall(t.encode().translate(UPPER)) for x in tokens_of(w)}:
            (toxic if y[i] else other)[token] += 1
    total = {1: sum(toxic.values()), 0: sum(other.values())}
    weights = {}
    for token, a in toxic.items():
        b = other[token]
        prior = PRIOR_SHARE * (a + b)
        odds = math.log((a + prior) / (total[1] * (1 + PRIOR_SHARE))) - math.log((b + prior) / (total[0] * (1 + PRIOR_SHARE)))
        spread = math.sqrt(1 / (a + prior) + 1 / (b + prior))
        if a > 1 and odds / spread >= MIN_Z and odds >= math.log(MIN_RATIO):
            weights[token] = odds - HELD_BACK * spread
    assert weights and sorted(model.weights.tolist()) == pytest.approx(sorted(weights.values()), rel=1e-9)

    n_words = sum(len(re.split(r"\s+", t)) for _, t in train)
    share = {k: (other[k] + PRIOR_SHARE * (toxic[k] + other[k])) / n_words for k in weights}
    if (whole := sum(share.values())) > 0.5:
        share = {k: v * 0.5 / whole for k, v in share.items()}
    rest = 1 - sum(share.values())
    assert sum(share[k] * math.exp(model.decay * weights[k]) for k in weights) + rest * math.exp(-model.decay * LOSS) == pytest.approx(1, abs=1e-6)

    def evidence(text):
        words = WORD.findall((text or "").encode().translate(UPPER))
        scores = [max([weights[t] for t in tokens_of(w) if t in weights], default=-LOSS) for w in words]
        scores = [s if s > 0 else -LOSS for s in scores]
        logs = [math.log(K * len(words)) - model.decay * s for _, _, s in segments_by_definition(scores)]
        return -sum(x for x in logs if x < math.log(MAX_EXPECTED))

    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    for i, t in rows + [(500, None), (501, "")]:
        z = model.intercept + model.slope * math.log1p(evidence(t))
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), rel=1e-6), i
        assert got[i].predicted == int(got[i].score >= 0.5) and got[i].held_out == held_out(i)

    # the curve is where the slope of its penalised likelihood vanishes
    x = np.array([round(math.log1p(evidence(t)) * 20) / 20 for _, t in train])
    p = 1 / (1 + np.exp(-(model.intercept + model.slope * x)))
    d = np.array([y[i] for i, _ in train]) - p
    assert d.sum() - 1e-3 * model.intercept == pytest.approx(0, abs=1e-3)
    assert (d * x).sum() - 1e-2 * model.slope == pytest.approx(0, abs=1e-3)
