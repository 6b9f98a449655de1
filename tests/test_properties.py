"""Property checks against brute force on samples of the event table."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from raresift.functions.expressions import hash_fraction
from raresift.operators.evaluate import binary_areas
from raresift.sources.fixtures import EVENT_KEY, event_features

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def brute_force(rows):
    """AUC-ROC by pairs (ties count half) and AUC-PR by walking thresholds."""
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y != 1]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    roc = wins / (len(pos) * len(neg))
    pr, tp, fp = 0.0, 0, 0
    prev_recall, prev_prec = 0.0, None
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(1 for x, y in rows if x == s and y == 1)
        fp += sum(1 for x, y in rows if x == s and y != 1)
        recall, prec = tp / len(pos), tp / (tp + fp)
        if prev_prec is None:
            prev_prec = prec
        pr += (recall - prev_recall) * (prec + prev_prec) / 2
        prev_recall, prev_prec = recall, prec
    return roc, pr


@SETTINGS
@given(
    seed=st.integers(0, 10_000),
    fraction=st.sampled_from([0.2, 0.5, 1.0]),
    coarse=st.sampled_from([0.01, 1.0, 10.0, 100.0]),
    buckets=st.sampled_from([1, 4, 32]),
)
def test_exact_areas_equal_brute_force(spark, seed, fraction, coarse, buckets):
    ev = event_features(spark, SF_SMALL).filter(hash_fraction(F.col(EVENT_KEY), fraction, seed))
    ev = ev.withColumn("score", F.round(F.col("Amount") / coarse) * coarse)
    rows = [(r["score"], r["label"]) for r in ev.select("score", "label").collect()]
    if not any(y == 1 for _, y in rows) or all(y == 1 for _, y in rows):
        return
    got = binary_areas(ev, "score", "label", num_buckets=buckets).first()
    roc, pr = brute_force(rows)
    assert got["auc_roc"] == pytest.approx(roc, abs=1e-12)
    assert got["auc_pr"] == pytest.approx(pr, abs=1e-12)


@SETTINGS
@given(seed=st.integers(0, 10_000), fraction=st.sampled_from([0.1, 0.5, 0.8]))
def test_hash_fraction_is_close_and_stable(spark, seed, fraction):
    ev = event_features(spark, "/root/testdata/sf0.01")
    kept = ev.filter(hash_fraction(F.col(EVENT_KEY), fraction, seed))
    n, k = ev.count(), kept.count()
    assert abs(k / n - fraction) < 0.03
    again = ev.repartition(5).filter(hash_fraction(F.col(EVENT_KEY), fraction, seed)).count()
    assert again == k


_json_value = st.one_of(
    st.none(), st.booleans(), st.integers(-10**6, 10**6), st.floats(allow_nan=False, allow_infinity=False),
    st.text(max_size=8), st.lists(st.integers(), max_size=3),
)


@SETTINGS
@given(
    junk=st.lists(st.text(max_size=40), min_size=1, max_size=20),
    objects=st.lists(
        st.dictionaries(st.sampled_from(["Time", "V1", "__id", "__sentinel", "total_published", "x"]), _json_value, max_size=5),
        max_size=20,
    ),
)
def test_decoding_never_fails_and_routes_every_message(spark, junk, objects):
    import json

    from raresift.operators.events import KINDS, decode_messages

    texts = junk + [json.dumps(o) for o in objects]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = decode_messages(df, ["Time", "V1"]).collect()
    assert len(rows) == len(texts)
    assert all(r["kind"] in KINDS for r in rows)
    for r in rows:
        if r["kind"] == "ok":
            assert r["Time"] is not None and r["V1"] is not None
        if r["kind"] in ("bad", "invalid"):
            assert r["reason"]
