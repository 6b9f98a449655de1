"""The driver contract, and a DuckDB check of fast queries at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from raresift.plans.queries import QUERIES

FAST = [
    "clean_transactions", "clean_counts", "class_profile", "class_weights", "sample_fraction",
    "train_test_counts", "score_closed_form", "confusion_matrix", "sample_predictions",
    "flagged_alerts", "auc_roc", "auc_pr", "encode_events", "decode_events", "scaler_std",
    "event_time_positions", "published_positions", "csv_class_profile", "card_messages_scored", "model_roundtrip", "fit_quality", "training_summary",
]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "transaction_count", "avg_amount", "max_amount"]
    assert len(rows) >= 1


def test_every_query_has_an_oracle():
    qs, oracle = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(QUERIES) <= set(oracle)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_norm(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    cur = con.execute(entry_mod.oracle_sql()[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    s_rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(o_cols)
    assert _bag(df.columns, s_rows) == _bag(o_cols, o_rows)
