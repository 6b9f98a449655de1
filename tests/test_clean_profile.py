import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from raresift.functions.schema import feature_columns
from raresift.operators.clean import (
    COPIES,
    clean_table,
    clean_tally,
    drop_duplicate_rows,
    drop_incomplete,
    sample_rows,
    tally_counts,
    tally_rows,
)
from raresift.operators.profile import (
    NO_POSITIVES,
    class_profile,
    class_weights,
    with_class_weight,
)
from raresift.sources.fixtures import TXN_KEY, transactions


def test_drop_incomplete_treats_nan_as_null(spark):
    df = spark.createDataFrame(
        [(1.0, 1), (None, 1), (float("nan"), 0), (2.0, None)], "x double, Class int"
    )
    assert drop_incomplete(df).count() == 1


def test_duplicates_nan_and_signed_zero(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1), (float("nan"), 1), (0.0, 0), (-0.0, 0), (1.0, 0)], "x double, Class int"
    )
    assert drop_duplicate_rows(df).count() == 3


def test_clean_fixture_counts(spark):
    raw = transactions(spark, SF_MID)
    clean = clean_table(raw)
    assert raw.count() == 61205
    assert clean.count() == 56201
    assert "label" in clean.columns and "Class" not in clean.columns


def test_sample_fraction_one_is_identity(spark):
    raw = transactions(spark, SF_SMALL)
    assert sample_rows(raw, 1.0) is raw


def test_hash_sample_is_layout_independent(spark):
    raw = transactions(spark, SF_SMALL)
    a = sample_rows(raw.repartition(3), 0.3, key=[TXN_KEY]).select(TXN_KEY)
    b = sample_rows(raw.repartition(7), 0.3, key=[TXN_KEY]).select(TXN_KEY)
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())


def test_class_weight_value(spark):
    clean = clean_table(transactions(spark, SF_MID))
    c = tally_counts(tally_rows(transactions(spark, SF_MID))).first()
    expected = math.sqrt(c["negatives"] / c["positives"])
    given = with_class_weight(clean, counts=(c["rows_after_cleaning"], c["positives"]))
    assert given.filter(F.col("label") == 1).first()["weight"] == pytest.approx(expected, rel=1e-12)
    w = with_class_weight(clean).filter(F.col("label") == 1).select("weight").distinct().collect()
    assert len(w) == 1 and w[0][0] == pytest.approx(expected, rel=1e-12)
    assert round(expected, 6) == 30.588941
    rows = {r["label"]: r["weight"] for r in class_weights(clean).collect()}
    assert rows[0] == 1.0


def test_class_weight_without_positives_fails_by_name(spark):
    clean = clean_table(transactions(spark, SF_SMALL)).filter(F.col("label") == 0)
    with pytest.raises(Exception) as err:
        with_class_weight(clean).collect()
    with pytest.raises(ValueError, match="NO_POSITIVE_ROWS"):
        with_class_weight(clean, counts=(10, 0))
    with pytest.raises(Exception, match="NO_POSITIVE_ROWS"):
        class_weights(clean).collect()
    assert NO_POSITIVES.split(":")[0] in str(err.value)


def test_class_profile_sql(spark):
    clean = clean_table(transactions(spark, SF_MID))
    rows = class_profile(spark, clean).collect()
    assert [r["label"] for r in rows] == [0, 1]
    assert sum(r["transaction_count"] for r in rows) == 56201
    assert not spark.catalog.tableExists("transactions")
    other = class_profile(spark, clean, group="V1", measures=[("least", "min", "Amount")], digits=1)
    assert other.columns == ["V1", "transaction_count", "least"] and other.count() == 50


def test_feature_list_excludes_label_weight_and_key(spark):
    clean = with_class_weight(clean_table(transactions(spark, SF_SMALL)))
    assert feature_columns(clean, extra_exclude=[TXN_KEY]) == ["Time", "V1", "V2", "V3", "Amount"]


def test_tally_cleaning_equals_clean_table(spark):
    raw = transactions(spark, SF_MID)
    tally = tally_rows(raw)
    assert tally.agg(F.sum(COPIES)).first()[0] == 61205
    a = clean_table(raw)
    b = clean_tally(tally)
    assert a.columns == b.columns
    assert tally.filter("Class IS NULL").count() == 1  # all incomplete rows
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_keyless_sample(spark):
    raw = transactions(spark, SF_SMALL)
    s = sample_rows(raw, 0.5, seed=7)  # no key: Spark's seeded Bernoulli sample
    assert 0.35 * raw.count() < s.count() < 0.65 * raw.count()


def test_is_complete_agrees_with_drop_incomplete(spark):
    from raresift.operators.clean import is_complete

    df = spark.createDataFrame(
        [(1.0, "a", 1), (None, "a", 1), (float("nan"), "b", 0), (2.0, None, 0), (3.0, "c", None), (4.0, "d", 0)],
        "x double, s string, Class int",
    )
    assert df.filter(is_complete(df)).count() == drop_incomplete(df).count() == 2
