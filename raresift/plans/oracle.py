"""DuckDB SQL for every registered query (the correctness oracle).

Each statement reads only the shared test tables (pre-registered views)
and re-derives the same fixtures with the same rules as
``raresift.sources.fixtures``.  Computed doubles are rounded on both sides.
"""

from __future__ import annotations

from raresift.functions.expressions import DECISION_THRESHOLD, MAX_ITER, SEED, TRAIN_FRACTION, hash_cut_hex
from raresift.plans.queries import CARD_SCORER, EVENT_SCORER, SAMPLE_FRACTION, TXN_SCORER

# Fixture T (transactions) with its injected faults, and its cleaned form.
T_RAW = """
t_base AS (
    SELECT
        concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS txn_key,
        CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS "Time",
        l_quantity AS V1,
        l_discount AS V2,
        nullif(l_tax, 0.0) AS V3,
        l_extendedprice AS Amount,
        CAST(CASE WHEN l_quantity >= 50 AND l_discount >= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS "Class"
    FROM lineitem
),
t_raw AS (
    SELECT * FROM t_base
    UNION ALL
    SELECT * FROM t_base WHERE V1 = 7.0
)"""

T_CLEAN = T_RAW + """,
t_clean AS (
    SELECT DISTINCT txn_key, "Time", V1, V2, V3, Amount, "Class" AS label
    FROM t_raw
    WHERE txn_key IS NOT NULL
      AND "Time" IS NOT NULL AND NOT isnan("Time")
      AND V1 IS NOT NULL AND NOT isnan(V1)
      AND V2 IS NOT NULL AND NOT isnan(V2)
      AND V3 IS NOT NULL AND NOT isnan(V3)
      AND Amount IS NOT NULL AND NOT isnan(Amount)
      AND "Class" IS NOT NULL
)"""

_TRAIN_CUT = hash_cut_hex(TRAIN_FRACTION)

T_SPLIT = T_CLEAN + f""",
t_split AS (
    SELECT *,
           substr(md5('{SEED}:' || txn_key), 1, 8) < '{_TRAIN_CUT}' AS is_train
    FROM t_clean
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


ORACLE: dict[str, str] = {}

ORACLE["clean_transactions"] = _with(T_CLEAN) + """
SELECT txn_key, "Time", V1, V2, V3, Amount, label FROM t_clean
"""

ORACLE["clean_counts"] = _with(T_CLEAN) + """
SELECT
    (SELECT count(*) FROM t_raw) AS rows_before_cleaning,
    count(*) AS rows_after_cleaning,
    CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS positives,
    CAST(count(*) FILTER (WHERE label <> 1) AS BIGINT) AS negatives
FROM t_clean
"""

# The profile by its definition: one row per class, from the class's own rows.
ORACLE["class_profile"] = _with(T_CLEAN) + """
SELECT c.label,
       (SELECT count(*) FROM t_clean r WHERE r.label = c.label) AS transaction_count,
       (SELECT round(sum(r.Amount) / count(r.Amount), 2) FROM t_clean r WHERE r.label = c.label) AS avg_amount,
       (SELECT round(r.Amount, 2) FROM t_clean r WHERE r.label = c.label ORDER BY r.Amount DESC LIMIT 1) AS max_amount
FROM (SELECT DISTINCT label FROM t_clean) c
"""

ORACLE["class_weights"] = _with(T_CLEAN) + """
, w AS (
    SELECT sqrt(CAST(count(*) - count(*) FILTER (WHERE label = 1) AS DOUBLE)
                / count(*) FILTER (WHERE label = 1)) AS pos_weight
    FROM t_clean
)
SELECT label, count(*) AS rows,
       round(CASE WHEN label = 1 THEN (SELECT pos_weight FROM w) ELSE CAST(1.0 AS DOUBLE) END, 6) AS weight
FROM t_clean
GROUP BY label
"""

_SAMPLE_CUT = hash_cut_hex(SAMPLE_FRACTION)

ORACLE["sample_fraction"] = _with(T_RAW) + f"""
SELECT * FROM t_raw
WHERE substr(md5('{SEED}:' || txn_key), 1, 8) < '{_SAMPLE_CUT}'
"""

ORACLE["train_test_counts"] = _with(T_SPLIT) + """
SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, label, count(*) AS rows
FROM t_split
GROUP BY ALL
"""


def _txn_scored() -> str:
    return T_SPLIT + f""",
t_scored AS (
    SELECT *, {TXN_SCORER.sql_probability()} AS probability
    FROM t_split WHERE NOT is_train
),
t_pred AS (
    SELECT *, CASE WHEN probability > {TXN_SCORER.threshold!r} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM t_scored
)"""


ORACLE["score_closed_form"] = _with(_txn_scored()) + """
SELECT txn_key, label, round(probability, 6) AS probability, prediction FROM t_pred
"""

ORACLE["confusion_matrix"] = _with(_txn_scored()) + """
SELECT label, CAST(prediction AS INTEGER) AS prediction, count(*) AS count
FROM t_pred GROUP BY ALL ORDER BY 1, 2
"""

ORACLE["sample_predictions"] = _with(_txn_scored()) + """
SELECT txn_key, label, CAST(prediction AS INTEGER) AS prediction
FROM t_pred ORDER BY txn_key LIMIT 50
"""

ORACLE["flagged_alerts"] = _with(_txn_scored()) + """
SELECT txn_key,
       printf('FRAUD FLAGGED: time=%.1f amount=%.2f', "Time", Amount) AS alert,
       "Time", Amount, prediction
FROM t_pred WHERE prediction = 1.0
"""

_EVENT_AREAS = """
WITH g AS (
    SELECT value AS s,
           CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS p,
           CAST(count(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) AS n
    FROM events WHERE value IS NOT NULL GROUP BY value
),
c AS (
    SELECT p, n,
           sum(p) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
           sum(n) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
    FROM g
),
a AS (
    SELECT sum(p) AS "P", sum(n) AS "N", sum(p * fp) AS "A", sum(p * n) AS "C",
           sum(p * (tp / (tp + fp)
                    + CASE WHEN tp - p + fp - n = 0 THEN tp / (tp + fp)
                           ELSE (tp - p) / (tp - p + fp - n) END) / 2) AS "R"
    FROM c
)
"""

ORACLE["auc_roc"] = _EVENT_AREAS + """
SELECT round(("P" * "N" - "A" + "C" / 2) / ("P" * "N"), 9) AS auc_roc,
       CAST("P" AS BIGINT) AS positives, CAST("N" AS BIGINT) AS negatives
FROM a
"""

ORACLE["auc_pr"] = _EVENT_AREAS + """
SELECT round("R" / "P", 9) AS auc_pr,
       CAST("P" AS BIGINT) AS positives, CAST("N" AS BIGINT) AS negatives
FROM a
"""

ORACLE["scaler_std"] = _with(T_SPLIT) + """
, tr AS (SELECT * FROM t_split WHERE is_train)
SELECT 'Time' AS feature, round(stddev_samp("Time"), 6) AS std FROM tr
UNION ALL SELECT 'V1', round(stddev_samp(V1), 6) FROM tr
UNION ALL SELECT 'V2', round(stddev_samp(V2), 6) FROM tr
UNION ALL SELECT 'V3', round(stddev_samp(V3), 6) FROM tr
UNION ALL SELECT 'Amount', round(stddev_samp(Amount), 6) FROM tr
"""


# Fixture E and its message stream (same fault ids as the Spark fixture).
def _event_ctes() -> str:
    from raresift.sources.fixtures import (
        BAD_IDS,
        INVALID_IDS,
        JSON_NULL_ID,
        MISSING_FIELD_ID,
        NAN_ID,
        NOT_A_NUMBER_ID,
        MESSAGE_TIME_STEP,
        REDELIVERED_AMOUNT,
        REDELIVERED_IDS,
    )

    bad = ", ".join(map(str, BAD_IDS))
    redelivered = ", ".join(map(str, REDELIVERED_IDS))
    faulty = ", ".join(map(str, (*INVALID_IDS, *BAD_IDS)))
    return f"""
e AS (
    SELECT event_id AS __id,
           epoch_us(ts) / 1e6 AS "Time",
           CAST(user_id AS DOUBLE) AS V1,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS V2,
           value AS Amount,
           CAST(event_type = 'error' AS INTEGER) AS label
    FROM events
),
body AS (
    SELECT
        CASE WHEN __id IN ({bad}) THEN NULL ELSE __id END AS __id,
        CASE WHEN __id IN ({bad}) THEN 'bad'
             WHEN __id IN ({MISSING_FIELD_ID}, {JSON_NULL_ID}, {NAN_ID}, {NOT_A_NUMBER_ID}) THEN 'invalid'
             ELSE 'ok' END AS kind,
        CASE WHEN __id IN ({bad}) THEN 'not_a_json_object'
             WHEN __id = {MISSING_FIELD_ID} THEN 'Amount:missing'
             WHEN __id = {JSON_NULL_ID} THEN 'V1:missing'
             WHEN __id = {NAN_ID} THEN 'Time:nan'
             WHEN __id = {NOT_A_NUMBER_ID} THEN 'V2:not_a_number'
             END AS reason,
        CASE WHEN __id IN ({bad}) THEN NULL WHEN __id = {NAN_ID} THEN CAST('nan' AS DOUBLE)
             ELSE floor("Time" / {MESSAGE_TIME_STEP}) * {MESSAGE_TIME_STEP} END AS "Time",
        CASE WHEN __id IN ({bad}) OR __id = {JSON_NULL_ID} THEN NULL ELSE V1 END AS V1,
        CASE WHEN __id IN ({bad}) OR __id = {NOT_A_NUMBER_ID} THEN NULL ELSE V2 END AS V2,
        CASE WHEN __id IN ({bad}) OR __id = {MISSING_FIELD_ID} THEN NULL ELSE Amount END AS Amount,
        CAST(NULL AS BIGINT) AS total_published,
        __id AS src_id
    FROM e
),
deliveries AS (
    SELECT CAST(NULL AS BIGINT) AS __id, 'sentinel' AS kind, CAST(NULL AS VARCHAR) AS reason,
           CAST(NULL AS DOUBLE) AS "Time", CAST(NULL AS DOUBLE) AS V1, CAST(NULL AS DOUBLE) AS V2,
           CAST(NULL AS DOUBLE) AS Amount, (SELECT count(*) FROM events) AS total_published,
           CAST(NULL AS BIGINT) AS src_id
    UNION ALL SELECT * FROM body
    UNION ALL SELECT * FROM body
    WHERE (src_id IN ({redelivered}) OR Amount >= {REDELIVERED_AMOUNT} AND src_id % 2 = 0) AND src_id NOT IN ({faulty})
),
scored AS (
    SELECT *,
           CASE WHEN kind = 'ok' THEN {EVENT_SCORER.sql_probability()} END AS probability
    FROM deliveries
),
pred AS (
    SELECT *,
           CASE WHEN kind <> 'ok' THEN NULL
                WHEN probability > {EVENT_SCORER.threshold!r} THEN CAST(1.0 AS DOUBLE)
                ELSE CAST(0.0 AS DOUBLE) END AS prediction
    FROM scored
)"""


ORACLE["encode_events"] = "WITH " + _event_ctes().strip() + """
SELECT __id, "Time", V1, V2, Amount, label FROM e
"""

ORACLE["decode_events"] = "WITH " + _event_ctes().strip() + """
SELECT __id, kind, reason,
       CASE WHEN kind = 'ok' THEN "Time" END AS "Time",
       CASE WHEN kind = 'ok' THEN V1 END AS V1,
       CASE WHEN kind = 'ok' THEN V2 END AS V2,
       CASE WHEN kind = 'ok' THEN Amount END AS Amount,
       total_published
FROM deliveries
"""

ORACLE["stream_scored"] = "WITH " + _event_ctes().strip() + """
SELECT __id, round(probability, 6) AS probability, prediction FROM pred WHERE kind = 'ok'
"""

ORACLE["stream_report"] = "WITH " + _event_ctes().strip() + """
SELECT
    count(*) FILTER (WHERE kind <> 'sentinel') AS total_messages_seen,
    max(total_published) AS sentinel_total_published,
    count(*) FILTER (WHERE prediction = 1.0) AS frauds_flagged_count,
    count(DISTINCT CASE WHEN prediction = 1.0 THEN "Time" END) AS frauds_distinct_time,
    count(DISTINCT CASE WHEN prediction = 1.0 THEN __id END) AS frauds_distinct_id,
    count(DISTINCT CASE WHEN kind <> 'sentinel' THEN __id END) AS distinct_ids_seen,
    count(*) FILTER (WHERE kind = 'ok') AS scored_messages,
    count(*) FILTER (WHERE kind = 'invalid') AS invalid_messages,
    count(*) FILTER (WHERE kind = 'bad') AS bad_messages,
    coalesce(count(DISTINCT CASE WHEN kind <> 'sentinel' THEN __id END) = max(total_published), false) AS complete,
    true AS finished
FROM pred
"""

ORACLE["report_fields"] = "WITH " + _event_ctes().strip() + """
SELECT
    count(*) FILTER (WHERE prediction = 1.0) AS frauds_flagged_count,
    count(*) FILTER (WHERE kind <> 'sentinel') AS total_messages_seen,
    max(total_published) AS sentinel_total_published
FROM pred
"""

ORACLE["report_frauds"] = "WITH " + _event_ctes().strip() + """
SELECT CAST(row_number() OVER (ORDER BY __id) - 1 AS INTEGER) AS pos, __id, "Time", V1, V2, Amount, prediction
FROM pred WHERE prediction = 1.0 QUALIFY pos < 100
"""

ORACLE["unique_by_time"] = "WITH " + _event_ctes().strip() + """
SELECT "Time", __id, Amount, prediction FROM pred WHERE prediction = 1.0
QUALIFY row_number() OVER (PARTITION BY "Time" ORDER BY __id) = 1
"""

ORACLE["stream_dedup"] = "WITH " + _event_ctes().strip() + """
SELECT DISTINCT __id, kind, reason FROM deliveries WHERE __id IS NOT NULL
UNION ALL
SELECT __id, kind, reason FROM deliveries WHERE __id IS NULL
"""

ORACLE["csv_class_profile"] = ORACLE["class_profile"]

ORACLE["published_positions"] = "WITH " + _event_ctes().strip() + """
SELECT CAST(row_number() OVER (ORDER BY __id) - 1 AS BIGINT) AS __id, 'ok' AS kind,
       "Time", V1, V2, Amount, label
FROM e
"""

ORACLE["stream_alerts"] = "WITH " + _event_ctes().strip() + """
SELECT __id, printf('FRAUD FLAGGED: time=%.1f amount=%.2f', "Time", Amount) AS alert
FROM pred WHERE prediction = 1.0
"""

ORACLE["event_time_positions"] = """
SELECT event_id AS __id, CAST(row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS BIGINT) AS position
FROM events
"""

_TEST_ROWS = "(SELECT count(*) FROM t_split WHERE NOT is_train)"

ORACLE["model_roundtrip"] = _with(T_SPLIT) + f"""
SELECT {_TEST_ROWS} AS rows_compared, 0::BIGINT AS rows_differing
"""

ORACLE["fit_quality"] = _with(T_SPLIT) + f"""
SELECT (SELECT count(*) FROM t_split WHERE is_train) AS train_rows, {_TEST_ROWS} AS test_rows,
       true AS areas_agree, true AS above_floor
"""

ORACLE["stream_model_scored"] = "WITH " + _event_ctes().strip() + """
SELECT kind, count(*) AS rows, 0::BIGINT AS rows_differing FROM deliveries GROUP BY kind
"""

ORACLE["training_summary"] = ORACLE["class_profile"].replace(_with(T_CLEAN), _with(T_SPLIT) + ", profile AS (") + f"""
)
SELECT (SELECT count(*) FROM t_raw) AS rows_before_cleaning, (SELECT count(*) FROM t_clean) AS rows_after_cleaning,
       (SELECT count(*) FROM t_split WHERE is_train) AS train_rows, {_TEST_ROWS} AS test_rows,
       1.0::DOUBLE AS sample_fraction, {MAX_ITER}::INTEGER AS max_iter, {DECISION_THRESHOLD}::DOUBLE AS decision_threshold,
       profile.*, {_TEST_ROWS} AS confusion_rows, least(50, {_TEST_ROWS}) AS sample_rows
FROM profile
"""

_CARD_BASE = "(l_quantity * 7 + l_discount * 100 + l_tax * 300)"

ORACLE["card_messages_scored"] = f"""
WITH c AS (
    SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS row_id,
           CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS "Time",
           {", ".join(f"({_CARD_BASE} * {i}) % 10 AS V{i}" for i in range(1, 29))},
           l_extendedprice AS Amount
    FROM lineitem
), p AS (
    SELECT *, {CARD_SCORER.sql_probability()} AS probability FROM c
)
SELECT row_id, round(probability, 6) AS probability,
       CASE WHEN probability > {CARD_SCORER.threshold!r} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
       CASE WHEN probability > {CARD_SCORER.threshold!r} THEN printf('FRAUD FLAGGED: time=%.1f amount=%.2f', "Time", Amount) END AS alert
FROM p
"""


# ---- how streams run -----------------------------------------------------

ORACLE["stream_restart"] = "WITH " + _event_ctes().strip() + """
SELECT kind, count(*) AS deliveries, count(*) AS stored, 0::BIGINT AS missing, 0::BIGINT AS repeated, true AS resumed
FROM deliveries GROUP BY kind
"""


def _counts(rows: str, run: str) -> str:
    return f"""
SELECT '{run}' AS run,
    count(*) FILTER (WHERE kind <> 'sentinel') AS total_messages_seen,
    max(total_published) AS sentinel_total_published,
    count(*) FILTER (WHERE prediction = 1.0) AS frauds_flagged_count,
    count(*) FILTER (WHERE kind = 'ok') AS scored_messages,
    count(*) FILTER (WHERE kind = 'invalid') AS invalid_messages,
    count(*) FILTER (WHERE kind = 'bad') AS bad_messages,
    count(DISTINCT CASE WHEN prediction = 1.0 THEN "Time" END) AS frauds_distinct_time,
    count(DISTINCT CASE WHEN prediction = 1.0 THEN __id END) AS frauds_distinct_id,
    count(DISTINCT CASE WHEN kind <> 'sentinel' THEN __id END) AS distinct_ids_seen,
    coalesce(count(DISTINCT CASE WHEN kind <> 'sentinel' THEN __id END) = max(total_published), false) AS complete,
    true AS equals_batch
FROM {rows}"""


# every message of the body once: repeats are the second row of their id
_BODY_PRED = "(SELECT * FROM pred WHERE kind <> 'sentinel' QUALIFY row_number() OVER (PARTITION BY src_id) = 1)"

ORACLE["stream_running_counts"] = "WITH " + _event_ctes().strip() + _counts("pred", "all") + " UNION ALL " + _counts(_BODY_PRED, "body") + """
UNION ALL SELECT 'cut', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true
"""

ORACLE["stream_live"] = "WITH " + _event_ctes().strip() + """
, seen AS (SELECT count(*) FILTER (WHERE kind <> 'sentinel') AS n, max(total_published) AS total FROM deliveries)
SELECT 'early' AS "case", true AS finished, n AS seen, total AS published, true AS in_time FROM seen
UNION ALL SELECT 'late', true, n, total, true FROM seen
UNION ALL SELECT 'capped', false, NULL, NULL, true
"""

ORACLE["stream_admission"] = "WITH " + _event_ctes().strip() + """
SELECT count(*) AS deliveries, count(*) AS places, max(total_published) AS published, count(*) AS admitted,
       0::BIGINT AS small_by_rows, true AS both_ways, true AS finished
FROM deliveries
"""

ORACLE["stream_first_per_time"] = ORACLE["unique_by_time"]


# ---- fits, areas, malformed input, documents, sink layout ------------------

_NEWTON_STEPS = 8


def _newton() -> str:
    """Newton steps for an intercept and two features, each step's 3 x 3 system by Cramer's rule."""
    gram = ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))
    x = ("1.0", "x1", "x2")
    out = """WITH e AS (
    SELECT CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v, value AS a, CAST(event_type = 'error' AS DOUBLE) AS y FROM events
), used AS (
    SELECT * FROM e WHERE v IS NOT NULL AND a IS NOT NULL AND NOT isnan(v) AND NOT isnan(a)
), s AS (
    SELECT stddev_samp(v) AS s1, stddev_samp(a) AS s2, count(*) AS n FROM used
), r AS (
    SELECT v / s1 AS x1, a / s2 AS x2, y FROM used, s
), n0 AS (
    SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
)"""
    for k in range(_NEWTON_STEPS):
        sums = [f"sum((p - y) * {x[i]}) AS g{i}" for i in range(3)] + [f"sum(p * (1 - p) * {x[i]} * {x[j]}) AS h{i}{j}" for i, j in gram]
        out += f""", t{k} AS (
    SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, {", ".join(sums)}
    FROM (SELECT *, 1.0 / (1.0 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM r, n{k})
), n{k + 1} AS (
    SELECT b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d AS b0,
        b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d AS b1,
        b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d AS b2
    FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS d FROM t{k})
)"""
    last = f"n{_NEWTON_STEPS}"
    return out + f"""
SELECT 'intercept' AS term, round(b0, 6) AS weight, true AS same FROM {last}
UNION ALL SELECT 'V2', round(b1 / s1, 6), true FROM {last}, s
UNION ALL SELECT 'Amount', round(b2 / s2, 6), true FROM {last}, s
"""


ORACLE["newton_weights"] = _newton()

ORACLE["binned_areas"] = "WITH " + _event_ctes().strip() + f""",
b AS (
    SELECT floor({EVENT_SCORER.sql_probability()} / 0.001) AS bin, label FROM e
),
g AS (
    SELECT bin, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS n
    FROM b WHERE bin IS NOT NULL GROUP BY bin
),
c AS (
    SELECT p, n, sum(p) OVER (ORDER BY bin DESC) AS tp, sum(n) OVER (ORDER BY bin DESC) AS fp FROM g
)
SELECT round((sum(p) * sum(n) - sum(p * fp) + sum(p * n) / 2) / (sum(p) * sum(n)), 9) AS auc_roc,
    round(sum(p * (tp / (tp + fp) + CASE WHEN tp - p + fp - n = 0 THEN tp / (tp + fp) ELSE (tp - p) / (tp - p + fp - n) END) / 2) / sum(p), 9) AS auc_pr,
    round(sum(p * n) / (2 * sum(p) * sum(n)), 9) AS roc_error,
    CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, count(*) AS bins, true AS merged_equal
FROM c
"""

ORACLE["csv_quarantine"] = _with(T_RAW) + """
, f AS (
    SELECT txn_key, CASE WHEN "Class" <> 0 THEN NULL WHEN V1 = 13 THEN 'V2:not_a_double' WHEN V1 = 17 THEN 'too_few_fields'
        WHEN V1 = 19 THEN 'too_many_fields' WHEN V1 = 23 THEN 'Time:not_a_double,Amount:not_a_double' END AS reason FROM t_raw
)
SELECT txn_key, reason, count(*) AS rows FROM f WHERE reason IS NOT NULL GROUP BY txn_key, reason
UNION ALL SELECT NULL, 'none', count(*) FROM f WHERE reason IS NULL
"""

ORACLE["sink_compacted"] = "WITH " + _event_ctes().strip() + """
, k AS (
    SELECT kind, count(*) AS rows, count(*) FILTER (WHERE prediction = 1.0) AS flagged, CAST(coalesce(sum(__id), 0) AS BIGINT) AS id_sum FROM pred GROUP BY kind
)
SELECT kind, rows, flagged, id_sum, rows AS after_rows, flagged AS after_flagged, id_sum AS after_id_sum, true AS pruned FROM k
"""

ORACLE["training_document"] = ORACLE["class_profile"].replace(_with(T_CLEAN), _with(T_SPLIT) + ", profile AS (") + f"""
), first50 AS (SELECT label FROM t_split WHERE NOT is_train ORDER BY txn_key LIMIT 50)
SELECT (SELECT count(*) FROM t_raw) AS rows_before_cleaning, (SELECT count(*) FROM t_clean) AS rows_after_cleaning,
       (SELECT count(*) FROM t_split WHERE is_train) AS train_rows, {_TEST_ROWS} AS test_rows,
       1.0::DOUBLE AS sample_fraction, {MAX_ITER}::INTEGER AS max_iter, {DECISION_THRESHOLD}::DOUBLE AS decision_threshold,
       true AS areas_in_range, {_TEST_ROWS} AS confusion_rows, (SELECT count(*) FROM first50) AS sample_rows,
       (SELECT CAST(sum(label) AS BIGINT) FROM first50) AS sample_ones, true AS sample_right, profile.*
FROM profile
"""

ORACLE["missing_input"] = """
SELECT reader, 'InputNotFound' AS error, (SELECT count(*) FROM events) AS rows_there FROM (VALUES ('csv'), ('quarantined'), ('report')) t(reader)
"""
