"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tools/explain_plans.py [sf_dir] [out.md]

For each query: shuffles (Exchange), broadcasts, pushed scan filters, scan
read schemas, Python stages, and any cross or nested-loop join (there should
be none) of the returned frame's plan; and what the whole call ran, streams,
fits and scalar subqueries included: jobs, stages and records read, from
Spark's event log in a scratch folder.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"\bExchange\b", tree)) - len(re.findall(r"BroadcastExchange", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", text)),
        "subqueries": len(re.findall(r"^Subquery:\d+", text, re.M)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[(.+?)\]\n", text))),
        "schemas": sorted(set(re.findall(r"ReadSchema: (struct<.*?>)\n", text))),
        "python": bool(re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)),
        "cross": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)),
    }


def whole_calls(log_dir: str, spans: dict[str, tuple[float, float]]) -> dict[str, list[int]]:
    """Of each query's time span: jobs, stages that ran, and input records read."""
    found = {name: [0, 0, 0] for name in spans}

    def of(ms: int) -> list[int] | None:
        return next((found[n] for n, (a, b) in spans.items() if a <= ms / 1000 <= b), None)

    for name in os.listdir(log_dir):
        with open(os.path.join(log_dir, name), errors="replace") as log:
            for line in log:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart" and (row := of(e["Submission Time"])):
                    row[0] += 1
                elif e["Event"] == "SparkListenerStageCompleted" and (row := of(e["Stage Info"].get("Submission Time", 0))):
                    row[1] += 1
                elif e["Event"] == "SparkListenerTaskEnd" and (row := of(e["Task Info"]["Launch Time"])):
                    row[2] += (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
    return found


# What each query does at scale: the data-sized shuffles and what stays bounded.
NOTES = {
    "clean_transactions": "one shuffle of distinct rows (partial aggregate first: copies collapse per task)",
    "clean_counts": "one input pass: copy tally of complete rows (partial agg + shuffle), then all counts in one aggregate",
    "class_profile": "dedup shuffle; the profile aggregate shuffles at most (#tasks x #labels) partial rows",
    "class_weights": "as class_profile; the weight follows from the row per class",
    "sample_fraction": "narrow: md5 filter, no shuffle",
    "train_test_counts": "dedup shuffle; split is a narrow md5 expression",
    "score_closed_form": "dedup shuffle; scoring is one codegen expression",
    "confusion_matrix": "dedup shuffle; <=4 groups after partial aggregation",
    "sample_predictions": "dedup shuffle; top-50 per task (TakeOrderedAndProject)",
    "flagged_alerts": "dedup shuffle; narrow filter + format_string",
    "auc_roc": "scores grouped (partial agg), B quantile buckets, B-row offsets broadcast, window per bucket",
    "auc_pr": "same plan as auc_roc",
    "scaler_std": "one MLlib summary pass (tree aggregate) over the train rows",
    "fit_quality": "cleaned rows and narrow predictions written once; the optimiser caches its blocks; exact areas as auc_roc",
    "model_roundtrip": "cleaned rows written once; both models score in one narrow pass",
    "training_summary": "one input pass into the tally; narrow predictions and the summary written once",
    "event_time_positions": "B quantile buckets + B-row offsets broadcast; no single-task sort",
    "encode_events": "narrow: to_json / from_json",
    "decode_events": "narrow; the sentinel count is a one-row aggregate",
    "stream_scored": "stream: narrow per micro-batch; parquet sink with commit log",
    "stream_report": "one aggregate over the sink, distinct counts by group-by, top-100 scalar subquery",
    "report_fields": "reads the one-row report document",
    "report_frauds": "posexplode of the report's bounded list",
    "unique_by_time": "min_by aggregate (partial) over all flagged rows of the sink",
    "stream_alerts": "stream as stream_scored; narrow filter",
    "stream_dedup": "stream: state keyed by __id, evicted by the watermark",
    "csv_class_profile": "CSV scan (+ inference pass) then as class_profile",
    "published_positions": "per-split counts; offsets joined on a compact key (AQE broadcast or balanced shuffle)",
    "stream_model_scored": "fit on the event table, the stream as stream_scored, one join by id with the batch scores",
    "card_messages_scored": "narrow: to_json / from_json of 30 features, one codegen score expression",
    "stream_restart": "stream as stream_scored; source and sink counted by delivery (partial agg), counts joined",
    "stream_running_counts": "state per kind and distinct value, partial agg before the state shuffle; one-row report a batch",
    "stream_live": "stream as stream_scored; the driver waits for events",
    "stream_admission": "log segments read by offset ranges; batches admitted by rows or time",
    "stream_first_per_time": "rows cut to one per key in each Arrow batch, then keyed state",
    "newton_weights": "narrow rows written once, one aggregate of decimal sums an iteration",
    "binned_areas": "counts per bin (partial agg), then as auc_roc over the bins",
    "csv_quarantine": "one CSV scan; only malformed rows are parsed again",
    "sink_compacted": "rebalance by kind and day, split by AQE; readers prune folders",
    "training_document": "as training_summary; two small files read back",
    "missing_input": "one count",
}


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    out = args[1] if len(args) > 1 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")

    import raresift.plans.checks  # noqa: F401  (registers its queries)
    import raresift.plans.live  # noqa: F401
    from raresift.plans.queries import QUERIES
    from raresift.session import build_session

    log_dir = tempfile.mkdtemp(prefix="raresift-plans-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra_conf={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        },
    )
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/explain_plans.py` on `{sf_dir}` (`explain(\"formatted\")`, before AQE re-planning).",
        "Shuffles = `Exchange` nodes in the main plan; subqueries are scalar subqueries (one-row values).",
        "",
        "Jobs, stages and records read are those of the whole call, the result's own rows written to a sink that drops them.",
        "",
        "| query | jobs | stages | records read | shuffles | broadcasts | subqueries | python | cross join | at scale | pushed filters | scan read schema |",
        "|---|---|---|---|---|---|---|---|---|---|---|---|",
    ]
    plans, spans = {}, {}
    for name, fn in QUERIES.items():
        started = time.time()
        df = fn(spark, sf_dir)
        plans[name] = summarise(plan_text(df))
        df.write.format("noop").mode("overwrite").save()
        time.sleep(0.2)
        spans[name] = (started, time.time())
    spark.stop()
    ran = whole_calls(log_dir, spans)
    for name, s in plans.items():
        jobs, stages, records = ran[name]
        lines.append(
            f"| {name} | {jobs} | {stages} | {records} | {s['shuffles']} | {s['broadcasts']} | {s['subqueries']} | "
            f"{'yes' if s['python'] else 'no'} | {'YES' if s['cross'] else 'no'} | {NOTES.get(name, '')} | "
            f"{'<br>'.join(s['pushed']) or '-'} | {'<br>'.join(x.replace('|', '/') for x in s['schemas']) or '-'} |"
        )
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
