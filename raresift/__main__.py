"""Command line: ``python -m raresift {train,publish,score-stream} ...``.

A thin shell over the job functions; every flag maps to one keyword
argument.  The session comes from the launcher (``spark-submit``) or, with
``--master``, is created here.
"""

from __future__ import annotations

import argparse
import json

from raresift.functions.expressions import DECISION_THRESHOLD, MAX_ITER
from raresift.streaming.report import REPORT_CAP


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="raresift", description="Rare-event classification on Spark.")
    p.add_argument("--master", default=None, help="Spark master, e.g. local[*]; default: from the launcher")
    sub = p.add_subparsers(dest="command", required=True)

    t = sub.add_parser("train", help="clean, profile, fit, evaluate and save a classifier")
    t.add_argument("--data-path", required=True, help="headed CSV (schema inferred) or a parquet folder")
    t.add_argument("--format", choices=["csv", "parquet"], default=None, help="default: by the path's ending")
    t.add_argument("--output-dir", required=True, help="folder for summary and sample predictions")
    t.add_argument("--max-iter", type=int, default=MAX_ITER)
    t.add_argument("--sample-fraction", type=float, default=1.0)
    t.add_argument("--decision-threshold", type=float, default=DECISION_THRESHOLD)
    t.add_argument("--model-output-dir", default=None)
    t.add_argument("--key", action="append", default=[], help="row-identity column (not a feature); repeatable")
    t.add_argument("--target", default="Class")
    t.add_argument("--schema", default=None, help="DDL of the CSV columns; skips the inference pass")
    t.add_argument("--sampling-ratio", type=float, default=None, help="fraction of rows read to infer types")

    pub = sub.add_parser("publish", help="encode a headed CSV as JSON messages plus a sentinel")
    pub.add_argument("--csv-path", required=True)
    pub.add_argument("--output-dir", required=True, help="message folder read by score-stream")

    s = sub.add_parser("score-stream", help="score a message folder with a saved model")
    s.add_argument("--model-dir", required=True)
    s.add_argument("--source", default=None, help="message folder (JSON lines); none for a bus")
    s.add_argument("--format", default="text", help="source format: text, or that of a message bus")
    s.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="source option; repeatable")
    s.add_argument("--work-dir", required=True, help="sink and checkpoint folder")
    s.add_argument("--report-path", default=None)
    s.add_argument("--max-runtime-seconds", type=float, default=None, help="stop there; the report says finished=false")
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--max-offsets-per-trigger", type=int, default=None)
    s.add_argument("--report-cap", type=int, default=REPORT_CAP, help="flagged rows listed in the document")
    s.add_argument("--dedupe-delay", default=None, help="e.g. '10 minutes' to drop redeliveries by __id")
    s.add_argument("--live", action="store_true", help="1-second micro-batches until the sentinel and drain")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from raresift.session import build_session

    spark = build_session(args.master)
    try:
        if args.command == "train":
            from raresift.plans.training import run_training
            from raresift.sources.tables import read_csv_table, read_parquet_table

            path = args.data_path
            kind = args.format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
            if kind == "parquet":
                raw = read_parquet_table(spark, path)
            else:
                raw = read_csv_table(spark, path, schema=args.schema, sampling_ratio=args.sampling_ratio)
            result = run_training(
                spark,
                raw,
                dataset_path=path,
                output_dir=args.output_dir,
                model_output_dir=args.model_output_dir,
                key=args.key,
                max_iter=args.max_iter,
                sample_fraction=args.sample_fraction,
                decision_threshold=args.decision_threshold,
                target=args.target,
            )
            print(json.dumps(result.summary.first().asDict(recursive=True), default=str))
        elif args.command == "publish":
            from raresift.operators.events import encode_messages, sentinel_message, with_input_position
            from raresift.plans.streaming_job import publish
            from raresift.sources.tables import read_csv_strings

            rows = with_input_position(read_csv_strings(spark, args.csv_path))
            data = encode_messages(rows)
            publish([data, sentinel_message(data)], args.output_dir)
        elif args.command == "score-stream":
            from pyspark.ml.feature import VectorAssembler

            from raresift.operators.model import load_model
            from raresift.plans.streaming_job import run_stream_scoring

            model = load_model(args.model_dir)
            assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
            out = run_stream_scoring(
                spark,
                args.source,
                args.work_dir,
                assembler.getInputCols(),
                model,
                max_files_per_trigger=args.max_files_per_trigger,
                max_runtime_seconds=args.max_runtime_seconds,
                report_path=args.report_path,
                dedupe_delay=args.dedupe_delay,
                live=args.live,
                report_cap=args.report_cap,
                fmt=args.format,
                options=dict(o.split("=", 1) for o in args.option),
                max_offsets_per_trigger=args.max_offsets_per_trigger,
            )
            print(json.dumps(out.report.drop("frauds").first().asDict(recursive=True), default=str))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
