"""Command line: run models, previews, not-null tests, reports, export and the file stream.

    spark-submit -m daybook run --source /data/partitioned --warehouse /data/warehouse --version 3
    python -m daybook run ... --from-date 2025-11-26 --seed exact
    python -m daybook run ... --full-refresh
    python -m daybook test --warehouse /data/warehouse
    python -m daybook report latest --warehouse /data/warehouse --model agg_daily_revenue_v3

Without ``--from-date`` an incremental run uses the project default: today minus 14 days.
On a cluster the session comes from ``spark-submit``; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from daybook.functions.dates import DEFAULT_WINDOW_DAYS, default_from_date
from daybook.operators import export, quality, reports
from daybook.plans.runs import MODELS, Project, not_null_checks
from daybook.session import build_session
from daybook.sources.transactions import partitioned_source_schema, read_transactions
from daybook.sources.warehouse import Warehouse


def _session(args):
    return build_session(args.master, args.shuffle_partitions)


def _project(spark, args) -> Project:
    return Project(spark, lambda fd: read_transactions(spark, args.source, fd, day_aligned=args.day_aligned),
                   args.warehouse, key_index=args.key_index, day_aligned=args.day_aligned)


def _source_options(parser) -> None:
    parser.add_argument("--day-aligned", action="store_true",
                        help="declare that every source row lies in the folder of its day: prune folders")
    parser.add_argument("--key-index", action="store_true", help="give the staging table a key index")


def _from_date(args):
    return args.from_date or default_from_date(window_days=args.window_days)


def cmd_run(args) -> int:
    spark = _session(args)
    project = _project(spark, args)
    fd = _from_date(args)
    names = [args.model] if args.model else None
    if names:
        reps = [project.run_model(n, fd, args.full_refresh, args.seed, preview=args.preview) for n in names]
    else:
        reps = []
        metric = f"agg_daily_revenue_{'py_' if args.engine == 'arrow' else ''}v{args.version}"
        for n in (MODELS[metric].staging, metric):
            reps.append(project.run_model(n, fd, args.full_refresh, args.seed, preview=args.preview))
    for r in reps:
        if r.preview is not None:
            print(json.dumps({"preview": [row.asDict() for row in r.preview.collect()]}, default=str))
        print(json.dumps({"model": r.model, "mode": r.mode, "from_date": str(r.from_date),
                          "partitions_written": r.partitions_written,
                          "partitions_dropped": r.partitions_dropped, "misplaced_rows": r.misplaced_rows,
                          "seconds": r.seconds}))
    return 0


def cmd_test(args) -> int:
    spark = _session(args)
    project = Project(spark, lambda fd: None, args.warehouse)
    failed = 0
    for row in not_null_checks(project).collect():
        print(json.dumps(row.asDict()))
        failed += 0 if row["passed"] else 1
    return 1 if failed else 0


def cmd_report(args) -> int:
    spark = _session(args)
    wh = Warehouse(spark, args.warehouse)
    metric = wh.read(args.model)
    fn = {
        "overview": reports.metric_overview,
        "statistics": reports.metric_statistics,
        "describe": reports.metric_describe,
        "latest": lambda m: reports.latest_days(m, args.n or 30),
        "head": lambda m: reports.first_days(m, args.n or 10),
        "series": reports.trend_series,
    }[args.kind]
    for row in fn(metric).collect():
        print(json.dumps(row.asDict(), default=str))
    return 0


def cmd_export(args) -> int:
    spark = _session(args)
    src = spark.read.parquet(args.input)
    export.partitioned_export(src, args.output)
    for row in quality.rejected_rows(src).collect():
        print(json.dumps(row.asDict()))
    return 0


def cmd_stream(args) -> int:
    from daybook.streaming.incremental import start_incremental_stream
    from pyspark.sql import types as T

    spark = _session(args)
    project = _project(spark, args)
    key_type = T.LongType() if args.bigint_keys else T.StringType()
    q = start_incremental_stream(project, args.source, partitioned_source_schema(key_type),
                                 checkpoint_location=args.checkpoint, available_now=not args.continuous,
                                 processing_time=args.every, seed=args.seed)
    q.awaitTermination()
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="daybook")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    run = sub.add_parser("run", help="run staging + metric model of a version, or one model")
    run.add_argument("--source", required=True)
    run.add_argument("--warehouse", required=True)
    run.add_argument("--version", type=int, default=3, choices=(1, 2, 3))
    run.add_argument("--engine", default="sql", choices=("sql", "arrow"))
    run.add_argument("--model", choices=sorted(MODELS))
    run.add_argument("--from-date")
    run.add_argument("--window-days", type=int, default=DEFAULT_WINDOW_DAYS)
    run.add_argument("--full-refresh", action="store_true")
    run.add_argument("--seed", default="latest", choices=("latest", "exact"))
    run.add_argument("--preview", action="store_true")
    _source_options(run)
    run.set_defaults(fn=cmd_run)

    test = sub.add_parser("test", help="declared not-null checks over the stored models")
    test.add_argument("--warehouse", required=True)
    test.set_defaults(fn=cmd_test)

    rep = sub.add_parser("report", help="summary of a stored metric table")
    rep.add_argument("kind", choices=("overview", "statistics", "describe", "latest", "head", "series"))
    rep.add_argument("--warehouse", required=True)
    rep.add_argument("--model", default="agg_daily_revenue_v3")
    rep.add_argument("-n", type=int)
    rep.set_defaults(fn=cmd_report)

    exp = sub.add_parser("export", help="partitioned year/month/date export of transaction rows")
    exp.add_argument("--input", required=True)
    exp.add_argument("--output", required=True)
    exp.set_defaults(fn=cmd_export)

    st = sub.add_parser("stream", help="file-triggered incremental runs")
    st.add_argument("--source", required=True)
    st.add_argument("--warehouse", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--continuous", action="store_true")
    st.add_argument("--every", default="1 minute")
    st.add_argument("--seed", default="latest", choices=("latest", "exact"))
    st.add_argument("--bigint-keys", action="store_true")
    _source_options(st)
    st.set_defaults(fn=cmd_stream)

    args = ap.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
