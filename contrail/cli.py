"""Command-line runners for the stages (``python -m contrail.cli <command>``).

    land         API response files (one JSON envelope each) -> Bronze run(s)
    silver       every pending (or one given) committed Bronze run -> Silver table version
    gold         current Silver -> Gold table version
    incremental  stream new Bronze files into Silver (availableNow or continuous)
    sql          guarded read-only SQL over the current Gold table

Cluster settings come from ``spark-submit`` / the session; ``--local N`` starts a
local session instead (tests, laptops).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(args) -> SparkSession:
    if args.local:
        from contrail.session import local_session

        return local_session(args.local)
    return SparkSession.builder.appName(f"contrail-{args.command}").getOrCreate()


def _store(spark, root):
    from contrail.sinks import TableStore

    return TableStore(spark, root)


def cmd_land(spark, args) -> dict:
    from contrail.plans.jobs import run_bronze
    from contrail.sources.bronze import run_stamp_of_file

    responses = spark.read.text(args.responses, wholetext=True).select(
        F.col("value").alias("body"),
        (
            F.lit(args.run_ts)
            if args.run_ts
            else run_stamp_of_file()
        ).alias("run_ts"),
    )
    runs = [args.run_ts] if args.run_ts else None
    out = run_bronze(spark, responses, args.bronze, _store(spark, args.store), min_rows=args.min_rows, runs=runs)
    return {"runs": [{"run_ts": r.path.rsplit("=", 1)[-1], "records": r.record_count} for r in out]}


def cmd_silver(spark, args) -> dict:
    from contrail.plans.jobs import run_silver, run_silver_pending

    store = _store(spark, args.store)
    kw = dict(
        as_of=args.as_of,
        min_rows=args.min_rows,
        quarantine_dir=args.quarantine,
        newer_only=args.newer_only,
        drop_blank_country=args.drop_blank_country,
    )
    done = [run_silver(spark, store, run=args.run, **kw)] if args.run else run_silver_pending(spark, store, **kw)
    rejected = [{"path": r.path, "records": r.record_count} for r in done if r.stage == "rejected"]
    done = [r for r in done if r.stage == "silver"]
    if not done:
        return {"runs": 0, "rejected": rejected}
    r = done[-1]
    return {"runs": len(done), "rejected": rejected, "version": r.version, "path": r.path, "silver_record_count": r.record_count, **r.counts}


def cmd_gold(spark, args) -> dict:
    from contrail.plans.jobs import run_gold

    r = run_gold(
        spark,
        _store(spark, args.store),
        partition_by="origin_country" if args.partition_by_country else None,
        restatus_as_of=args.restatus_as_of,
        by_location=args.by_location,
    )
    return {"version": r.version, "path": r.path, "gold_record_count": r.record_count}


def cmd_incremental(spark, args) -> dict:
    from contrail.streaming import run_incremental
    from contrail.streaming.gated import publish_held

    store = _store(spark, args.store)
    q = run_incremental(
        spark,
        args.bronze,
        store,
        args.checkpoint,
        fmt=args.format,
        max_files_per_trigger=args.max_files,
        available_now=args.processing_time is None,
        processing_time=args.processing_time,
        quarantine_dir=args.quarantine,
        archive_dir=args.archive,
        min_rows=args.min_rows,
        gated=args.gated,
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = {"batches": len(q.recentProgress)}
    if args.gated:  # runs whose Bronze commit came after their last file
        kw = {} if args.min_rows is None else {"min_rows": args.min_rows}
        out["published_after"] = publish_held(store, quarantine_dir=args.quarantine, **kw)
    return out


def cmd_sql(spark, args) -> dict:
    from contrail.plans import gold_sql, register_gold
    from contrail.plans.jobs import read_gold

    g = read_gold(_store(spark, args.store))
    if g is None:
        raise FileNotFoundError("no committed gold table")
    register_gold(g)
    df = gold_sql(spark, args.query)
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
        return {"written": args.output}
    if args.limit is not None:
        df = df.limit(args.limit)
    print("\t".join(df.columns))
    for row in df.toLocalIterator():  # every row, one partition at a time
        print("\t".join("" if v is None else str(v) for v in row))
    return {}


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="contrail")
    p.add_argument("--local", type=int, default=0, help="run on local[N] instead of the configured cluster")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("land", help="land API response files as Bronze runs (gated, committed)")
    s.add_argument("--responses", required=True, help="folder of API response JSON files")
    s.add_argument("--bronze", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--run-ts", help="run stamp yyyyMMdd_HHmmss (default: from each file name)")
    s.add_argument("--min-rows", type=int, default=1000)

    s = sub.add_parser("silver", help="process pending committed Bronze runs into the Silver table")
    s.add_argument("--store", required=True)
    s.add_argument("--run")
    s.add_argument("--as-of", type=int)
    s.add_argument("--min-rows", type=int, default=5000)
    s.add_argument("--quarantine")
    s.add_argument("--newer-only", action="store_true")
    s.add_argument("--drop-blank-country", action="store_true")

    s = sub.add_parser("gold", help="rewrite Gold from the current Silver table")
    s.add_argument("--store", required=True)
    s.add_argument("--partition-by-country", action="store_true")
    s.add_argument("--restatus-as-of", type=int)
    s.add_argument("--by-location", action="store_true", help="sort the table for questions about an area")

    s = sub.add_parser("incremental", help="stream new Bronze files into Silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--format", choices=("line", "array"), default="line")
    s.add_argument("--max-files", type=int)
    s.add_argument("--processing-time", help="e.g. '10 minutes' for a continuous run")
    s.add_argument("--quarantine")
    s.add_argument("--archive")
    s.add_argument("--min-rows", type=int, help="refuse runs below this (default: no gate, or 5000 with --gated)")
    s.add_argument("--gated", action="store_true", help="publish whole runs only, as counted by the manifest")

    s = sub.add_parser("sql", help="guarded read-only SQL over flights_gold")
    s.add_argument("--store", required=True)
    s.add_argument("query")
    s.add_argument("--output", help="write the whole result as Parquet here")
    s.add_argument("--limit", type=int, help="print at most this many rows (default: all)")
    return p


COMMANDS = {
    "land": cmd_land,
    "silver": cmd_silver,
    "gold": cmd_gold,
    "incremental": cmd_incremental,
    "sql": cmd_sql,
}


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = _session(args)
    out = COMMANDS[args.command](spark, args)
    if out:
        print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
