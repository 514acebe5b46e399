"""Command line: ingest CSV files, list analyses, run analyses on stored tables.

    python -m tillpoint load CSV_DIR TABLE_DIR
    python -m tillpoint ingest CSV_DIR TABLE_DIR
    python -m tillpoint arrange TABLE_DIR [--buckets N]
    python -m tillpoint list
    python -m tillpoint run KEY [KEY ...] --tables TABLE_DIR --out OUT_DIR [--format parquet|csv]
    python -m tillpoint run all --tables TABLE_DIR --out OUT_DIR [--as-of YYYY-MM-DD]
    python -m tillpoint ingest-stream TABLE LANDING_DIR TABLE_DIR

``load`` checks values, keys and references, stores what is valid and prints the rows by outcome;
``ingest`` appends without checks. ``arrange`` copies the stored facts into buckets by order, which
``run`` reads for the keys that join by order, as long as nothing was stored since. ``run`` reads the tables written by either and writes each key's result
under OUT_DIR/KEY; ``--as-of`` is the analysis date of the recency and churn keys
(default: today). ``ingest-stream`` appends the CSV files newly landed in
LANDING_DIR to one table and stops (Structured Streaming, availableNow). The session comes from the launcher (spark-submit settings win);
run locally it uses local[*].
"""

from __future__ import annotations

import argparse
import os
import sys


def _session():
    from pyspark.sql import SparkSession

    from tillpoint.session import build_session, ensure_checkpoint_dir

    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    return build_session(os.environ.get("TILLPOINT_MASTER"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillpoint")
    sub = parser.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="load <name>.csv files into typed Parquet tables")
    ing.add_argument("csv_dir")
    ing.add_argument("table_dir")
    checked = sub.add_parser("load", help="load <name>.csv files, refusing bad values, repeated keys and orphans")
    checked.add_argument("csv_dir")
    checked.add_argument("table_dir")
    arranged = sub.add_parser("arrange", help="copy stored facts into buckets by order")
    arranged.add_argument("table_dir")
    arranged.add_argument("--buckets", type=int, default=None, help="default: the session's shuffle partitions")
    sub.add_parser("list", help="list analysis keys")
    run = sub.add_parser("run", help="run analyses on stored tables")
    run.add_argument("keys", nargs="+")
    run.add_argument("--tables", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    run.add_argument("--as-of", default=None, help="analysis date for recency/churn keys (default: today)")
    stream = sub.add_parser("ingest-stream", help="append newly landed CSV files of one table")
    stream.add_argument("table")
    stream.add_argument("landing_dir")
    stream.add_argument("table_dir")
    args = parser.parse_args(argv)

    from tillpoint.plans.registry import BY_ORDER, REGISTRY, build_registry
    from tillpoint.sources.by_order import FACTS, arrange, read_by_order
    from tillpoint.sources.files import read_tables

    if args.cmd == "list":
        print("\n".join(REGISTRY))
        return 0
    spark = _session()
    if args.cmd == "load":
        from tillpoint.sources.keyed_load import load_batch, load_report

        load_batch(spark, args.csv_dir, args.table_dir)
        for row in load_report(spark, args.table_dir).orderBy("load_number", "table_name", "outcome").collect():
            print(*row, sep="\t")
        return 0
    if args.cmd == "ingest":
        from tillpoint.plans.prep import ingest

        ingest(spark, args.csv_dir, args.table_dir)
        return 0
    if args.cmd == "ingest-stream":
        from tillpoint.streaming import ingest_stream

        ingest_stream(spark, args.table, args.landing_dir, args.table_dir).awaitTermination()
        return 0
    if args.cmd == "arrange":
        stored = read_tables(spark, args.table_dir)
        arrange(stored, args.table_dir, args.buckets, [n for n in FACTS if n in set(stored)])
        return 0
    registry = build_registry(args.as_of)
    tables, by_order = read_tables(spark, args.tables), read_by_order(spark, args.tables)
    keys = list(registry) if args.keys == ["all"] else args.keys
    unknown = [k for k in keys if k not in registry]
    if unknown:
        parser.error(f"unknown keys: {unknown}")
    for key in keys:
        writer = registry[key](by_order if key in BY_ORDER else tables).write.mode("overwrite")
        path = os.path.join(args.out, key)
        writer.option("header", True).csv(path) if args.format == "csv" else writer.parquet(path)
        print(f"{key} -> {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
