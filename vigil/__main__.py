"""Command line: one sub-command per job of the visit lake.

    python -m vigil cleanse-csv     # raw *.csv (flat)       -> cleansed CSV
    python -m vigil cleanse-jsonl   # raw *.jsonl (recursive) and stream-raw's lines -> cleansed CSV
    python -m vigil curate          # cleansed CSV -> curated Parquet by visit_date
    python -m vigil register        # external table over the curated zone
    python -m vigil report          # outbreak report -> dated CSV folder
    python -m vigil stream-raw      # topic -> raw zone (one line per message)
    python -m vigil stream-curate   # topic (or --from-raw: the raw zone) -> curated Parquet
    python -m vigil stream-staged   # topic -> raw, cleansed and curated zones, a micro-batch at a time
    python -m vigil take-csv        # raw *.csv that no earlier run took   -> cleansed and curated
    python -m vigil take-jsonl      # raw *.jsonl that no earlier run took -> cleansed and curated
    python -m vigil catalog         # catalogs, databases and the lake's tables

Zones, topic and flush settings come from the environment (see
``LakeConfig.from_env``). The session is the one the cluster provides.
A running stream flushes what is waiting before it ends on SIGTERM or SIGINT;
the counts of every flush are kept in the lake's ``metrics`` folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import json
import signal
import sys
import threading
from dataclasses import asdict, replace

from pyspark.sql import SparkSession

from vigil.config import LakeConfig
from vigil.plans.batch import cleanse_csv_zone, cleanse_jsonl_zone, curate_zone, daily_report
from vigil.plans.incremental_report import refresh_report
from vigil.session import RUNTIME_CONF, work_root
from vigil.sinks.files import write_report_csv
from vigil.sources.catalog import create_schema, list_catalogs, list_databases, list_tables, register_table
from vigil.sources.files import STREAM
from vigil.sources.topic import read_raw_stream, read_topic
from vigil.streaming.incremental import incremental_csv, incremental_jsonl
from vigil.streaming.ingest import Trigger, run_to_end, run_until_stopped, stream_curate, stream_raw
from vigil.streaming.metrics import FlushMetrics
from vigil.streaming.staged import Zones, stream_staged


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("vigil").getOrCreate()
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def _mark(*ends: str) -> str:
    """Name of a checkpoint: one for each pair of a source and a sink."""
    return hashlib.sha256("\n".join(ends).encode()).hexdigest()[:16]


def _stream(spark: SparkSession, cfg: LakeConfig, command: str, from_raw: bool, drain_only: bool):
    raw_stream = f"{cfg.raw_path.rstrip('/')}/{STREAM}"
    ends = (f"files {raw_stream}" if from_raw else f"topic {cfg.bootstrap} {cfg.topic}",
            raw_stream if command == "stream-raw" else cfg.curated_path)
    ckpt = f"{work_root(spark)}/vigil-streams/{command}-{_mark(*ends)}"
    zones = Zones(cfg.raw_path, cfg.cleansed_path, cfg.curated_path, cfg.zone_path("metrics"))

    def start(drain: bool):
        if from_raw:
            # Files have no offset bounds: flush by time through the trigger.
            source = read_raw_stream(spark, cfg.raw_path, ckpt, cfg.max_files_per_trigger)
            trigger = Trigger(available_now=True) if drain else Trigger.from_config(cfg)
        else:
            # The topic options carry the size / time flush rule; drain = final flush.
            source = read_topic(spark, cfg, drain=drain)
            trigger = Trigger(available_now=True) if drain else Trigger()
        name = f"vigil-{command}"
        if command == "stream-raw":
            return stream_raw(source, raw_stream, ckpt, trigger, name=name)
        if command == "stream-staged":
            return stream_staged(source, zones, ckpt, trigger, name=name, codes=cfg.valid_codes)
        return stream_curate(source, cfg.curated_path, ckpt, trigger, name=name, codes=cfg.valid_codes)

    metrics = FlushMetrics(spark, f"{zones.flushes.rstrip('/')}/runs")
    spark.streams.addListener(metrics)
    try:
        if drain_only:
            query = run_to_end(start(True))
        else:
            stop = threading.Event()
            before = {s: signal.signal(s, lambda *_: stop.set()) for s in (signal.SIGTERM, signal.SIGINT)}
            try:
                query = run_until_stopped(start, stop)
            finally:
                for s, handler in before.items():
                    signal.signal(s, handler)
        metrics.finished(query.runId)
    finally:
        spark.streams.removeListener(metrics)
    return query.lastProgress


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="vigil")
    p.add_argument("command", choices=["cleanse-csv", "cleanse-jsonl", "curate", "register", "report",
                                       "stream-raw", "stream-curate", "stream-staged", "take-csv", "take-jsonl",
                                       "catalog"])
    p.add_argument("--incremental", action="store_true", help="report: count only what new loads touch")
    p.add_argument("--report-dir", default=None, help="report base folder (default <lake>/reports)")
    p.add_argument("--report-date", default=None, help="YYYY-MM-DD (default: today, UTC)")
    p.add_argument("--drain", action="store_true", help="streams: process what is there and stop")
    p.add_argument("--quality-dir", default=None, help="cleanse jobs: also write per-file counts here")
    p.add_argument("--from-raw", action="store_true",
                   help="stream-curate: follow the raw zone written by stream-raw instead of the topic")
    args = p.parse_args(argv)

    spark = _session()
    cfg = LakeConfig.from_env()
    if not cfg.lake_root:
        # The shared folder named by spark.checkpoint.dir (on a cluster work_root refuses a local one).
        cfg = replace(cfg, lake_root=f"{work_root(spark)}/vigil-lake")
    out: object
    if args.command == "cleanse-csv":
        out = asdict(cleanse_csv_zone(spark, cfg.raw_path, cfg.cleansed_path, codes=cfg.valid_codes,
                                       quality_path=args.quality_dir))
    elif args.command == "cleanse-jsonl":
        out = asdict(cleanse_jsonl_zone(spark, cfg.raw_path, cfg.cleansed_path, codes=cfg.valid_codes,
                                         quality_path=args.quality_dir))
    elif args.command == "curate":
        out = curate_zone(spark, cfg.cleansed_path, cfg.curated_path)
    elif args.command == "register":
        out = register_table(spark, cfg.curated_path, cfg.database, cfg.table)
    elif args.command == "report":
        day = dt.date.fromisoformat(args.report_date) if args.report_date else None
        base = args.report_dir or cfg.zone_path("reports")
        if args.incremental:
            report = refresh_report(spark, cfg.curated_path, cfg.zone_path("report-state"), cfg.window_rows,
                                    cfg.growth_factor)
            out = write_report_csv(report, base, day)
        else:
            out = daily_report(spark, cfg, base, day)
    elif args.command == "catalog":
        create_schema(spark, cfg.database)
        out = {
            "catalogs": list_catalogs(spark),
            "databases": list_databases(spark),
            "tables": list_tables(spark, cfg.database),
        }
    elif args.command in ("take-csv", "take-jsonl"):
        take = incremental_csv if args.command == "take-csv" else incremental_jsonl
        query = run_to_end(take(spark, cfg.raw_path, cfg.cleansed_path, cfg.curated_path,
                                f"{work_root(spark)}/vigil-streams/{args.command}-{_mark(cfg.raw_path, cfg.curated_path)}",
                                codes=cfg.valid_codes))
        out = query.lastProgress
    else:
        out = _stream(spark, cfg, args.command, args.command == "stream-curate" and args.from_raw, args.drain)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
