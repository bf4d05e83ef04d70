"""Jobs for spark-submit: ``extract``, ``load``, ``transform``, or ``all`` three in one session."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from wageledger.plans.ingest import extract, ingest
from wageledger.plans.warehouse import LAYERS, Tables, transform
from wageledger.schemas import schema_from_json
from wageledger.session import tune
from wageledger.sinks.scratch import cleaned
from wageledger.sinks.tables import create_databases


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wageledger", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("extract", "load", "transform", "all"):
        job = jobs.add_parser(name)
        job.add_argument("--shuffle-bytes", type=int, help="expected size of the largest shuffle")
        if name != "transform":
            job.add_argument("--multiline", action="store_true", help="accept line breaks inside quoted fields")
        if name in ("extract", "all"):
            job.add_argument("--snapshot", required=True, help="path of the published CSV")
            job.add_argument("--salt-file", required=True, help="file holding the hashing salt")
        if name != "transform":
            job.add_argument("--landing", required=True, help="landing folder")
        if name in ("load", "all"):
            job.add_argument("--schema", help="JSON schema of the landed files")
        if name in ("transform", "all"):
            job.add_argument("--incremental", action="store_true", help="merge new people instead of a full refresh")
            job.add_argument("--latest-snapshot", action="store_true", help="use the last landed file only")
            job.add_argument("--lenient", action="store_true", help="report failed checks instead of stopping")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tune(spark or SparkSession.builder.appName("wageledger").getOrCreate(), args.shuffle_bytes)
    log = logging.getLogger("wageledger")
    run_ts = datetime.now(UTC)
    create_databases(spark, LAYERS)
    with cleaned(spark):
        if args.job in ("extract", "all"):
            salt = Path(args.salt_file).read_text(encoding="utf-8").strip()
            if not salt:
                raise ValueError("the salt is empty")
            log.info("landed %s", extract(spark, args.snapshot, args.landing, salt, run_ts, args.multiline))
        if args.job in ("load", "all"):
            schema = schema_from_json(args.schema) if args.schema else None
            log.info("raw rows: %s", ingest(spark, args.landing, Tables().raw, run_ts, schema, multiline=args.multiline))
        if args.job in ("transform", "all"):
            failures = transform(spark, run_ts, full_refresh=not args.incremental, strict=not args.lenient, latest_only=args.latest_snapshot)
            for failure in failures:
                log.warning("check failed: %s", failure)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
