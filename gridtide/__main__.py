"""Job entry for ``spark-submit``: run one cycle, or show the status of a store.

    spark-submit --py-files gridtide.zip -m gridtide run --base BASE --exports PATH [--since T]
    ... run --base BASE --lines PATH [--report PATH] [--json] [--strict]
    ... status --base BASE

``run`` ends with 2 on status ``fail`` and, under ``--strict``, with 1 on ``warn``.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from gridtide.operators.incremental import Params, as_utc
from gridtide.plans import cycle
from gridtide.plans.reads import Reads
from gridtide.plans.store import Store
from gridtide.sources import scratch


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gridtide")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    landed = run.add_mutually_exclusive_group(required=True)
    landed.add_argument("--exports", help="landed JSON-array files")
    landed.add_argument("--lines", help="landed JSON lines")
    run.add_argument("--since", type=as_utc, help="window start, ISO 8601, UTC unless given")
    run.add_argument("--report", help="also write the Markdown report here")
    run.add_argument("--json", action="store_true", help="print the outcome as JSON")
    run.add_argument("--strict", action="store_true", help="end with 1 on warnings")
    status = commands.add_parser("status")
    for command in (run, status):
        command.add_argument("--base", required=True, help="base folder of the store")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, now: datetime | None = None) -> int:
    """``now`` is the clock of the job, the real one unless given."""
    now = now or datetime.now(timezone.utc)
    options = _arguments(argv)
    spark = SparkSession.builder.appName("gridtide").getOrCreate()
    if options.command == "status":
        return _status(spark, options.base, now)
    if options.exports:
        source = cycle.export_source(spark, options.exports)
    else:
        source = cycle.lines_source(spark, options.lines)
    outcome = cycle.run_cycle(
        spark, options.base, source, now=now, since=options.since, params=Params.load(),
        report_path=options.report,
    )
    if options.json:
        print(outcome.to_frame(spark).selectExpr("to_json(struct(*)) AS j").first()["j"])
    else:
        print(outcome.to_markdown())
    if outcome.status == "fail":
        return 2
    return 1 if options.strict and outcome.status == "warn" else 0


def _status(spark: SparkSession, base: str, now: datetime) -> int:
    if not scratch.exists(spark, f"{base}/ledger"):
        print(f"no store at {base}: run a cycle first", file=sys.stderr)
        return 1
    summary, lines = Reads(Store(spark, base)).status(now)
    summary.show(truncate=False)
    lines.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
