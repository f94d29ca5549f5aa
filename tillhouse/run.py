"""Command line of a run: ``python -m tillhouse.run --root /lake --date 2024-01-15``.

The session comes from ``spark-submit`` or the environment. The exit code is 1 when a stage, the gate or a table test failed.
"""

from __future__ import annotations

import argparse
import logging
import sys
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from tillhouse.plans import checkpoints, medallion

FAILURES = (medallion.StageFailed, medallion.TableTestsFailed, checkpoints.GateFailed)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    day = lambda text: date.fromisoformat(text).isoformat()
    p = argparse.ArgumentParser(prog="tillhouse.run", description="One run over all layers.")
    p.add_argument("--root", required=True, help="folder of the layers")
    p.add_argument("--date", type=day, default=None, help="logical day of the run; yesterday if left out")
    p.add_argument("--run-id", default=None, help="name of the run in the logs; a new one if left out")
    p.add_argument("--first-day", type=day, default=None, help="first day of the calendar; from the data if left out")
    p.add_argument("--last-day", type=day, default=None, help="last day of the calendar; from the data if left out")
    p.add_argument("--stage", choices=("all", "ingest", "silver", "quality", "staging", "retention"), default="all")
    return p.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    spark = spark or SparkSession.builder.appName("tillhouse").getOrCreate()
    day = args.date or medallion.default_run_date()
    run = medallion.start_run(spark, args.root, args.run_id or f"{day}-{uuid.uuid4().hex[:8]}", day)
    stages = {
        "all": lambda: medallion.run_all(run, args.first_day, args.last_day),
        "ingest": lambda: medallion.run_ingest(run),
        "silver": lambda: medallion.run_silver(run),
        "quality": lambda: medallion.run_quality(run),
        "staging": lambda: medallion.run_staging(run),
        "retention": lambda: medallion.run_retention(run),
    }
    try:
        stages[args.stage]()
    except FAILURES as problem:
        logging.getLogger(__name__).error("%s: %s", run.run_id, problem)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
