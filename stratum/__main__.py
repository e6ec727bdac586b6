"""Run one lake step as a job.

    python -m stratum --lake PATH bronze --dataset orders
    python -m stratum --lake PATH silver --dataset orders
    python -m stratum --lake PATH rebuild --dataset orders
    python -m stratum --lake PATH gold --table fact_sales --calendar-start 2016-01-01
    python -m stratum --lake PATH --conf specs --databases "" refresh --parallel 4

The session comes from the environment (``spark-submit`` settings); the lake
path must be on a file system every executor can reach. A step takes only the
options that it honours. Progress goes to standard error as one JSON object a line.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import SparkSession

from stratum.plans import refresh
from stratum.session import Lake
from stratum.specs import datasets
from stratum.streaming import bronze, silver


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratum")
    p.add_argument("--lake", required=True, help="lake root on shared storage")
    p.add_argument("--databases", help="also keep views <prefix><schema>.<table> of all tables; may be empty")
    p.add_argument("--conf", help="folder of dataset specs (default: the packaged ones)")
    steps = p.add_subparsers(dest="step", required=True)
    trigger, calendar, many = (argparse.ArgumentParser(add_help=False) for _ in range(3))
    trigger.add_argument("--max-files-per-trigger", type=int)
    calendar.add_argument("--calendar-start", help="first calendar day")
    calendar.add_argument("--calendar-end", help="last calendar day (default: today and 90 days)")
    calendar.add_argument("--clustered", action="store_true", help="read what facts join by order id from bucketed copies")
    many.add_argument("--parallel", type=int, default=1, help="independent datasets or tables at once")
    for name, parents in (("bronze", [trigger, many]), ("silver", [trigger, many]), ("rebuild", [many]),
                          ("compact", [many]), ("gold", [calendar, many]), ("refresh", [trigger, calendar, many])):
        step = steps.add_parser(name, parents=parents)
        if name == "gold":
            step.add_argument("--table", action="append", help="a Gold table; all when omitted")
        elif name != "refresh":
            step.add_argument("--dataset", action="append", help="a dataset; all when omitted")
    return p


def steps_of(a: argparse.Namespace, spark: SparkSession, lake: Lake, run_id: str) -> list[Callable[[], object]]:
    if a.step == "gold":
        return [partial(refresh.build_gold, spark, lake, a.calendar_start, a.calendar_end, a.parallel, a.table, a.conf,
                        a.clustered)]
    if a.step == "refresh":
        return [partial(refresh.full_refresh, spark, lake, run_id, None, a.calendar_start, a.calendar_end,
                        a.parallel, a.max_files_per_trigger, a.conf, a.clustered)]
    names = a.dataset or datasets("bronze" if a.step == "bronze" else "silver", a.conf)
    return [{
        "bronze": lambda n=n: bronze.ingest(spark, n, lake, max_files_per_trigger=a.max_files_per_trigger, conf=a.conf),
        "silver": lambda n=n: silver.refine_stream(spark, n, lake, run_id, a.max_files_per_trigger, a.conf),
        "rebuild": lambda n=n: silver.rebuild(spark, n, lake, run_id, a.conf),
        "compact": lambda n=n: silver.compact(spark, n, lake, a.conf),
    }[a.step] for n in names]


def main(argv: list[str] | None = None) -> None:
    a = arguments().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    lake, run_id, began = Lake(a.lake.rstrip("/"), a.databases), str(uuid.uuid4()), time.monotonic()

    def tell(event: str, **more: object) -> None:
        print(json.dumps({"event": event, "step": a.step, "run": run_id,
                          "elapsed_ms": round(1000 * (time.monotonic() - began)), **more}), file=sys.stderr)

    tell("begin", lake=lake.root)
    try:
        refresh.run_all(steps_of(a, spark, lake, run_id), a.parallel)
    except Exception as e:
        tell("error", cause=f"{type(e).__name__}: {e}"[:500])
        raise
    tell("end")


if __name__ == "__main__":
    main()
