"""Whole-lake refresh: Bronze for every dataset, then Silver, then Gold.

Each step only needs the tables it reads: dataset X's Silver step needs only
its Bronze step, and every Gold table only the Silver tables it names. With
``parallel > 1`` independent steps are submitted from that many driver threads,
so their Spark jobs share the cluster; Gold starts when every Silver table it
reads is done. A step whose input fills the cluster by itself runs alone.

All layers of a large lake stand on disk at once, and so does what a step shuffles
until it ends. Hence tables are compressed well, shuffle files go with the statement
that wrote them (``THRIFTY_CONF``), and a fact is joined and sorted in two statements.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.upsert import KeyedTable
from stratum.plans import clustering, gold
from stratum.session import Lake
from stratum.sources import storage
from stratum.sources.files import CSV_DIALECT, write_landing
from stratum.sources.tables import bronze_exists, read_bronze, read_snapshot
from stratum.specs import TableName, datasets, is_metadata, load_spec
from stratum.streaming import bronze, silver

# Fixed value: the first day of the calendar.
CALENDAR_START = "2016-01-01"

#: Session settings of a refresh. Spark's default keeps a statement's shuffle files
#: until the driver happens to collect its garbage. Tables are planned at more than
#: their bytes on disk, lest better compression turn a large one into a broadcast.
THRIFTY_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "2.0",
}
#: Landing files of a refresh: the dialect, compressed (a multi-line file is never split).
LANDING_OPTIONS = {**CSV_DIALECT, "compression": "gzip"}


def _by(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.orderBy(*columns)


@dataclass(frozen=True)
class Fact:
    """A Gold table computed from Silver tables, in the order of its arguments.
    It is stored sorted, each file a range of the order, so that the minima and
    maxima in the files let a reader skip most of them: by the order of the fact
    where it has one (``build`` may sort a short one itself), else by columns of
    which the last ones spread equal rows."""
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    order: Callable[[DataFrame], DataFrame] | None = None


FACTS = {
    "fact_sales": Fact(("orders", "order_items", "customers"), gold.fact_sales, _by("order_id")),
    "fact_seller_performance": Fact(("sellers", "order_items", "orders", "order_reviews"), gold.fact_seller_performance),
    "fact_product_performance": Fact(("order_items", "products", "order_reviews"), gold.fact_product_performance,
                                     _by("order_id", "product_id", "freight_value")),
    "fact_payment_summary": Fact(("order_payments", "orders", "customers"),
                                 partial(gold.fact_payment_summary, ordered=False), gold.payment_order),
}
CALENDAR = "dim_dates"


def gold_tables(conf: Path | str | None = None) -> list[str]:
    return [*datasets("gold", conf), *FACTS, CALENDAR]


def run_all(steps: list[Callable[[], object]], parallel: int = 1, sizes: Sequence[int] | None = None, most: int = 0) -> list:
    """Run independent steps, ``parallel`` at a time; the first failure is raised.
    ``sizes`` are the bytes that each step reads: those at work at once read ``most``
    bytes together, and a step of more runs alone."""
    if parallel <= 1:
        return [step() for step in steps]
    sizes = sizes or [0] * len(steps)
    room, at_work = threading.Condition(), []

    def run(step: Callable[[], object], size: int) -> object:
        with room:
            room.wait_for(lambda: not at_work or sum(at_work) + size <= most)
            at_work.append(size)
        try:
            return step()
        finally:
            with room:
                at_work.remove(size)
                room.notify_all()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [pool.submit(run, step, size) for step, size in zip(steps, sizes, strict=True)]
        return [f.result() for f in futures]


def filling(spark: SparkSession) -> int:
    """Bytes of input that give every core a full task. Beside a step that reads
    them another one would end no sooner, but what both shuffle would be on disk."""
    per_task = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return spark.sparkContext.defaultParallelism * per_task


@contextmanager
def thrifty(spark: SparkSession) -> Iterator[None]:
    """``THRIFTY_CONF`` while the block runs, where the session has no setting of its own."""
    ours = [k for k in THRIFTY_CONF if spark.conf.get(k, None) is None]
    for k in ours:
        spark.conf.set(k, THRIFTY_CONF[k])
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def stage_landing(frames: dict[str, DataFrame], lake: Lake, parallel: int = 1) -> None:
    """Drop one landing file set per dataset (a distributed CSV write each)."""
    if not frames:
        return
    with thrifty(next(iter(frames.values())).sparkSession):
        run_all([partial(write_landing, df, lake.landing(n), LANDING_OPTIONS) for n, df in frames.items()], parallel)


def gold_target(name: str, conf: Path | str | None = None) -> TableName:
    return load_spec(name, "gold", conf).target if name in datasets("gold", conf) else TableName("gold", name)


def gold_frame(spark: SparkSession, name: str, lake: Lake, conf: Path | str | None = None,
               calendar_start=None, calendar_end=None, given: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of one Gold table from the Silver tables that it reads, and no
    others; ``given`` are the rows of some of them. Not in a fact's stored order."""
    if name == CALENDAR:
        return gold.dim_dates(spark, calendar_start or CALENDAR_START, calendar_end)
    if name in FACTS:
        fact = FACTS[name]
        given = given or {}
        return fact.build(*[given[n] if n in given else silver.read_silver(spark, n, lake, conf) for n in fact.inputs])
    spec = load_spec(name, "gold", conf)
    return gold.dimension(KeyedTable(spark, lake.path(spec.source)).read(), spec.columns)


def build_gold(spark: SparkSession, lake: Lake, calendar_start=None, calendar_end=None, parallel: int = 1,
               names: Iterable[str] | None = None, conf: Path | str | None = None,
               clustered: bool = False) -> dict[str, str]:
    """Rebuild the named Gold tables (default: all); returns how to read each. The
    calendar runs from ``CALENDAR_START`` to 90 days from today unless told
    otherwise. A table stays as it was until its new content is complete. With
    ``clustered`` the facts read the tables that they join by order id from copies
    bucketed by it, written once for all of them (see ``clustering``)."""
    names = list(names or gold_tables(conf))
    unknown = set(names) - set(gold_tables(conf))
    if unknown:
        raise ValueError(f"no Gold table {', '.join(sorted(unknown))}; there are {', '.join(gold_tables(conf))}")

    def build(name: str, given: Mapping[str, DataFrame]) -> str:
        target = gold_target(name, conf)
        rows = gold_frame(spark, name, lake, conf, calendar_start, calendar_end, given)
        order = FACTS[name].order if name in FACTS else None
        # A sort in the statement of the joins would keep the shuffle files of both, and
        # read its input twice (once to find the ranges) by doing the last join twice.
        with storage.set_aside(rows, f"{lake.root}/_unsorted_{name}") if order else nullcontext(rows) as found:
            live = storage.write_snapshot(order(found) if order else found, lake.path(target))
        return lake.publish_snapshot(spark, target, live)

    def size(name: str) -> int:
        if name in FACTS:
            read = [load_spec(n, "silver", conf).target for n in FACTS[name].inputs]
        else:
            read = [load_spec(name, "gold", conf).source] if name != CALENDAR else []
        return sum(storage.size(spark, lake.path(t)) for t in read)

    wanted = {n for name in names if clustered and name in FACTS for n in FACTS[name].inputs if n in clustering.BY_ORDER}
    frames = {n: silver.read_silver(spark, n, lake, conf) for n in sorted(wanted)}
    with thrifty(spark), clustering.clustered(spark, frames, lake.root) if frames else nullcontext({}) as given:
        return dict(zip(names, run_all([partial(build, n, given) for n in names], parallel,
                                       [size(n) for n in names], filling(spark))))


def full_refresh(spark: SparkSession, lake: Lake, run_id: str | None = None,
                 ingest_ts: dt.datetime | None = None, calendar_start=None, calendar_end=None,
                 parallel: int = 1, max_files_per_trigger: int | None = None,
                 conf: Path | str | None = None, clustered: bool = False) -> dict[str, str]:
    """Ingest new landing files, refine them, rebuild Gold; returns how to read Gold."""
    run_id = run_id or str(uuid.uuid4())
    ingest_ts = ingest_ts or dt.datetime.now(dt.timezone.utc)

    def chain(name: str) -> None:      # dataset X: Bronze X, then Silver X
        bronze.ingest(spark, name, lake, ingest_ts=ingest_ts, max_files_per_trigger=max_files_per_trigger, conf=conf)
        silver.refine_stream(spark, name, lake, run_id, max_files_per_trigger, conf)

    names = datasets("silver", conf)
    with thrifty(spark):
        run_all([partial(chain, n) for n in names], parallel,
                [storage.size(spark, lake.landing(n)) for n in names], filling(spark))
    return build_gold(spark, lake, calendar_start, calendar_end, parallel, conf=conf, clustered=clustered)


def read_gold(spark: SparkSession, lake: Lake, name: str, conf: Path | str | None = None) -> DataFrame:
    return read_snapshot(spark, lake.path(gold_target(name, conf)))


def register_views(spark: SparkSession, lake: Lake, conf: Path | str | None = None) -> list[str]:
    """Every existing lake table as a temp view ``<schema>_<table>``; Silver and
    Bronze views keep their ``_`` columns."""
    out: list[str] = []

    def view(name: TableName, df: DataFrame) -> None:
        out.append(f"{name.schema}_{name.table}")
        df.createOrReplaceTempView(out[-1])

    for n in datasets("bronze", conf):
        target = load_spec(n, "bronze", conf).target
        if bronze_exists(spark, lake.path(target)):
            view(target, read_bronze(spark, lake.path(target)))
    for n in datasets("silver", conf):
        target = load_spec(n, "silver", conf).target
        table = KeyedTable(spark, lake.path(target))
        if table.exists():
            view(target, table.read())
    for n in gold_tables(conf):
        target = gold_target(n, conf)
        if storage.live_snapshot(spark, lake.path(target)):
            view(target, read_snapshot(spark, lake.path(target)))
    return out


def business_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not is_metadata(c)])
