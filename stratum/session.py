"""Session settings and the shared lake folder.

The library never creates its own session inside an operator: every function
takes the caller's DataFrames or session. ``local_session`` is for tests and
the bench only.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from stratum.sources import storage
from stratum.specs import TableName

# Settings the pipeline relies on, applied by local_session. On a cluster they
# belong in the job's own configuration.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratum", extra: dict | None = None,
                  max_failures: int | None = None) -> SparkSession:
    """Local session for tests and the bench; ``max_failures`` lets a failed
    task be retried (local mode does not retry by default)."""
    master = f"local[{cores},{max_failures}]" if max_failures else f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stratum-warehouse-"))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the
    running context. Only a local master gets a scratch folder of its own when
    neither is set (removed at exit); on a cluster that is an error, since
    executors would write to their own disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))     # the context appends a folder of its own
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="stratum-scratch-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    sc.setCheckpointDir(root)
    return root


@dataclass(frozen=True)
class Lake:
    """Where a lakehouse keeps its tables, landing files and stream progress.

    ``root`` must be a folder that all executors share. Tables are parquet
    directories ``<root>/<schema>/<table>``. With ``databases`` set (a name prefix,
    may be ``""``) every table also has the catalog name ``<prefix><schema>.<table>``:
    Bronze tables with a partition per committed batch, Gold tables at their live
    snapshot, and Silver tables as views of their live directories, each changed in
    one step after a write.
    """

    root: str
    databases: str | None = None

    def path(self, name: TableName) -> str:
        return f"{self.root}/{name.schema}/{name.table}"

    def ref(self, name: TableName) -> str:
        """How a user reads the table: its name, else the path."""
        return self.path(name) if self.databases is None else f"{self.databases}{name.schema}.{name.table}"

    def _database(self, spark: SparkSession, name: TableName) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.databases}{name.schema} LOCATION '{self.root}/{name.schema}'")

    def publish(self, spark: SparkSession, name: TableName, query: str) -> str:
        """A view of the table's live directories."""
        if self.databases is not None:
            self._database(spark, name)
            spark.sql(f"CREATE OR REPLACE VIEW {self.ref(name)} AS {query}")
        return self.ref(name)

    def publish_batches(self, spark: SparkSession, name: TableName) -> str:
        """A table with one partition per committed batch directory."""
        done = storage.batches(spark, self.path(name)) if self.databases is not None else []
        if done:
            self._database(spark, name)
            if not spark.catalog.tableExists(self.ref(name)):
                columns = spark.read.parquet(done[0]).schema
                self._create(spark, name, self.path(name), columns.add(storage.BATCH, "string"),
                             f" PARTITIONED BY ({storage.BATCH})")
            known = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {self.ref(name)}").collect()}
            new = [b for b in (d.rpartition("=")[2] for d in done) if b not in known]
            if new:
                spark.sql(f"ALTER TABLE {self.ref(name)} ADD IF NOT EXISTS "
                          + " ".join(f"PARTITION ({storage.BATCH}='{b}')" for b in new))
                spark.catalog.refreshTable(self.ref(name))
        return self.ref(name)

    def publish_snapshot(self, spark: SparkSession, name: TableName, live: str) -> str:
        """A table at its live snapshot; made anew if its columns have changed."""
        if self.databases is not None:
            self._database(spark, name)
            columns = spark.read.parquet(live).schema
            exists = spark.catalog.tableExists(self.ref(name))
            if exists and spark.table(self.ref(name)).schema != columns:
                spark.sql(f"DROP TABLE {self.ref(name)}")
                exists = False
            if exists:
                spark.sql(f"ALTER TABLE {self.ref(name)} SET LOCATION '{live}'")
                spark.catalog.refreshTable(self.ref(name))
            else:
                self._create(spark, name, live, columns)
        return self.ref(name)

    def _create(self, spark: SparkSession, name: TableName, location: str, columns: StructType, more: str = "") -> None:
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(f"CREATE TABLE {self.ref(name)} ({declared}) USING parquet{more} LOCATION '{location}'")

    def archive(self, dataset: str) -> str:
        """Where processed landing files go."""
        return f"{self.root}/_archive/{dataset}"

    def landing(self, dataset: str) -> str:
        return f"{self.root}/landing/{dataset}"

    def checkpoint(self, name: TableName) -> str:
        return f"{self.root}/_checkpoints/{name.schema}/{name.table}"

    @staticmethod
    def fresh(spark: SparkSession, label: str = "lake") -> "Lake":
        """A new lake folder under the shared checkpoint folder."""
        return Lake(f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}")
