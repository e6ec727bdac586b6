"""Streaming sinks: append files' rows to a table, or hand each micro-batch to a function.

Both drain what is available and stop (``availableNow``), keep progress in
``checkpoint``, and block until done; a failure in the stream is raised here
as ``StreamingQueryException``. A rerun resumes from the checkpoint, and a
micro-batch that failed is replayed under the same origin.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from stratum.sources import storage


def append_stream(files: DataFrame, path: str, checkpoint: str, read: Callable[[list[str]], DataFrame]) -> None:
    """Append the rows that ``read`` makes of each micro-batch's files (a stream of
    their paths, bounded by its trigger limit) to the table at ``path``, then stop.
    Every micro-batch is one batch directory, which only its own replay goes on with."""
    def append(batch: DataFrame, origin: str) -> None:
        paths = sorted(r.path for r in batch.collect())
        if paths:
            storage.append_batch(read(paths), path, origin)

    foreach_batch_stream(files, checkpoint, append)


def foreach_batch_stream(df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, str], None]) -> None:
    """Run ``fn(batch_df, origin)`` on each micro-batch, then stop. The origin
    names the batch: the query's id, which lives in the checkpoint and so outlasts
    restarts but not a new checkpoint, and the batch's number in it."""
    name, manager = f"batches-{uuid.uuid4().hex}", df.sparkSession.streams

    def call(batch: DataFrame, number: int) -> None:
        query = next(q for q in manager.active if q.name == name)
        fn(batch, f"{query.id}-{number}")

    (df.writeStream.queryName(name).foreachBatch(call).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
