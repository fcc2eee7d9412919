"""The windowed text sink on a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windrow.session import QUERY_ID
from windrow.sinks.names import SHARD_TEMPLATE
from windrow.sinks.windowed import write_windowed_text


def windowed_sink(
    finished: DataFrame,
    directory: str,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    writer: Callable[..., list[str] | None] = write_windowed_text,
    per_batch: bool = False,
    **naming,
) -> StreamingQuery:
    """Start writing finished windows to files; returns the running query.

    The writer is one of the windowed sinks, and ``naming`` its settings. A
    window comes in one batch, and its files are named by window and shard, so a
    batch that runs again replaces its own files.

    With ``per_batch`` a window may come in several batches, as from a stream whose
    windows are not finished: each batch is a pane of its own, named by the query's
    id and the batch. Only ``write_windowed_text`` names files by panes.
    """
    if per_batch and writer is not write_windowed_text:
        raise ValueError("only write_windowed_text can write files per batch")
    if per_batch and "P" not in (naming.get("template", SHARD_TEMPLATE) or ""):
        raise ValueError("files per batch need a P in the template")

    label = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        pane = {}
        if per_batch:
            query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
            pane["pane"] = f"pane-{query[:8]}-{batch_id}"
        # Two passes read the batch: rows per window, then the files.
        batch.persist()
        try:
            writer(batch, directory, run_label=f"{label}-{batch_id}", **pane, **naming)
        finally:
            batch.unpersist()

    stream = finished.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        stream = stream.queryName(query_name)
    stream = stream.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return stream.foreachBatch(write).start()
