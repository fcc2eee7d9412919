"""The two streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windrow import hadoop
from windrow.operators.shape import records_to_rows, row_to_delimited
from windrow.sources.dead_letters import dead_letter_files, route_dead_letters
from windrow.streaming.sink import windowed_sink
from windrow.streaming.windows import WINDOW_LENGTH, finalize_window, tumbling_window


def messages_to_window_files(
    messages: DataFrame,
    directory: str,
    checkpoint: str,
    length: str = WINDOW_LENGTH,
    delay: str = "0 seconds",
    trigger: dict | None = None,
    finalize: bool = True,
    **naming,
) -> StreamingQuery:
    """Text messages to one set of files per window.

    Without ``finalize`` no window waits for its end and nothing is kept between
    batches: every batch writes what it has as files of its own, whose pane names the
    batch, and no row is late.
    """
    if finalize:
        rows = finalize_window(messages, length, delay)
    else:
        rows = tumbling_window(messages, length)
    return windowed_sink(rows, directory, checkpoint, trigger, per_batch=not finalize, **naming)


def records_to_lines(decoded: DataFrame) -> DataFrame:
    """Good records as delimited text with their event time."""
    rows = records_to_rows(decoded, keep=["ts"])
    return row_to_delimited(rows, keep=["ts"])


def records_to_window_files(
    decoded: DataFrame,
    directory: str,
    checkpoint: str,
    write_dead_letters: Callable[[DataFrame, int], None] | str,
    length: str = WINDOW_LENGTH,
    delay: str = "0 seconds",
    trigger: dict | None = None,
    finalize: bool = True,
    **naming,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Decoded messages to one set of files per window, bad payloads to a dead-letter writer.

    ``write_dead_letters`` is a path, where each batch replaces its own folder, or a
    function of a batch and its number.

    Two queries read the source. Dead letters leave at once and whatever their
    event time, so they cannot share the windowed query, which holds rows back
    and drops late ones.
    """
    if isinstance(write_dead_letters, str):
        write_dead_letters = dead_letter_files(write_dead_letters)
    good, bad = route_dead_letters(decoded)
    files = messages_to_window_files(
        records_to_lines(good),
        directory,
        hadoop.join(checkpoint, "files"),
        length,
        delay,
        trigger,
        finalize,
        **naming,
    )
    letters = (
        bad.writeStream.option("checkpointLocation", hadoop.join(checkpoint, "dead_letters"))
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(write_dead_letters)
        .start()
    )
    return files, letters


def await_all(queries: tuple[StreamingQuery, ...]) -> None:
    """Wait until every query has ended; one that fails stops the others and raises."""
    open_queries = list(queries)
    try:
        while open_queries:
            # A failed query raises here.
            open_queries = [q for q in open_queries if not q.awaitTermination(0.2)]
    finally:
        for query in open_queries:
            query.stop()
