"""Payloads that cannot be decoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import hadoop
from windrow.schemas import DEAD_LETTER
from windrow.session import QUERY_ID
from windrow.sources.messages import ATTRIBUTES, BAD

ERROR_TEXT = "payload does not match the record schema"

NO_QUERY = "none"


def route_dead_letters(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split decoded messages into the good ones and dead-letter rows."""
    return df.where(~F.col(BAD)).drop(BAD), to_dead_letters(df.where(BAD), value)


def to_dead_letters(df: DataFrame, value: str = "value") -> DataFrame:
    """Failed messages in the dead-letter layout; a null payload counts as an empty one."""
    attributes = DEAD_LETTER[ATTRIBUTES].dataType
    carried = F.coalesce(F.col(ATTRIBUTES), F.array()) if ATTRIBUTES in df.columns else F.array()
    payload = F.coalesce(F.col(value).cast("binary"), F.lit(b""))
    return df.select(
        F.current_timestamp().alias("timestamp"),
        F.coalesce(F.col(value).cast("string"), F.lit("")).alias("payloadString"),
        payload.alias("payloadBytes"),
        carried.cast(attributes).alias(ATTRIBUTES),
        F.lit(ERROR_TEXT).alias("errorMessage"),
        F.lit(None).cast("string").alias("stacktrace"),
    )


def dead_letter_files(
    path: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """A writer of dead-letter batches to files, for ``foreachBatch``.

    Each batch has a folder of its own, ``query=<id>/batch=<number>``, which it
    replaces, so a batch that runs again gives each letter once. The id is the one
    the query keeps in its checkpoint: a query that starts afresh, and counts from
    0 again, does not touch the letters of an earlier one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or NO_QUERY
        folder = hadoop.join(path, f"query={query}", f"batch={batch_id}")
        batch.write.format(fmt).options(**(options or {})).mode("overwrite").save(folder)

    return write


def dead_letter_messages(
    fmt: str, options: dict[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """A writer of dead-letter batches to a topic or another sink without folders.

    A letter is one JSON ``value`` with its attributes as ``headers``, and ``key`` is
    ``<query id>-<batch>``: such a sink cannot take a batch back, so after a replay the
    key tells which letters came twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or NO_QUERY
        headers = F.transform(
            ATTRIBUTES,
            lambda a: F.struct(a["key"].alias("key"), a["value"].cast("binary").alias("value")),
        )
        letters = batch.select(
            F.lit(f"{query}-{batch_id}").alias("key"),
            F.to_json(F.struct(*[c for c in batch.columns if c != ATTRIBUTES])).alias("value"),
            headers.alias("headers"),
        )
        letters.write.format(fmt).options(**(options or {})).mode("append").save()

    return write


def read_dead_letters(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All letters that ``dead_letter_files`` wrote below a path, with their ``query`` and ``batch``."""
    keys = [T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())]
    return spark.read.format(fmt).schema(T.StructType([*DEAD_LETTER.fields, *keys])).load(path)
