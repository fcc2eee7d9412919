"""Finding keys that hold too many rows for one task, and slicing them.

Slices come from a hash of the row itself, never from random numbers or row
positions, so a task that is run again after an executor loss sends every row
to the slice it went to before. Equal rows are first folded into one row with a
count and cut by copy number, so a block of copies spreads as well.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Rows one key may bring to one task before it is sliced.
MAX_GROUP_ROWS = 100_000
# Heavy keys that may travel to every executor; above this they are joined by shuffle.
MAX_BROADCAST_KEYS = 10_000

SLICES = "_slices"
COPIES = "_copies"
PIECE = "_piece"
COPY = "_copy"
PLACE = "_place"


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
    slice_rows: int | None = None,
) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows and the slices each needs, or None.

    A slice takes ``slice_rows`` rows, by default as many as need no slicing.
    Runs one aggregation over the key columns only, combined before the shuffle.
    The driver sees at most ``MAX_BROADCAST_KEYS`` rows; beyond that the lazy
    frame is returned and Spark picks the join by size.
    """
    slices = F.ceil(F.col("count") / (slice_rows or max_rows)).cast("int").alias(SLICES)
    counted = df.groupBy(*keys).count().where(F.col("count") > max_rows)
    heavy = counted.select(*[c for c in counted.columns if c != "count"], slices)
    # Arrow keeps timestamps exact; Python's local times would mix up the hour a clock repeats.
    rows = heavy.limit(MAX_BROADCAST_KEYS + 1).toArrow()
    if rows.num_rows == 0:
        return None
    if rows.num_rows > MAX_BROADCAST_KEYS:
        return heavy
    return F.broadcast(df.sparkSession.createDataFrame(rows, heavy.schema))


def heaviest_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """The keys with more than ``max_rows`` rows and the slices each needs, found when the plan runs.

    Only the ``MAX_BROADCAST_KEYS`` heaviest of them are listed, so the list may be sent to every
    executor; any other key has fewer than one in ``MAX_BROADCAST_KEYS`` of all rows.
    """
    counted = df.groupBy(*keys).count().where(F.col("count") > max_rows)
    heaviest = counted.orderBy(F.desc("count"), *keys).limit(MAX_BROADCAST_KEYS)
    slices = F.ceil(F.col("count") / max_rows).cast("int").alias(SLICES)
    return F.broadcast(heaviest.select(*keys, slices))


def common_slices(left: DataFrame, right: DataFrame, keys: Sequence[str], max_rows: int, slice_rows: float) -> DataFrame:
    """Like ``heaviest_keys``, by the larger side of each key, in slices of ``slice_rows`` rows."""
    counted = left.groupBy(*keys).count().unionByName(right.groupBy(*keys).count())
    larger = counted.groupBy(*keys).agg(F.max("count").alias("count")).where(F.col("count") > max_rows)
    heaviest = larger.orderBy(F.desc("count"), *keys).limit(MAX_BROADCAST_KEYS)
    return F.broadcast(heaviest.select(*keys, F.ceil(F.col("count") / slice_rows).cast("int").alias(SLICES)))


def numbered_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> tuple[int, DataFrame] | None:
    """How many keys have more than ``max_rows`` rows, and each of them with a number from 0, or None.

    At most the ``MAX_BROADCAST_KEYS`` heaviest are listed. Runs one aggregation over the keys.
    """
    rows = heaviest_keys(df, keys, max_rows).select(*keys).toArrow()
    if rows.num_rows == 0:
        return None
    schema = df.select(*keys).schema
    numbers = pa.array(range(rows.num_rows), pa.int32())
    listed = df.sparkSession.createDataFrame(rows.append_column(PLACE, numbers), schema.add(PLACE, IntegerType()))
    return rows.num_rows, F.broadcast(listed)


def with_place(df: DataFrame, keys: Sequence[str], listed: DataFrame) -> DataFrame:
    """Add the number of each row's key, null for keys that are not listed."""
    renamed = listed.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys], PLACE)
    same = [df[k].eqNullSafe(renamed[f"_heavy_{k}"]) for k in keys]
    return df.join(renamed, same, "left").select(*df.columns, PLACE)


def with_slices(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Add the number of slices of each row's key, 1 for all but the heavy ones."""
    renamed = heavy.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys], SLICES)
    same = [df[k].eqNullSafe(renamed[f"_heavy_{k}"]) for k in keys]
    joined = df.join(renamed, same, "left")
    return joined.select(*df.columns, F.coalesce(SLICES, F.lit(1)).alias(SLICES))


def fold_copies(df: DataFrame, max_copies: int = MAX_GROUP_ROWS) -> DataFrame:
    """Equal rows as one row with a count, cut into pieces of at most ``max_copies``."""
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    first = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / max_copies)))
    cut = folded.select("*", first.alias(PIECE))
    copies = F.least(F.lit(max_copies), F.col("_n") - F.col(PIECE) * max_copies)
    return cut.select(*df.columns, PIECE, copies.cast("int").alias(COPIES))


def number_copies(df: DataFrame) -> DataFrame:
    """The same rows with ``_copy``, which counts up over equal rows.

    It tells equal rows apart in the same way each time a task runs.
    """
    pieces = fold_copies(df)
    first = F.col(PIECE) * MAX_GROUP_ROWS
    copy = F.explode(F.sequence(first, first + F.col(COPIES) - 1)).alias(COPY)
    return pieces.select(*df.columns, copy)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by the columns into the session's full number of partitions.

    A given number keeps adaptive execution from merging small partitions. That
    goes by bytes, which is wrong for work that costs much per byte, such as
    opening a file or calling Python per group.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *columns)


def slice_of(columns: Sequence[str | Column], slices: Column) -> Column:
    """The slice of a row, from a hash of the given columns."""
    return F.pmod(F.xxhash64(*columns), slices).cast("int")
