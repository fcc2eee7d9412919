"""Grouping and sums.

Sums and counts use Spark's own two-step aggregation, so a key that holds most
of the rows still reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.operators.skew import MAX_GROUP_ROWS, SLICES, heaviest_keys, slice_of, spread, with_slices
from windrow.schemas import SCORE_OUT


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of a type."""
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def collect_groups(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], max_values: int
) -> DataFrame:
    """Lists of the non-null ``values`` per key, as ``keys, chunk, values``.

    A key with up to ``max_values`` rows gives one row with chunk 0. A heavier
    key gives several, together holding every value once, with at most
    ``max_values`` in each list.

    Nothing runs before the result does. One plan holds for all sizes: rows of the
    heaviest keys go to slices by a hash of the row and of the partition it lies in,
    all others to one slice per key, and a slice's list is cut to the limit. Rows of
    a key that are equal and lie in one partition stay in one slice. Values are never
    grouped by, so they come back as they were, whatever their type.
    """
    heavy = heaviest_keys(rows, keys, max_values)
    sliced = with_slices(rows, keys, heavy)
    hashed = [v for v in values if _hashable(rows.schema[v].dataType)]
    place = slice_of([*hashed, F.spark_partition_id()], F.col(SLICES))
    sliced = sliced.withColumn("chunk", F.when(F.col(SLICES) > 1, place).otherwise(0))
    grouped = sliced.groupBy(*keys, SLICES, "chunk").agg(*[F.collect_list(v).alias(v) for v in values])
    longest = F.greatest(*[F.size(v) for v in values]) if len(values) > 1 else F.size(values[0])
    part = F.explode(F.sequence(F.lit(0), F.floor(F.greatest(longest - 1, F.lit(0)) / max_values)))
    cut = grouped.withColumn("part", part)
    first = (F.col("part") * max_values + 1).cast("int")
    whole = longest <= max_values
    return cut.select(
        *keys,
        (F.col("chunk") + F.col("part") * F.col(SLICES)).cast("int").alias("chunk"),
        *[F.when(whole, F.col(v)).otherwise(F.slice(v, first, max_values)).alias(v) for v in values],
    )


def group_by_key(
    df: DataFrame,
    keys: str | Sequence[str] = "key",
    value: str = "value",
    max_values: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """All values per key, in no order, as ``keys, chunk, values``.

    Use an aggregate instead wherever one fits. See ``collect_groups`` for the
    chunks of keys with more than ``max_values`` rows.
    """
    keys = _names(keys)
    rows = df.select(*keys, F.struct(F.col(value).alias("v")).alias("values"))
    grouped = collect_groups(rows, keys, ["values"], max_values)
    return grouped.withColumn("values", F.transform("values", lambda s: s["v"]))


def sum_by_key(
    df: DataFrame, keys: str | Sequence[str] = "key", value: str = "value", name: str = "total"
) -> DataFrame:
    """Sum per key as bigint."""
    return df.groupBy(*_names(keys)).agg(F.sum(F.col(value).cast("bigint")).alias(name))


def count_by_key(df: DataFrame, keys: str | Sequence[str] = "key", name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*_names(keys)).agg(F.count("*").alias(name))


def sum_runs_by_match_batsman(df: DataFrame) -> DataFrame:
    """Runs per match and batsman, as a score row where every other field is the default.

    Grouping is by the two columns, so rows with an empty batsman are kept.

    There are about as many groups as rows, so sums made where a file is read would hold a whole
    file split in memory. Rows are dealt to a fixed number of partitions first, those of one key
    by the partition they come from, so that a key of very many rows still spreads. The partial
    sums then move by ``id``, where a join by it finds them.
    """
    runs = df.select("id", "batsman", F.col("batsman_runs").cast("bigint").alias("runs"), F.spark_partition_id().alias("part"))
    dealt = ["id", "batsman", "part"]
    partial = spread(runs, *dealt).groupBy(*dealt).agg(F.sum("runs").alias("runs"))
    totals = spread(partial.drop("part"), "id").groupBy("id", "batsman").agg(F.sum("runs").alias("total_runs"))
    computed = ("id", "batsman", "total_runs")
    defaults = []
    for f in SCORE_OUT.fields[:-1]:
        if f.name in computed:
            defaults.append(F.col(f.name))
        elif f.dataType.typeName() == "integer":
            defaults.append(F.lit(0).alias(f.name))
        else:
            defaults.append(F.lit(None).cast(f.dataType).alias(f.name))
    return totals.select(*defaults)
