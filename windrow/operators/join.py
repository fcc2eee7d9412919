"""Cogroup and the one-match lookup join."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.aggregate import collect_groups
from windrow.operators.skew import MAX_GROUP_ROWS, spread

ERROR = "error"
DROP = "drop"


def cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str] = "key",
    max_values: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """For every key of either side: its left rows and its right rows as two lists.

    Both sides go through one aggregation and one shuffle; the only join is with the
    broadcast list of heavy keys. The result is ``keys, chunk, left, right``; only a key with more than
    ``max_values`` rows has several chunks, which together hold each row once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = left.select(*keys, F.struct(*[c for c in left.columns if c not in keys]).alias("left"))
    b = right.select(*keys, F.struct(*[c for c in right.columns if c not in keys]).alias("right"))
    both = a.unionByName(b, allowMissingColumns=True)
    return collect_groups(both, keys, ["left", "right"], max_values)


def lookup_join_strict(
    left: DataFrame,
    right: DataFrame,
    on: str = "id",
    on_violation: str = ERROR,
    name: str = "match",
) -> DataFrame:
    """Each left row with the single right row of its key as a nested column.

    Every key of either side must have exactly one right row; right keys
    without left rows give nothing. With ``on_violation="error"`` a missing or
    repeated right row fails the job, even where the repeated key has no left
    rows; with ``"drop"`` such keys are left out.

    The error checks run below an ``observe`` node. No filter, join or column
    choice of a later step is moved below it, so none can take a check away; a
    ``limit`` may still stop the job before all rows are seen. The right side
    enters the join untouched, so Spark broadcasts it when its size allows and
    otherwise merges by key and splits heavy left keys.
    """
    if on_violation not in (ERROR, DROP):
        raise ValueError(f"on_violation must be {ERROR} or {DROP}, not {on_violation}")
    record = F.struct(*right.columns).alias(name)
    if on_violation == DROP:
        single = (
            right.select(F.col(on).alias("_key"), record)
            .groupBy("_key")
            .agg(F.count("*").alias("_n"), F.first(name).alias(name))
            .where("_n = 1")
        )
        return left.join(single, left[on] == single["_key"]).select(*left.columns, name)

    lookup = right.select(F.col(on).alias("_key"), record)
    joined = left.join(lookup, left[on] == lookup["_key"], "left")
    missing = F.raise_error(_message("no lookup row for key ", on)).cast("boolean")
    matched = joined.where(F.when(F.col("_key").isNotNull(), True).otherwise(missing)).select(
        *left.columns, name
    )
    repeated = F.raise_error(_message("several lookup rows for key ", on)).cast("boolean")
    no_rows = (
        spread(right.select(on), on)
        .groupBy(on)
        .count()
        .where(F.when(F.col("count") > 1, repeated).otherwise(False))
        .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in matched.schema.fields])
    )
    checked = matched.unionByName(no_rows)
    return checked.observe(f"lookup_join_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n_rows"))


def _message(text: str, key: str):
    return F.concat(F.lit(text), F.coalesce(F.col(key).cast("string"), F.lit("null")))
