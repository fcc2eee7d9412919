"""Row shaping: lines to typed rows, keys, records and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.scalars import field, split_commas, to_int
from windrow.operators.filter import drop_malformed
from windrow.schemas import DELIVERY, MATCH_FIELDS, MATCH_OUT, MATCH_SKIPPED, SCORE_OUT

FAILFAST = "FAILFAST"
DROPMALFORMED = "DROPMALFORMED"
PERMISSIVE = "PERMISSIVE"
CORRUPT = "_corrupt"


def split_fields(
    df: DataFrame, value: str = "value", cols: str = "cols", first: int | None = None
) -> DataFrame:
    """Add the comma-separated fields of each line as an array column.

    ``first`` cuts only the leading fields, see ``split_commas``.
    """
    return df.withColumn(cols, split_commas(value, first))


def _line_pattern(schema: T.StructType, number: str) -> str:
    """A regular expression for lines that hold at least the schema's fields.

    The last field must be text; a line counts as long enough when any
    non-empty field stands there or later, as trailing empty ones are dropped.
    """
    parts = [number if f.dataType == T.IntegerType() else "[^,]*" for f in schema.fields[:-1]]
    return "^" + "".join(p + "," for p in parts) + ",*[^,]"


def _well_formed(value: Column, schema: T.StructType) -> Column:
    """One pass over the raw line decides nearly every row; only lines with a number of
    ten or more digits take the second, exact check for the int range."""
    short = value.rlike(_line_pattern(schema, "[+-]?[0-9]{1,9}"))
    ints = [i for i, f in enumerate(schema.fields) if f.dataType == T.IntegerType()]
    if not ints:
        return F.coalesce(short, F.lit(False))
    cols = split_commas(value)
    in_range = value.rlike(_line_pattern(schema, "[+-]?[0-9]+"))
    for i in ints:
        in_range = in_range & F.get(cols, i).try_cast("int").isNotNull()
    return F.coalesce(short | in_range, F.lit(False))


def _parse(
    df: DataFrame,
    schema: T.StructType,
    keep: Sequence[tuple[int, Column]],
    mode: str,
    value: str,
    observation: Observation | None,
) -> DataFrame:
    ok = _well_formed(F.col(value), schema)
    first = max(position for position, _ in keep) + 1
    cols = split_commas(value, first if first < len(schema) else None)
    items = [item for _, item in keep]
    if mode == FAILFAST:
        message = F.concat(F.lit("malformed line: "), F.coalesce(F.col(value), F.lit("null")))
        checked = df.where(F.when(ok, True).otherwise(F.raise_error(message).cast("boolean")))
        return checked.withColumn("cols", cols).select(*items)
    if mode == DROPMALFORMED:
        return drop_malformed(df, ok, observation).withColumn("cols", cols).select(*items)
    if mode == PERMISSIVE:
        marked = df.withColumn(CORRUPT, F.when(~ok, F.col(value)))
        return marked.withColumn("cols", F.when(F.col(CORRUPT).isNull(), cols)).select(
            *items, CORRUPT
        )
    raise ValueError(f"mode must be {FAILFAST}, {DROPMALFORMED} or {PERMISSIVE}, not {mode}")


def parse_delivery(
    df: DataFrame,
    mode: str = FAILFAST,
    value: str = "value",
    observation: Observation | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Delivery lines to 18 typed columns; by default any bad line fails the job.

    The check is a filter on the whole line, so it also covers columns that are
    not asked for, or that a later projection prunes away. With ``columns`` the
    line is cut no further than the last of them.
    """
    keep = []
    for i, f in enumerate(DELIVERY.fields):
        item = F.get("cols", i)
        if f.dataType == T.IntegerType():
            item = item.try_cast("int")
        if columns is None or f.name in columns:
            keep.append((i, item.alias(f.name)))
    return _parse(df, DELIVERY, keep, mode, value, observation)


def parse_match(
    df: DataFrame,
    mode: str = DROPMALFORMED,
    value: str = "value",
    observation: Observation | None = None,
    columns: Sequence[str] | None = None,
    extras: bool = False,
) -> DataFrame:
    """Match lines to text columns; by default lines that are too short are dropped.

    ``columns`` works as for deliveries. ``extras`` adds the match date
    (month/day/two-digit year) and the result margin, where ``NA`` counts as 0.
    """
    lines = T.StructType([T.StructField(n, T.StringType()) for n in MATCH_FIELDS])
    keep = []
    for i, name in enumerate(MATCH_FIELDS):
        if name not in MATCH_SKIPPED and (columns is None or name in columns):
            keep.append((i, F.get("cols", i).alias(name)))
    if extras:
        at_date, at_margin = (MATCH_FIELDS.index(n) for n in MATCH_SKIPPED)
        date, margin = F.get("cols", at_date), F.get("cols", at_margin)
        keep.append((at_date, F.try_to_date(date, "MM/dd/yy").alias("match_date")))
        number = F.when(F.lower(margin) == "na", 0).otherwise(to_int(margin))
        keep.append((at_margin, number.alias("result_margin")))
    return _parse(df, lines, keep, mode, value, observation)


def key_player_kind(df: DataFrame, cols: str = "cols") -> DataFrame:
    """``batsman,dismissal_kind`` with the constant 1, one row per split line."""
    return df.select(
        F.concat(field(cols, 4), F.lit(","), field(cols, 12)).alias("key"), F.lit(1).alias("value")
    )


def key_match_batsman(df: DataFrame) -> DataFrame:
    """``id,batsman`` with the runs of the delivery."""
    return df.select(
        F.concat("id", F.lit(","), "batsman").alias("key"), F.col("batsman_runs").alias("value")
    )


def key_by(df: DataFrame, column: str = "id") -> DataFrame:
    """Add the record's own id as its key."""
    return df.withColumn("key", F.col(column))


def decode_key(df: DataFrame, key: str = "key") -> DataFrame:
    """Cut a composite key back into ``id`` and ``batsman``.

    A key with an empty batsman has only one field and fails the job.
    """
    cols = split_commas(key)
    return df.withColumns({"id": field(cols, 0), "batsman": field(cols, 1)})


def format_line(df: DataFrame, *columns: str, name: str = "value") -> DataFrame:
    """Join columns with commas into one text line; nulls print as ``null``."""
    return df.select(_joined(df, columns or df.columns).alias(name))


def row_to_delimited(df: DataFrame, name: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Every value in schema order, each followed by a comma; ``keep`` columns pass through."""
    columns = [c for c in df.columns if c not in keep]
    return df.select(F.concat(_joined(df, columns), F.lit(",")).alias(name), *keep)


def _joined(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[_as_text(df.schema[c]) for c in columns])


def _as_text(f: T.StructField) -> Column:
    nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
    text = F.to_json(F.col(f.name)) if nested else F.col(f.name).cast("string")
    return F.coalesce(text, F.lit("null"))


def to_flat_record(df: DataFrame) -> DataFrame:
    """Score rows to the output layout with the nested match left unset."""
    return df.select(*_scores(), F.lit(None).cast(MATCH_OUT).alias("match"))


def to_nested_record(df: DataFrame, match: str = "match") -> DataFrame:
    """Score rows to the output layout with the match filled in.

    The result margin is always 1 and a missing match fails the job.
    """
    fields = [
        F.lit(1).alias(f.name) if f.name == "result_margin" else F.col(match)[f.name].alias(f.name)
        for f in MATCH_OUT.fields
    ]
    missing = F.raise_error(F.lit("record without a match")).cast(MATCH_OUT)
    nested = F.when(F.col(match).isNotNull(), F.struct(*fields)).otherwise(missing)
    return df.select(*_scores(), nested.alias("match"))


def _scores() -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORE_OUT.fields[:-1]]


def records_to_rows(df: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """Lift the fields of a record column to top-level columns."""
    return df.select(f"{record}.*", *keep)


def attach_nested(df: DataFrame, columns: Sequence[str], name: str = "match") -> DataFrame:
    """Fold columns of the other join side into one nested column of the row."""
    rest = [c for c in df.columns if c not in columns and c != name]
    return df.select(*rest, F.struct(*columns).alias(name))
