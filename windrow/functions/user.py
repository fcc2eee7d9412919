"""User code in a plan. The built-in operators never go through these.

Functions see pandas data in Arrow batches. ``group_fn`` and ``cogroup_fn`` hold
a whole group in one task. Groups are sliced where the arguments say that the
function allows it, and refused only where ``max_rows`` asks for that.
``group_batches_fn`` reads a group of any size in batches. ``cogroup_fn`` also
takes functions over Arrow tables, which cost far less a call than pandas.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DataType, IntegralType, StringType, StructType

from windrow.operators.skew import (
    COPY,
    MAX_GROUP_ROWS,
    PLACE,
    SLICES,
    common_slices,
    heaviest_keys,
    heavy_keys,
    number_copies,
    numbered_keys,
    slice_of,
    spread,
    with_place,
    with_slices,
)

# Rows of a function's output that are handed on together.
BATCH_ROWS = 10_000

# A function over a key's left rows and right rows, both pandas frames or both Arrow tables.
CogroupFn = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] | Callable[[pa.Table, pa.Table], pa.Table]


def flat_map_fn(
    df: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """Zero to many output rows per input row, batch by batch."""
    return df.mapInPandas(fn, schema)


def map_fn(
    fn: Callable[..., pd.Series], returns: DataType | str, *columns: Column | str
) -> Column:
    """One output value per row."""
    return _series_fn(fn, returns)(*columns)


def predicate_fn(fn: Callable[..., pd.Series], *columns: Column | str) -> Column:
    """A condition for ``where``."""
    return _series_fn(fn, "boolean")(*columns)


def _series_fn(fn: Callable[..., pd.Series], returns: DataType | str):
    def call(*series: pd.Series) -> pd.Series:
        return fn(*series)

    def one(a: pd.Series) -> pd.Series:
        return fn(a)

    def wrap(*columns):
        if len(columns) == 1:
            return F.pandas_udf(one, returns)(*columns)
        return F.pandas_udf(call, returns)(*columns)

    return wrap


def _sliced(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    rows = with_slices(number_copies(df), keys, heavy)
    return rows.select(*df.columns, slice_of([*df.columns, COPY], F.col(SLICES)).alias("_slice"))


def group_fn(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """A function over all rows of each key; its output must carry the keys.

    ``combine`` folds several outputs of ``fn`` for one key into the final one.
    With it, keys with more than ``max_rows`` (by default ``MAX_GROUP_ROWS``)
    rows run in slices. Without it every group is taken whole, however large; a
    given ``max_rows`` then refuses larger ones.
    """
    if combine is None and max_rows is None:
        return spread(df, *keys).groupBy(*keys).applyInPandas(fn, schema)
    heavy = heavy_keys(df, keys, max_rows or MAX_GROUP_ROWS)
    if heavy is None:
        return spread(df, *keys).groupBy(*keys).applyInPandas(fn, schema)
    if combine is None:
        raise ValueError(f"a key has more than {max_rows} rows; give combine to run it in slices")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.drop(columns="_slice"))

    by = [*keys, "_slice"]
    parts = spread(_sliced(df, keys, heavy), *by).groupBy(*by).applyInPandas(run, schema)
    return parts.groupBy(*keys).applyInPandas(combine, schema)


def group_batches_fn(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """A function over the batches of each key, as an iterator; its output must carry the keys.

    A group reaches the function a batch at a time, of at most Spark's
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows, so a group may be larger than a worker's
    memory. Its batches are read by one task, one after the other; where parts of a group can be
    worked on apart, ``group_fn`` with ``combine`` spreads them.

    Keys are counted first. Those of more than ``MAX_GROUP_ROWS`` rows, at most the
    ``MAX_BROADCAST_KEYS`` heaviest, have a partition each, which is read as it comes and never
    sorted, so a task's memory does not grow with a key. All others are sorted by key.
    """

    def run(batches):
        return fn(batches)

    # Spark tells the forms of a function apart by its type hints.
    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    heavy = numbered_keys(df, keys, MAX_GROUP_ROWS)
    if heavy is None:
        return spread(df, *keys).groupBy(*keys).applyInPandas(run, schema)
    partitions, listed = heavy

    def run_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = (pdf for pdf in batches if len(pdf))
        first = next(filled, None)
        if first is not None:
            yield from fn(chain([first], filled))

    placed = with_place(df, keys, listed)
    alone = placed.where(F.col(PLACE).isNotNull()).repartitionById(partitions, PLACE).drop(PLACE)
    others = placed.where(F.col(PLACE).isNull()).drop(PLACE)
    light = spread(others, *keys).groupBy(*keys).applyInPandas(run, schema)
    return alone.mapInPandas(run_one, schema).unionAll(light)


def cogroup_fn(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fn: CogroupFn,
    schema: StructType | str,
    per_left_row: bool = False,
    max_rows: int | None = None,
    per_right_row: bool = False,
    matching: Sequence[str] = (),
    arrow: bool = False,
) -> DataFrame:
    """A function over the left rows and the right rows of each key.

    With ``arrow`` the function takes and returns Arrow tables, as in Spark's ``applyInArrow``, and
    its columns are cast to the schema's types. It is called once per key in the same way, but a
    call costs a small part of one with pandas frames, which tells where keys are many and small.

    ``per_left_row`` says that the output is the union of the outputs for single
    left rows. With it, left keys of more than ``max_rows`` (by default
    ``MAX_GROUP_ROWS``) rows run in slices, each with a copy of the key's right
    rows. Otherwise groups are taken whole. A given ``max_rows`` refuses larger
    right groups, and larger left ones that may not be sliced.

    ``per_right_row``, which needs ``per_left_row``, says the same of right rows: the
    output is the union of those for a part of the left and a part of the right rows.
    Then both sides are cut, and each pair of slices is one call; neither side of a
    key is ever whole in one task. A part may be empty though its key is not, so the
    function may make nothing of an empty side.

    Pairs of slices grow with the square of a key's rows. ``matching`` names columns of both
    sides, of one type, such that a left and a right row that differ in any of them (nulls are
    equal) make nothing together. Then both sides are cut by these columns alike and a part meets
    only its like; only parts that are still too large are cut into pairs of slices.
    """
    if matching and not per_right_row:
        raise ValueError("matching needs per_right_row")
    if per_right_row:
        if not per_left_row:
            raise ValueError("per_right_row needs per_left_row")
        limit = max_rows or MAX_GROUP_ROWS
        if matching:
            return _cogroup_matching(left, right, keys, fn, schema, limit, matching, arrow)
        return _cogroup_slices(left, right, keys, fn, schema, limit, arrow)
    if max_rows is not None and heavy_keys(right, keys, max_rows) is not None:
        raise ValueError(f"a right key has more than {max_rows} rows")
    if max_rows is None and not per_left_row:
        return _cogrouped(left, right, keys, fn, schema, arrow)
    heavy = heavy_keys(left, keys, max_rows or MAX_GROUP_ROWS)
    if heavy is None:
        return _cogrouped(left, right, keys, fn, schema, arrow)
    if not per_left_row:
        raise ValueError(f"a left key has more than {max_rows} rows")

    every_slice = F.explode(F.sequence(F.lit(0), F.col(SLICES) - 1)).alias("_slice")
    copied = with_slices(right, keys, heavy).select(*right.columns, every_slice)
    sliced = _sliced(left, keys, heavy)
    return _cogrouped(sliced, copied, [*keys, "_slice"], _without(["_slice"], fn, arrow), schema, arrow)


def _without(columns: list[str], fn: CogroupFn, arrow: bool) -> CogroupFn:
    """The function over rows without the given columns."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a.drop(columns=columns), b.drop(columns=columns))

    def run_arrow(a: pa.Table, b: pa.Table) -> pa.Table:
        return fn(a.drop_columns(columns), b.drop_columns(columns))

    return run_arrow if arrow else run


def _cogroup_matching(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fn: CogroupFn,
    schema: StructType | str,
    max_rows: int,
    matching: Sequence[str],
    arrow: bool,
) -> DataFrame:
    """Cogroup by parts of a key that agree in a hash of the matching columns."""
    for c in matching:
        if left.schema[c].dataType != right.schema[c].dataType:
            raise ValueError(f"{c} must have one type on both sides")
    # Parts of half the limit on average, so that hardly any comes out above it.
    heavy = common_slices(left, right, keys, max_rows, max_rows / 2)
    part = slice_of(list(matching), F.col(SLICES)).alias("_part")
    sides = [with_slices(df, keys, heavy).select(*df.columns, part) for df in (left, right)]
    cells, run = [*keys, "_part"], _without(["_part"], fn, arrow)
    if all(heavy_keys(side, cells, max_rows) is None for side in sides):
        return _cogrouped(*sides, cells, run, schema, arrow)
    return _cogroup_slices(*sides, cells, run, schema, max_rows, arrow)


def _cogroup_slices(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fn: CogroupFn,
    schema: StructType | str,
    max_rows: int,
    arrow: bool,
) -> DataFrame:
    """Cogroup by pairs of slices: each side's slices go to all slices of the other side's key."""
    heavy = [heaviest_keys(side, keys, max_rows) for side in (left, right)]
    cells = [*keys, "_left", "_right"]

    def cut(df: DataFrame, own: DataFrame, other: DataFrame, names: tuple[str, str]) -> DataFrame:
        placed = with_slices(number_copies(df), keys, own)
        placed = placed.select(
            *df.columns, slice_of([*df.columns, COPY], F.col(SLICES)).alias(names[0])
        )
        every = F.explode(F.sequence(F.lit(0), F.col(SLICES) - 1)).alias(names[1])
        return with_slices(placed, keys, other).select(*df.columns, names[0], every)

    lefts = cut(left, heavy[0], heavy[1], ("_left", "_right"))
    rights = cut(right, heavy[1], heavy[0], ("_right", "_left")).select(*right.columns, "_left", "_right")
    return _cogrouped(lefts, rights, cells, _without(["_left", "_right"], fn, arrow), schema, arrow)


def _whole(kind: DataType) -> bool:
    """Whether pandas holds a column of the type otherwise where it has nulls."""
    return isinstance(kind, (IntegralType, BooleanType))


def _filled(column: Column, kind: DataType) -> Column:
    """The column with a value in place of nulls."""
    return F.coalesce(column, F.lit("" if kind == StringType() else 0).cast(kind))


def _cogrouped(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    fn: CogroupFn,
    schema: StructType | str,
    arrow: bool,
) -> DataFrame:
    """The function over each key's rows of both sides.

    Spark's own cogroup starts two Arrow streams per key, which costs far more than small groups
    do. Here both sides go through one sorted stream, a task reads it in batches of many keys, and
    cuts them to keys. A key's rows are whole in one call, with a column's pandas type as if they
    came alone: whole numbers and truth values travel without nulls, beside marks for them. Arrow
    tables have no need of those.
    """
    kinds = [left.schema[k].dataType for k in by]
    plain = all(isinstance(k, IntegralType) or k in (StringType(), BooleanType()) for k in kinds)
    if not plain or kinds != [right.schema[k].dataType for k in by] or len(inspect.signature(fn).parameters) != 2:
        groups = spread(left, *by).groupBy(*by).cogroup(spread(right, *by).groupBy(*by))
        return groups.applyInArrow(fn, schema) if arrow else groups.applyInPandas(fn, schema)
    if arrow:
        return _cogrouped_arrow(left, right, by, fn, schema)

    sides = (left, right)
    order = [n for i in range(len(by)) for n in (f"k{i}_null", f"k{i}")]

    def tagged(side: int) -> DataFrame:
        out = []
        for i, (k, kind) in enumerate(zip(by, kinds)):
            out += [F.col(k).isNull().alias(f"k{i}_null"), _filled(F.col(k), kind).alias(f"k{i}")]
        out.append(F.lit(side).alias("side"))
        for s, df in enumerate(sides):
            for i, f in enumerate(df.schema.fields):
                value = F.col(f.name) if s == side else F.lit(None).cast(f.dataType)
                if _whole(f.dataType):
                    out.append((value.isNull() if s == side else F.lit(False)).alias(f"s{s}_{i}_null"))
                    value = _filled(value, f.dataType)
                out.append(value.alias(f"s{s}_{i}"))
        return sides[side].select(*out)

    rows = spread(tagged(0).unionAll(tagged(1)), *order).sortWithinPartitions(*order, "side")
    names = [df.columns for df in sides]
    whole = [[i for i, f in enumerate(df.schema.fields) if _whole(f.dataType)] for df in sides]
    columns = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame, pd.DataFrame]]:
        """Whether a new key starts, and its rows of each side, as far as a batch has them."""
        last = None
        for pdf in batches:
            if not len(pdf):
                continue
            starts = np.zeros(len(pdf), bool)
            starts[0] = last is None
            for n in order:
                v = pdf[n].to_numpy()
                starts[1:] |= v[1:] != v[:-1]
                starts[0] |= last is not None and v[0] != last[n]
            last = {n: pdf[n].iloc[-1] for n in order}
            at = np.unique(np.append(np.flatnonzero(starts), 0))
            parts = []
            for s in (0, 1):
                mine = (pdf["side"] == s).to_numpy()
                own = pdf[mine]
                nulls = {i: own[f"s{s}_{i}_null"].to_numpy() for i in whole[s]}
                nulls = {i: v for i, v in nulls.items() if v.any()}
                own = own[[f"s{s}_{i}" for i in range(len(names[s]))]].set_axis(names[s], axis=1)
                bounds = np.append(0, np.cumsum(mine))[np.append(at, len(pdf))].tolist()
                parts.append((own, nulls, bounds))
            for g, first in enumerate(at.tolist()):
                yield bool(starts[first]), *(_piece(own, nulls, ends[g], ends[g + 1]) for own, nulls, ends in parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[pd.DataFrame, pd.DataFrame]] = []
        done: dict[tuple, list[pd.DataFrame]] = {}
        size = 0

        def call() -> int:
            a, b = held[0] if len(held) == 1 else (_stacked([h[s] for h in held]) for s in (0, 1))
            held.clear()
            out = _with_columns(fn(a, b), columns)
            if len(out):
                # Frames of unlike types are kept apart, as joining them would change values.
                done.setdefault(tuple(out.dtypes), []).append(out)
            return len(out) + 1

        for new, a, b in cut(batches):
            if new and held:
                size += call()
            held.append((a, b))
            if size >= BATCH_ROWS:
                yield from (pd.concat(frames, ignore_index=True) for frames in done.values())
                done.clear()
                size = 0
        if held:
            call()
        yield from (pd.concat(frames, ignore_index=True) for frames in done.values())

    return rows.mapInPandas(run, schema)


def _cogrouped_arrow(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    fn: Callable[[pa.Table, pa.Table], pa.Table],
    schema: StructType | str,
) -> DataFrame:
    """Like ``_cogrouped`` over Arrow tables. Both sides share the key columns of the stream."""
    sides = (left, right)
    order = [f"k{i}" for i in range(len(by))]

    def tagged(side: int) -> DataFrame:
        out = [F.col(k).alias(n) for k, n in zip(by, order)] + [F.lit(side).alias("side")]
        for s, df in enumerate(sides):
            for i, f in enumerate(df.schema.fields):
                if f.name not in by:
                    value = F.col(f.name) if s == side else F.lit(None).cast(f.dataType)
                    out.append(value.alias(f"s{s}_{i}"))
        return sides[side].select(*out)

    rows = spread(tagged(0).unionAll(tagged(1)), *order).sortWithinPartitions(*order, "side")
    names = [df.columns for df in sides]
    found = [[order[by.index(n)] if n in by else f"s{s}_{i}" for i, n in enumerate(own)] for s, own in enumerate(names)]
    large = left.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes") == "true"
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    want = to_arrow_schema(want, prefers_large_types=large)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table, pa.Table]]:
        """Whether a new key starts, and its rows of each side, as far as a batch has them."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.zeros(batch.num_rows, bool)
            starts[0] = last is None
            for n in order:
                v = batch.column(n)
                if last is None:
                    starts[1:] |= _changes(v)
                else:
                    starts |= _changes(pa.concat_arrays([last.column(n), v]))
            last = batch.slice(batch.num_rows - 1)
            a, b = (pa.table([batch.column(c) for c in found[s]], names=names[s]) for s in (0, 1))
            at = np.unique(np.append(np.flatnonzero(starts), 0))
            # A key's left rows come before its right rows.
            lefts = np.add.reduceat(batch.column("side").to_numpy() == 0, at, dtype=np.int64)
            ends = np.append(at[1:], batch.num_rows)
            for new, first, n, end in zip(starts[at].tolist(), at.tolist(), lefts.tolist(), ends.tolist()):
                yield new, a.slice(first, n), b.slice(first + n, end - first - n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Table, pa.Table]] = []
        done: list[pa.Table] = []
        size = 0

        def call() -> int:
            a, b = held[0] if len(held) == 1 else (pa.concat_tables([h[s] for h in held]) for s in (0, 1))
            held.clear()
            out = _in_schema(fn(a, b), want)
            if out.num_rows:
                done.append(out)
            return out.num_rows + 1

        def joined() -> list[pa.RecordBatch]:
            return pa.concat_tables(done).combine_chunks().to_batches(BATCH_ROWS) if done else []

        for new, a, b in cut(batches):
            if new and held:
                size += call()
            held.append((a, b))
            if size >= BATCH_ROWS:
                yield from joined()
                done.clear()
                size = 0
        if held:
            call()
        yield from joined()

    return rows.mapInArrow(run, schema)


def _changes(v: pa.Array) -> np.ndarray:
    """Whether a value differs from the one before it, from the second on; nulls are equal."""
    gone = v.is_null()
    differ = pc.fill_null(pc.not_equal(v[1:], v[:-1]), False)
    return pc.or_(differ, pc.not_equal(gone[1:], gone[:-1])).to_numpy(zero_copy_only=False)


def _in_schema(out: pa.Table, want: pa.Schema) -> pa.Table:
    """A function's output with the columns of the schema, by name, and their types."""
    if not isinstance(out, pa.Table):
        raise TypeError(f"the function must return an Arrow table, not {type(out).__name__}")
    if out.schema.equals(want):
        return out
    if not out.num_columns and not out.num_rows:
        return want.empty_table()
    if sorted(out.column_names) != sorted(want.names):
        raise ValueError(f"the function returned columns {out.column_names}, not {want.names}")
    return out.select(want.names).cast(want)


def _piece(own: pd.DataFrame, nulls: dict[int, np.ndarray], first: int, end: int) -> pd.DataFrame:
    """Some of one side's rows, numbered from 0, with the nulls put back."""
    piece = own.iloc[first:end]
    piece.index = pd.RangeIndex(end - first)
    for i, marks in nulls.items():
        gone = marks[first:end]
        if gone.any():
            name, values = piece.columns[i], piece.iloc[:, i]
            floats = not pd.api.types.is_bool_dtype(values)
            piece = piece.assign(**{name: values.astype("float64" if floats else object).mask(gone, np.nan if floats else None)})
    return piece


def _stacked(pieces: list[pd.DataFrame]) -> pd.DataFrame:
    """Pieces of one key, in order; those without rows do not count for the types."""
    return pd.concat([p for p in pieces if len(p)] or pieces[:1], ignore_index=True)


def _with_columns(out: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """A function's output with the columns of the schema: by name, or where none has one by place."""
    if not isinstance(out, pd.DataFrame):
        raise TypeError(f"the function must return a pandas frame, not {type(out).__name__}")
    got = list(out.columns)
    if got == columns or not got and not len(out):
        return out
    if any(isinstance(c, str) for c in got):
        if sorted(map(str, got)) != sorted(columns):
            raise ValueError(f"the function returned columns {got}, not {columns}")
        return out[columns]
    if len(got) != len(columns):
        raise ValueError(f"the function returned {len(got)} columns, not {len(columns)}")
    return out.set_axis(columns, axis=1)


def composite(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A named chain of steps for ``df.transform``."""

    def expand(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return expand
