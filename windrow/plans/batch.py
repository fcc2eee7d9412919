"""The two batch jobs, as plans over lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions.scalars import field
from windrow.operators.aggregate import count_by_key, sum_runs_by_match_batsman
from windrow.operators.filter import filter_flag
from windrow.operators.join import ERROR, lookup_join_strict
from windrow.operators.shape import (
    format_line,
    parse_delivery,
    parse_match,
    split_fields,
    to_flat_record,
    to_nested_record,
)


def outs_by_player_and_kind(lines: DataFrame) -> DataFrame:
    """Wickets per batsman and kind of dismissal, from delivery lines."""
    outs = filter_flag(split_fields(lines, first=13)).select(
        field("cols", 4).alias("batsman"), field("cols", 12).alias("dismissal_kind")
    )
    return count_by_key(outs, ["batsman", "dismissal_kind"])


def outs_lines(lines: DataFrame) -> DataFrame:
    """The same as text lines ``batsman,kind,n``."""
    return format_line(outs_by_player_and_kind(lines))


def joined_match_runs(
    deliveries: DataFrame,
    matches: DataFrame,
    on_violation: str = ERROR,
    match_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Runs per match and batsman, each row with its match nested in it."""
    scores = parse_delivery(deliveries, columns=["id", "batsman", "batsman_runs"])
    lookup = parse_match(matches, columns=match_columns)
    return lookup_join_strict(sum_runs_by_match_batsman(scores), lookup, "id", on_violation)


def match_batsman_runs(
    deliveries: DataFrame,
    matches: DataFrame,
    on_violation: str = ERROR,
    include_match: bool = False,
) -> DataFrame:
    """Runs per match and batsman in the output layout, from two sets of lines.

    Every match id must have one match line. The nested match is left unset
    unless ``include_match`` is given.
    """
    if include_match:
        return to_nested_record(joined_match_runs(deliveries, matches, on_violation))
    return to_flat_record(joined_match_runs(deliveries, matches, on_violation, ["id"]))


def match_lines(joined: DataFrame) -> DataFrame:
    """Text lines ``id,batsman,total_runs,player_of_match`` of joined rows."""
    flat = joined.withColumn("player_of_match", F.col("match.player_of_match"))
    return format_line(flat, "id", "batsman", "total_runs", "player_of_match")
