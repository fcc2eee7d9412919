from windrow.operators.aggregate import (
    count_by_key,
    group_by_key,
    sum_by_key,
    sum_runs_by_match_batsman,
)
from windrow.operators.filter import drop_malformed, filter_flag
from windrow.operators.join import cogroup, lookup_join_strict
from windrow.operators.shape import (
    attach_nested,
    decode_key,
    format_line,
    key_by,
    key_match_batsman,
    key_player_kind,
    parse_delivery,
    parse_match,
    records_to_rows,
    row_to_delimited,
    split_fields,
    to_flat_record,
    to_nested_record,
)

__all__ = [
    "attach_nested",
    "cogroup",
    "count_by_key",
    "decode_key",
    "drop_malformed",
    "filter_flag",
    "format_line",
    "group_by_key",
    "key_by",
    "key_match_batsman",
    "key_player_kind",
    "lookup_join_strict",
    "parse_delivery",
    "parse_match",
    "records_to_rows",
    "row_to_delimited",
    "split_fields",
    "sum_by_key",
    "sum_runs_by_match_batsman",
    "to_flat_record",
    "to_nested_record",
]
