from windrow.functions.scalars import (
    equals_ignore_case,
    field,
    pad_number,
    split_commas,
    to_int,
)
from windrow.functions.user import (
    cogroup_fn,
    composite,
    flat_map_fn,
    group_batches_fn,
    group_fn,
    map_fn,
    predicate_fn,
)

__all__ = [
    "cogroup_fn",
    "composite",
    "equals_ignore_case",
    "field",
    "flat_map_fn",
    "group_batches_fn",
    "group_fn",
    "map_fn",
    "pad_number",
    "predicate_fn",
    "split_commas",
    "to_int",
]
