"""Record layouts, and the mapping of an Avro schema file to a ``StructType``.

No layout is ever inferred from data.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Field order and types of a ball-by-ball delivery line.
DELIVERY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("inning", T.IntegerType()),
        T.StructField("over", T.IntegerType()),
        T.StructField("ball", T.IntegerType()),
        T.StructField("batsman", T.StringType()),
        T.StructField("non_striker", T.StringType()),
        T.StructField("bowler", T.StringType()),
        T.StructField("batsman_runs", T.IntegerType()),
        T.StructField("extra_runs", T.IntegerType()),
        T.StructField("total_runs", T.IntegerType()),
        T.StructField("non_boundary", T.IntegerType()),
        T.StructField("is_wicket", T.IntegerType()),
        T.StructField("dismissal_kind", T.StringType()),
        T.StructField("player_dismissed", T.StringType()),
        T.StructField("fielder", T.StringType()),
        T.StructField("extras_type", T.StringType()),
        T.StructField("batting_team", T.StringType()),
        T.StructField("bowling_team", T.StringType()),
    ]
)

# Field order of a match line. All are read as text; the parsed
# match leaves out ``date`` and ``result_margin`` unless they are asked for.
MATCH_FIELDS = [
    "id",
    "city",
    "date",
    "player_of_match",
    "venue",
    "neutral_venue",
    "team1",
    "team2",
    "toss_winner",
    "toss_decision",
    "winner",
    "result",
    "result_margin",
    "eliminator",
    "method",
    "umpire1",
    "umpire2",
]
MATCH_SKIPPED = ("date", "result_margin")
MATCH = T.StructType(
    [T.StructField(name, T.StringType()) for name in MATCH_FIELDS if name not in MATCH_SKIPPED]
)

# Output match: the text fields plus an int margin, in the record schema's order.
MATCH_OUT = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name == "result_margin" else T.StringType())
        for name in MATCH_FIELDS
        if name != "date"
    ]
)

# Output score: a delivery with ``total_runs`` widened for sums, plus the match.
SCORE_OUT = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name == "total_runs" else f.dataType)
        for f in DELIVERY.fields
    ]
    + [T.StructField("match", MATCH_OUT)]
)

# Dead-letter table layout.
DEAD_LETTER = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("payloadString", T.StringType(), False),
        T.StructField("payloadBytes", T.BinaryType(), False),
        T.StructField(
            "attributes",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
        T.StructField("errorMessage", T.StringType()),
        T.StructField("stacktrace", T.StringType()),
    ]
)

_AVRO_PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}


def avro_to_struct(schema: str | dict) -> T.StructType:
    """Map an Avro record schema to a ``StructType``.

    Handles primitives, arrays, nested records and ``["null", T]`` unions; any
    other type raises. A non-null field default is kept in the field metadata, and so
    is that a field is required: not nullable and without a default.
    """
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    struct, _ = _avro_type(parsed)
    if not isinstance(struct, T.StructType):
        raise ValueError("the top level of a message schema must be a record")
    return struct


def _avro_type(node) -> tuple[T.DataType, bool]:
    if isinstance(node, list):
        members = [m for m in node if m != "null"]
        if len(members) != 1 or len(members) == len(node):
            raise ValueError(f"unsupported Avro union: {node}")
        return _avro_type(members[0])[0], True
    kind = node["type"] if isinstance(node, dict) else node
    if kind == "record":
        return T.StructType([_avro_field(f) for f in node["fields"]]), False
    if kind == "array":
        items, nullable = _avro_type(node["items"])
        return T.ArrayType(items, nullable), False
    if isinstance(kind, (dict, list)):
        return _avro_type(kind)
    if kind in _AVRO_PRIMITIVES and not (isinstance(node, dict) and "logicalType" in node):
        return _AVRO_PRIMITIVES[kind], False
    raise ValueError(f"unsupported Avro type: {node}")


def _avro_field(field: dict) -> T.StructField:
    data_type, nullable = _avro_type(field["type"])
    default = field.get("default")
    metadata = {} if default is None else {"default": default}
    if not nullable and "default" not in field:
        metadata["required"] = True
    return T.StructField(field["name"], data_type, True, metadata)
