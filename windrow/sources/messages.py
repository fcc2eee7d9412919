"""Message streams: plain text payloads, and payloads with a record schema."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro

from windrow import hadoop
from windrow.schemas import DEAD_LETTER, avro_to_struct

JSON = "json"
AVRO = "avro"
RECORD = "record"
BAD = "_bad"
ATTRIBUTES = "attributes"


def read_messages(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
    value: str | Column = "value",
    time: str | Column = "timestamp",
    binary: bool = False,
    attributes: str | Column | None = None,
) -> DataFrame:
    """A stream of payloads as ``value, ts``, from any streaming source.

    ``time`` is the publish time the source gives; it is cast to ``timestamp``,
    since a watermark does not take a zone-less one. Payloads are read as text
    unless ``binary`` is set. With ``attributes``, the source's map or list of
    message headers, a third column ``attributes`` has them as pairs of text.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    payload = F.col(value) if isinstance(value, str) else value
    published = F.col(time) if isinstance(time, str) else time
    loaded = reader.load()
    carried = [] if attributes is None else [attribute_pairs(loaded, attributes).alias(ATTRIBUTES)]
    return loaded.select(
        payload.cast("binary" if binary else "string").alias("value"),
        published.cast("timestamp").alias("ts"),
        *carried,
    )


def attribute_pairs(df: DataFrame, attributes: str | Column) -> Column:
    """Message headers as ``array<struct<key, value>>`` of text; null headers give no pairs.

    They may be a map, or an array of structs whose first two fields are key and value.
    """
    column = F.col(attributes) if isinstance(attributes, str) else attributes
    kind = df.select(column.alias("a")).schema["a"].dataType
    if isinstance(kind, T.MapType):
        column, names = F.map_entries(column), ["key", "value"]
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and len(kind.elementType) > 1:
        names = kind.elementType.names[:2]
    else:
        raise ValueError(f"attributes must be a map or an array of pairs, not {kind.simpleString()}")
    pairs = F.transform(column, lambda e: F.struct(*[e[n].cast("string").alias(k) for n, k in zip(names, ("key", "value"))]))
    return F.coalesce(pairs, F.array()).cast(DEAD_LETTER[ATTRIBUTES].dataType)


def load_avro_schema(spark: SparkSession, path: str) -> str:
    """The text of a schema file; the path must match exactly one file."""
    found = hadoop.glob(spark, path)
    if not found:
        raise ValueError(f"no file matches {path}")
    if len(found) != 1:
        raise ValueError(f"expected exactly 1 file, but {path} matches {len(found)}")
    return spark.read.text(found[0], wholetext=True).first()["value"]


def decode_messages(
    df: DataFrame, avro_schema: str, codec: str = JSON, value: str = "value"
) -> DataFrame:
    """Add the decoded ``record`` and the flag ``_bad`` for payloads that do not decode.

    The codec is ``json``, or ``avro`` where the session has Spark's Avro module; without
    it Spark refuses the plan. A damaged Avro payload gives a record of nulls, as an empty
    one may, so the reader schema has one more field, which is true by default: it is null
    only where nothing was decoded.
    """
    struct = avro_to_struct(avro_schema)
    if codec == AVRO:
        reader, marker = marked_schema(avro_schema)
        decoded = from_avro(F.col(value), avro_schema, {"mode": "PERMISSIVE", "avroSchema": reader})
        whole = F.coalesce(F.col(RECORD)[marker], F.lit(False))
        record = F.when(whole, F.struct(*[F.col(RECORD)[f.name].alias(f.name) for f in struct.fields]))
        return df.withColumn(RECORD, decoded).withColumns({RECORD: record, BAD: ~whole})
    if codec != JSON:
        raise ValueError(f"codec must be {JSON} or {AVRO}, not {codec}")
    corrupt = "_corrupt_payload"
    wide = T.StructType([*struct.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = df.withColumn(RECORD, F.from_json(F.col(value).cast("string"), wide, options))
    # Alone in an array and in an object, a payload must be one whole value: no text may follow it.
    text = F.col(value).cast("string")
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    inside = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]
    bad = (
        F.col(RECORD).isNull()
        | F.col(RECORD)[corrupt].isNotNull()
        | (F.coalesce(F.size(alone), F.lit(-1)) != 1)
        | inside.isNull()
        | _lacks_required(F.col(RECORD), struct)
    )
    return parsed.withColumn(BAD, bad).withColumn(RECORD, _with_defaults(F.col(RECORD), struct))


def marked_schema(avro_schema: str) -> tuple[str, str]:
    """The record schema with a boolean field that is true by default, and that field's name."""
    parsed = json.loads(avro_schema)
    taken = {f["name"] for f in parsed["fields"]}
    marker = "decoded"
    while marker in taken:
        marker = f"_{marker}"
    field = {"name": marker, "type": "boolean", "default": True}
    return json.dumps({**parsed, "fields": [*parsed["fields"], field]}), marker


def _lacks_required(record: Column, struct: T.StructType) -> Column:
    """Whether a required field of the record, or of a record in it, is null."""
    lacks = F.lit(False)
    for f in struct.fields:
        if f.metadata.get("required"):
            lacks = lacks | record[f.name].isNull()
        if isinstance(f.dataType, T.StructType):
            lacks = lacks | (record[f.name].isNotNull() & _lacks_required(record[f.name], f.dataType))
    return lacks


def _with_defaults(record: Column, struct: T.StructType) -> Column:
    """Fields that are not in the payload take the default of the schema."""
    fields = []
    for f in struct.fields:
        item = record[f.name]
        if isinstance(f.dataType, T.StructType):
            item = F.when(item.isNotNull(), _with_defaults(item, f.dataType))
        elif "default" in f.metadata:
            item = F.coalesce(item, F.lit(f.metadata["default"]).cast(f.dataType))
        fields.append(item.alias(f.name))
    return F.struct(*fields)


def read_typed_messages(
    spark: SparkSession,
    fmt: str,
    avro_schema: str,
    options: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
    codec: str = JSON,
    value: str | Column = "value",
    time: str | Column = "timestamp",
    attributes: str | Column | None = None,
) -> DataFrame:
    """A stream of payloads decoded by a record schema: ``value, ts, record, _bad``, and
    ``attributes`` before ``record`` where asked for."""
    raw = read_messages(spark, fmt, options, schema, value, time, codec == AVRO, attributes)
    return decode_messages(raw, avro_schema, codec)
