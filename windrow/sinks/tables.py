"""Tables and record files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_table(
    df: DataFrame, table: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> None:
    """Append records to a table, creating it from the record schema when missing."""
    df.write.format(fmt).mode("append").options(**(options or {})).saveAsTable(table)


def write_avro_file(df: DataFrame, path: str) -> None:
    """Records to Avro files; needs Spark's Avro module on the class path."""
    df.write.format("avro").save(path)
