"""Text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession, path: str | list[str], skip_header: str | None = None
) -> DataFrame:
    """Text files to one ``value`` per line, blank lines kept.

    A header line is data like any other, unless its text is given to skip it.
    """
    lines = spark.read.text(path)
    return lines if skip_header is None else lines.where(F.col("value") != skip_header)
