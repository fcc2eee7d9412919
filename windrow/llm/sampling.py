"""Bounded samples of labelled rows for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(divisor))


def excerpt(text: Column, chars: int) -> Column:
    """At most ``chars`` characters from a place that depends on the text alone."""
    room = F.greatest(F.char_length(text) - chars + 1, F.lit(1))
    return F.substring(text, (1 + F.pmod(F.xxhash64(text), room)).cast("int"), F.lit(chars))


def sample_by_label(rows: DataFrame, label: str, per_label: int, total: int) -> DataFrame:
    """About ``per_label`` rows of each value of ``label``, ``total`` at most, chosen by a hash of
    ``doc_id``; the same rows in every run. ``rows`` has ``doc_id``; null labels are left out. Labels
    are the classes of a model, a few: their counts, one row each, are broadcast, so no label's rows
    meet in one task."""
    rows = rows.where(F.col(label).isNotNull())
    sizes = rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_size"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    near = rows.join(F.broadcast(sizes), F.col(label) == F.col("_label")).where(place * F.col("_size") < per_label)
    return near.drop("_label", "_size").orderBy(F.xxhash64("doc_id"), label).limit(total)
