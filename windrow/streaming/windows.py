"""Fixed event-time windows, fired once when the watermark passes their end."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.skew import COPY, number_copies

WINDOW_LENGTH = "1 minute"

# Units of the short form of a window length.
UNITS = {"s": "seconds", "m": "minutes", "h": "hours"}


def window_length(text: str) -> str:
    """Spark's form of a window length; also takes ``5s``, ``12m`` and ``2h``."""
    short = re.fullmatch("([1-9][0-9]*)([smh])", text)
    return f"{short[1]} {UNITS[short[2]]}" if short else text


def tumbling_window(df: DataFrame, length: str = WINDOW_LENGTH, time: str = "ts") -> DataFrame:
    """Add the fixed ``window`` each row's event time falls in."""
    ts = F.col(time).cast("timestamp")
    return df.withColumn("window", F.window(ts, window_length(length)))


def finalize_window(
    df: DataFrame, length: str = WINDOW_LENGTH, delay: str = "0 seconds"
) -> DataFrame:
    """``value, ts, window`` rows of finished windows, each once; late rows are dropped.

    The state has one entry per distinct row of the open windows, with its number
    of copies. So it spreads over all tasks however full one window is, no list
    is built or rewritten, and copies are combined before the shuffle. The
    column ``_copy`` numbers equal rows.
    """
    timed = df.select("value", F.col("ts").cast("timestamp").alias("ts"))
    # The time goes into the state as a number, so that the window is the only event time.
    windowed = timed.withWatermark("ts", delay).select(
        "value",
        F.unix_micros("ts").alias("_at"),
        F.window("ts", window_length(length)).alias("window"),
    )
    time = F.timestamp_micros("_at").alias("ts")
    return number_copies(windowed).select("value", time, "window", COPY)
