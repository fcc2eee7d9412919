"""File names and date directories of windowed text files.

All are column expressions. The sinks evaluate them once per file, not per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.functions.scalars import pad_number

# Option defaults of the five date patterns.
YEAR = "yyyy"
MONTH = "MM"
DAY = "dd"
HOUR = "HH"
MINUTE = "mm"

# Patterns used when an option is null or empty. DD is the day of the year.
FALLBACK_YEAR = "YYYY"
FALLBACK_MONTH = "MM"
FALLBACK_DAY = "DD"
FALLBACK_HOUR = "HH"
FALLBACK_MINUTE = "mm"

# Default shard template, S shard number, N number of shards, W window, P pane.
SHARD_TEMPLATE = "W-P-SS-of-NN"
PREFIX = "output"
SUFFIX = ""

# A window is written once, by its first and last firing.
PANE = "pane-0-last"
WINDOW_TIME = "yyyyMMdd'T'HHmmss'Z'"


def _letters(user_pattern: str, accepted: str, part: str) -> str:
    found = re.search(accepted, user_pattern)
    if not found:
        raise ValueError(f"the {part} pattern {user_pattern!r} has none of the letters {accepted}")
    return found.group()


def _year(time: Column, letters: str) -> Column:
    if len(letters) == 2:
        return F.date_format(time, "yy")
    return pad_number(F.year(time), len(letters))


def _month(time: Column, letters: str) -> Column:
    if len(letters) > 2:
        return F.date_format(time, "MMM" if len(letters) == 3 else "MMMM")
    return pad_number(F.month(time), len(letters))


def _day(time: Column, letters: str) -> Column:
    number = F.dayofyear(time) if letters[0] == "D" else F.dayofmonth(time)
    return pad_number(number, len(letters))


def resolve_date_dirs(
    directory: str,
    time: Column,
    year: str | None = YEAR,
    month: str | None = MONTH,
    day: str | None = DAY,
    hour: str | None = HOUR,
    minute: str | None = MINUTE,
) -> Column:
    """The directory with the five date patterns filled in from a time (the window end).

    Each pattern is replaced as a whole, wrapper characters included, and at
    every place it occurs in the path. Patterns are checked when the plan is
    built.
    """
    if not directory:
        raise ValueError("an output directory is required")
    year = year or FALLBACK_YEAR
    month = month or FALLBACK_MONTH
    day = day or FALLBACK_DAY
    hour = hour or FALLBACK_HOUR
    minute = minute or FALLBACK_MINUTE
    parts = [
        (year, _year(time, _letters(year, "y+|Y+", "year"))),
        (month, _month(time, _letters(month, "M+", "month"))),
        (day, _day(time, _letters(day, "D+|d+", "day"))),
        (hour, pad_number(F.hour(time), len(_letters(hour, "H+", "hour")))),
        (minute, pad_number(F.minute(time), len(_letters(minute, "m+", "minute")))),
    ]
    path = F.lit(directory if directory.endswith("/") else directory + "/")
    for pattern, text in parts:
        path = F.replace(path, F.lit(pattern), text)
    return path


def window_text(start: Column, end: Column) -> Column:
    """The window as ``start-end`` in a file name."""
    return F.concat_ws("-", F.date_format(start, WINDOW_TIME), F.date_format(end, WINDOW_TIME))


def windowed_filename(
    start: Column,
    end: Column,
    shard: Column,
    shards: Column,
    prefix: str | None = PREFIX,
    template: str | None = SHARD_TEMPLATE,
    suffix: str | None = SUFFIX,
    pane: str = PANE,
) -> Column:
    """Prefix, filled-in shard template and suffix; missing parts are empty."""
    window = window_text(start, end)
    pieces = [F.lit(prefix or "")]
    for run in re.findall("S+|N+|W|P|[^SNWP]+", template or ""):
        if run[0] == "S":
            pieces.append(pad_number(shard, len(run)))
        elif run[0] == "N":
            pieces.append(pad_number(shards, len(run)))
        elif run == "W":
            pieces.append(window)
        else:
            pieces.append(F.lit(pane if run == "P" else run))
    return F.concat(*pieces, F.lit(suffix or ""))


def hour_minute_filename(
    start: Column,
    end: Column,
    shard: Column,
    shards: Column,
    prefix: str = "",
    suffix: str = "",
    time_format: str = "HH:mm",
) -> Column:
    """``prefix-start-end-shard-of-shards`` with times of day only."""
    return F.format_string(
        "%s-%s-%s-%d-of-%d%s",
        F.lit(prefix),
        F.date_format(start, time_format),
        F.date_format(end, time_format),
        shard,
        shards,
        F.lit(suffix),
    )
