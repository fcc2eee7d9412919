"""Text files per event-time window.

Rows carry only two numbers for their window and one for their shard. They are
shuffled once, so that each file is written by one task, into a staging folder;
then a journalled commit renames the files. Directories and names are computed
from the list of files written, not per row.

``write_windowed_partitions`` has another layout, for stores where a rename is a
copy: a folder per window, replaced by Spark's own dynamic partition overwrite.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from windrow import hadoop
from windrow.operators.skew import (
    COPY,
    SLICES,
    heavy_keys,
    number_copies,
    slice_of,
    spread,
    with_slices,
)
from windrow.session import require_utc
from windrow.sinks import commits, names

# Rows per file where the rows decide on the number of shards.
ROWS_PER_SHARD = 5_000_000

FILE = "_file"
COMMIT_IN_TASKS = "mapreduce.fileoutputcommitter.algorithm.version"


def shard_lines(
    df: DataFrame, num_shards: int | None = 1, rows_per_shard: int | None = None
) -> DataFrame:
    """Add ``shard`` and ``shards`` to ``value, ts, window`` rows.

    Each window has exactly ``num_shards`` shards, whatever its size. Only where
    ``rows_per_shard`` is given too, or ``num_shards`` is None (then by
    ``ROWS_PER_SHARD`` rows), a window gets as many shards as its rows need.

    Copies of a row spread over the shards like other rows, by the ``_copy``
    number of finished stream windows or else by one given here.
    """
    if num_shards is None and rows_per_shard is None:
        rows_per_shard = ROWS_PER_SHARD
    shards = 1 if num_shards is None else num_shards
    if shards < 1:
        raise ValueError("num_shards must be at least 1")
    heavy = None
    if rows_per_shard is not None:
        heavy = heavy_keys(df, ["window"], rows_per_shard * shards, rows_per_shard)
    if heavy is None and shards == 1:
        return df.withColumns({"shard": F.lit(0), "shards": F.lit(1)})
    rows = df if COPY in df.columns else number_copies(df)
    wanted = F.lit(shards)
    if heavy is not None:
        rows = with_slices(rows, ["window"], heavy)
        wanted = F.greatest(wanted, F.col(SLICES))
    placed = rows.withColumn("shards", wanted)
    place = slice_of(["ts", "value", COPY], F.col("shards"))
    return placed.select(*df.columns, place.alias("shard"), "shards")


def write_windowed_text(
    df: DataFrame,
    directory: str,
    prefix: str | None = names.PREFIX,
    suffix: str | None = names.SUFFIX,
    template: str | None = names.SHARD_TEMPLATE,
    num_shards: int | None = 1,
    year: str | None = names.YEAR,
    month: str | None = names.MONTH,
    day: str | None = names.DAY,
    hour: str | None = names.HOUR,
    minute: str | None = names.MINUTE,
    temp_dir: str | None = None,
    rows_per_shard: int | None = None,
    run_label: str | None = None,
    pane: str = names.PANE,
) -> list[str]:
    """Write ``value`` lines of windowed rows to files named by window and shard.

    The directory may hold date patterns, filled in from the window end. A file
    is a function of window and shard, and a window written again loses the files
    that it no longer has, so writing a batch again replaces it whole. ``run_label``
    names the staging folder, so that a run repeated after a crash clears what the
    first one left. A commit that broke off is finished by the next write with the
    same settings; until then its staged files stay. Returns the paths.

    ``pane`` fills the template's P. Files of different panes do not replace each
    other, so another pane than the default needs a P in the template.

    For the number of files per window see ``shard_lines``.
    """
    if pane != names.PANE and "P" not in (template or ""):
        raise ValueError(f"the template {template!r} has no P to tell the pane {pane} from others")

    def path(start: Column, end: Column, shard: Column, shards: Column) -> Column:
        folder = names.resolve_date_dirs(directory, end, year, month, day, hour, minute)
        file = names.windowed_filename(start, end, shard, shards, prefix, template, suffix, pane)
        return F.concat(folder, file)

    patterns = [
        year or names.FALLBACK_YEAR,
        month or names.FALLBACK_MONTH,
        day or names.FALLBACK_DAY,
        hour or names.FALLBACK_HOUR,
        minute or names.FALLBACK_MINUTE,
    ]
    staging = temp_dir or _fixed_part(directory, patterns)
    output = repr((directory, prefix, suffix, template, patterns))
    return _write(df, path, staging, num_shards, rows_per_shard, run_label, output, pane=pane)


def _fixed_part(directory: str, patterns: list[str]) -> str:
    """The folders above the first one that holds a date pattern, or the whole directory
    where there are none."""
    fixed = []
    for part in directory.rstrip("/").split("/"):
        if any(p in part for p in patterns):
            break
        fixed.append(part)
    above = "/".join(fixed)
    return above if above and not above.endswith((":", ":/")) else directory


def write_one_file_per_window(
    df: DataFrame,
    prefix: str,
    num_shards: int | None = None,
    suffix: str = "",
    legacy_names: bool = False,
    time_format: str | None = None,
    rows_per_shard: int | None = None,
    run_label: str | None = None,
) -> list[str]:
    """Write windowed rows to ``prefix-HH:mm-HH:mm-shard-of-n`` beside the prefix.

    A prefix that ends in a slash is a folder and adds no text to the name. As
    the names hold times of day only, a folder per window-start day is put above
    them; ``legacy_names`` leaves that out and fails when two windows, or a
    window and an older file, meet in one name. Where the store refuses a colon
    the times are written ``HHmm``, unless a ``time_format`` is given.
    """
    folder, _, base = prefix.rpartition("/")
    folder = folder or "."
    if time_format is None:
        time_format = "HH:mm" if hadoop.takes_colon(df.sparkSession, folder) else "HHmm"

    def path(start: Column, end: Column, shard: Column, shards: Column) -> Column:
        file = names.hour_minute_filename(start, end, shard, shards, base, suffix, time_format)
        days = [] if legacy_names else [F.date_format(start, "yyyy-MM-dd"), F.lit("/")]
        return F.concat(F.lit(folder + "/"), *days, file)

    output = repr((prefix, suffix, legacy_names, time_format))
    return _write(
        df, path, folder, num_shards, rows_per_shard, run_label, output, replace=not legacy_names
    )


def write_windowed_partitions(
    df: DataFrame,
    directory: str,
    num_shards: int | None = 1,
    rows_per_shard: int | None = None,
    run_label: str | None = None,
) -> None:
    """Write ``value`` lines to ``day=<end day>/window=<start>-<end>/part-*`` below a directory.

    The folders of the windows in ``df`` are replaced as a whole by Spark's dynamic
    partition overwrite, so a window written again keeps no older file, and folders of
    other windows stay. A window has at most as many files as shards. There is no
    staging of this library's own and no list of files on the driver, so ``run_label`` has no use here.
    """
    _require_windows(df)
    needed = [c for c in ("value", "ts", "window", COPY) if c in df.columns]
    sharded = shard_lines(df.select(*needed), num_shards, rows_per_shard)
    start, end = F.col("window.start"), F.col("window.end")
    placed = spread(sharded, "window.start", "window.end", "shard").select(
        "value",
        F.date_format(end, "yyyy-MM-dd").alias("day"),
        names.window_text(start, end).alias("window"),
    )
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "window").text(directory)


def _require_windows(df: DataFrame) -> None:
    if "window" not in df.columns:
        raise ValueError("rows have no window; only windowed rows can be written per window")
    require_utc(df.sparkSession)


def _write(
    df: DataFrame,
    path: Callable[[Column, Column, Column, Column], Column],
    base: str,
    num_shards: int | None,
    rows_per_shard: int | None,
    run_label: str | None,
    output: str,
    replace: bool = True,
    pane: str = names.PANE,
) -> list[str]:
    _require_windows(df)
    spark = df.sparkSession
    # Fails on a bad pattern or template before any work is done.
    path(F.current_timestamp(), F.current_timestamp(), F.lit(0), F.lit(1))

    # Writers with other settings have other folders, so they may write at the same time.
    output = hashlib.sha256(output.encode()).hexdigest()[:16]
    staging_set = hadoop.join(base, commits.STAGING, output)
    commits.finish_all(spark, staging_set)
    staging = hadoop.join(staging_set, run_label or uuid.uuid4().hex)
    hadoop.delete(spark, staging)
    needed = [c for c in ("value", "ts", "window", COPY) if c in df.columns]
    sharded = shard_lines(df.select(*needed), num_shards, rows_per_shard)
    file = F.concat_ws(
        "_",
        F.unix_micros(F.col("window.start")),
        F.unix_micros(F.col("window.end")),
        "shard",
        "shards",
    )
    rows = sharded.select("value", file.alias(FILE))
    # Tasks commit straight into staging; the journalled renames are the real commit.
    writer = spread(rows, FILE).write.option(COMMIT_IN_TASKS, "2")
    try:
        writer.partitionBy(FILE).text(staging)
        moves = _targets(spark, hadoop.glob_below(spark, staging, f"{FILE}=*/part-*"), path)
        if not replace:
            _refuse_existing(spark, [row["target"] for row in moves])
        manifests = hadoop.join(base, commits.MANIFESTS, output, pane)
        windows = commits.by_manifest(
            manifests, [(row["day"], row["window"], row["target"]) for row in moves]
        )
        commits.decide(spark, staging, [(row["staged"], row["target"]) for row in moves], windows)
    except Exception:
        hadoop.delete(spark, staging)
        raise
    commits.finish(spark, staging)
    return sorted(row["target"] for row in moves)


def _targets(
    spark: SparkSession,
    staged: list[str],
    path: Callable[[Column, Column, Column, Column], Column],
) -> list[Row]:
    """Final path, day and window of staged files, one row per file; two files may not share a path."""
    if not staged:
        return []
    found = [(s, *map(int, s.split(f"{FILE}=")[1].split("/")[0].split("_"))) for s in staged]
    schema = "staged string, start long, end long, shard int, shards int"
    start, end = F.timestamp_micros("start"), F.timestamp_micros("end")
    moves = (
        spark.createDataFrame(found, schema)
        .select(
            "staged",
            path(start, end, F.col("shard"), F.col("shards")).alias("target"),
            F.date_format(start, "yyyy-MM-dd").alias("day"),
            F.concat_ws("_", "start", "end").alias("window"),
        )
        .collect()
    )
    taken: dict[str, str] = {}
    for row in moves:
        if taken.setdefault(row["target"], row["staged"]) != row["staged"]:
            raise ValueError(f"two windows or shards share the file {row['target']}")
    return moves


def _refuse_existing(spark: SparkSession, targets: list[str]) -> None:
    for target in targets:
        if hadoop.exists(spark, target):
            raise ValueError(f"the file {target} exists already")
