"""The four jobs from the command line: ``python -m windrow <job> ...`` or spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from windrow.plans import match_batsman_runs, messages_to_window_files, records_to_window_files
from windrow.plans.batch import outs_lines
from windrow.plans.streams import await_all
from windrow.session import build_session
from windrow.sinks import append_table, names, write_single_text, write_windowed_partitions
from windrow.sources import (
    dead_letter_files,
    dead_letter_messages,
    load_avro_schema,
    read_lines,
    read_messages,
    read_typed_messages,
)
from windrow.streaming.windows import WINDOW_LENGTH


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="windrow")
    jobs = parser.add_subparsers(dest="job", required=True)

    outs = jobs.add_parser("outs", help="wickets per player and kind, to one text file")
    outs.add_argument("--input-file", required=True)
    outs.add_argument("--output-file", required=True)
    outs.add_argument("--output-parts", action="store_true", help="leave numbered parts")
    outs.add_argument("--skip-header", metavar="TEXT", help="leave out lines of this text")

    runs = jobs.add_parser("match-runs", help="runs per match and batsman, appended to a table")
    runs.add_argument("--deliveries", required=True)
    runs.add_argument("--matches", required=True)
    runs.add_argument("--table", required=True)
    runs.add_argument("--table-format", default="parquet")
    runs.add_argument("--on-violation", choices=["error", "drop"], default="error")
    runs.add_argument("--include-match", action="store_true")
    runs.add_argument("--skip-header", metavar="TEXT", help="leave out lines of this text")

    messages = jobs.add_parser("messages", help="text messages to files per window")
    records = jobs.add_parser("records", help="decoded records to files per window")
    for stream in (messages, records):
        stream.add_argument("--input-format", required=True, help="a streaming source")
        stream.add_argument("--input-option", action="append", default=[], metavar="NAME=VALUE")
        stream.add_argument("--input-schema", help="for file sources")
        stream.add_argument("--value-column", default="value")
        stream.add_argument("--time-column", default="timestamp")
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--output-directory", required=True)
        stream.add_argument("--user-temp-location")
        stream.add_argument("--output-filename-prefix", default=names.PREFIX)
        stream.add_argument("--output-filename-suffix", default=names.SUFFIX)
        stream.add_argument("--output-shard-template", default=names.SHARD_TEMPLATE)
        stream.add_argument("--num-shards", type=int, default=1, help="0 lets the rows decide")
        stream.add_argument("--window-duration", default=WINDOW_LENGTH)
        stream.add_argument("--allowed-delay", default="0 seconds")
        stream.add_argument("--year-pattern", default=names.YEAR)
        stream.add_argument("--month-pattern", default=names.MONTH)
        stream.add_argument("--day-pattern", default=names.DAY)
        stream.add_argument("--hour-pattern", default=names.HOUR)
        stream.add_argument("--minute-pattern", default=names.MINUTE)
        stream.add_argument(
            "--layout", choices=["names", "hive"], default="names", help="hive: a folder per window"
        )
        stream.add_argument(
            "--per-batch", action="store_true", help="write each batch at once, keep no windows open"
        )
        stream.add_argument("--available-now", action="store_true", help="stop when caught up")
    records.add_argument("--schema-path", required=True)
    records.add_argument("--codec", choices=["json", "avro"], default="json")
    records.add_argument("--dead-letter-path", help="a folder; without it a sink that needs none")
    records.add_argument("--dead-letter-format", default="parquet")
    records.add_argument("--dead-letter-option", action="append", default=[], metavar="NAME=VALUE")
    records.add_argument("--attributes-column", help="message headers, kept in dead letters")
    return parser


def _source(args: argparse.Namespace) -> dict:
    return {
        "options": dict(option.split("=", 1) for option in args.input_option),
        "schema": args.input_schema,
        "value": args.value_column,
        "time": args.time_column,
    }


def _dead_letters(args: argparse.Namespace):
    options = dict(option.split("=", 1) for option in args.dead_letter_option)
    if args.dead_letter_path:
        return dead_letter_files(args.dead_letter_path, args.dead_letter_format, options)
    return dead_letter_messages(args.dead_letter_format, options)


def _stream_settings(args: argparse.Namespace) -> dict:
    settings = {
        "length": args.window_duration,
        "delay": args.allowed_delay,
        "trigger": {"availableNow": True} if args.available_now else None,
        "finalize": not args.per_batch,
        "num_shards": args.num_shards or None,
    }
    if args.layout == "hive":
        return {**settings, "writer": write_windowed_partitions}
    return {
        **settings,
        "prefix": args.output_filename_prefix,
        "suffix": args.output_filename_suffix,
        "template": args.output_shard_template,
        "year": args.year_pattern,
        "month": args.month_pattern,
        "day": args.day_pattern,
        "hour": args.hour_pattern,
        "minute": args.minute_pattern,
        "temp_dir": args.user_temp_location,
    }


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    """Run one job to its end; a stream ends only with ``--available-now``."""
    args = _parser().parse_args(argv)
    if args.job == "outs":
        lines = read_lines(spark, args.input_file, skip_header=args.skip_header)
        files = "parts" if args.output_parts else "one"
        write_single_text(outs_lines(lines), args.output_file, files=files)
    elif args.job == "match-runs":
        rows = match_batsman_runs(
            read_lines(spark, args.deliveries, skip_header=args.skip_header),
            read_lines(spark, args.matches, skip_header=args.skip_header),
            args.on_violation,
            args.include_match,
        )
        append_table(rows, args.table, args.table_format)
    elif args.job == "messages":
        messages = read_messages(spark, args.input_format, **_source(args))
        messages_to_window_files(
            messages, args.output_directory, args.checkpoint, **_stream_settings(args)
        ).awaitTermination()
    else:
        record = load_avro_schema(spark, args.schema_path)
        decoded = read_typed_messages(
            spark,
            args.input_format,
            record,
            codec=args.codec,
            attributes=args.attributes_column,
            **_source(args),
        )
        await_all(
            records_to_window_files(
                decoded,
                args.output_directory,
                args.checkpoint,
                _dead_letters(args),
                **_stream_settings(args),
            )
        )


if __name__ == "__main__":
    run(build_session("windrow"))
