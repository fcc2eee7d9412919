"""

Delivery lines are made from ``lineitem``, match lines from ``orders`` and
messages from ``events``. Each query runs over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import hadoop
from windrow.functions import (
    cogroup_fn,
    composite,
    flat_map_fn,
    group_batches_fn,
    group_fn,
    map_fn,
    predicate_fn,
)
from windrow.operators import (
    attach_nested,
    cogroup,
    count_by_key,
    decode_key,
    filter_flag,
    format_line,
    group_by_key,
    key_by,
    key_match_batsman,
    key_player_kind,
    lookup_join_strict,
    parse_delivery,
    parse_match,
    records_to_rows,
    row_to_delimited,
    split_fields,
    sum_by_key,
    sum_runs_by_match_batsman,
    to_flat_record,
    to_nested_record,
)
from windrow.plans import (
    match_batsman_runs,
    messages_to_window_files,
    outs_by_player_and_kind,
    records_to_window_files,
)
from windrow.plans.batch import joined_match_runs, match_lines
from windrow.plans.streams import await_all
from windrow.schemas import DELIVERY, MATCH
from windrow.session import scratch_dir
from windrow.sinks import (
    append_table,
    resolve_date_dirs,
    windowed_filename,
    write_one_file_per_window,
    write_single_text,
    write_windowed_partitions,
    write_windowed_text,
)
from windrow.sinks.names import hour_minute_filename
from windrow.sinks.windowed import shard_lines
from windrow.sources import (
    dead_letter_files,
    decode_messages,
    read_dead_letters,
    read_lines,
    read_messages,
    read_typed_messages,
    route_dead_letters,
)
from windrow.sources.messages import BAD
from windrow.streaming import finalize_window, tumbling_window

# The corpus operators, or a package that they need, may be left out of a copy of this library.
try:
    import corpus_pipeline

    from windrow.llm import queries as corpus_queries
except ModuleNotFoundError:
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Date patterns in braces, so that letters elsewhere in a scratch path stay as they are.
DATE_DIRS = "{yyyy}/{MM}/{dd}/"
WRAPPED = {"year": "{yyyy}", "month": "{MM}", "day": "{dd}", "hour": "{HH}", "minute": "{mm}"}

EVENT_RECORD = """
{"type": "record", "name": "Event", "fields": [
  {"name": "event_id", "type": "long"},
  {"name": "user_id", "type": "long"},
  {"name": "event_type", "type": ["null", "string"]},
  {"name": "note", "type": ["null", "string"], "default": null},
  {"name": "retries", "type": "int", "default": 0}
]}
"""


# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(rows: DataFrame, line: Column) -> DataFrame:
    """One line per row. The one-element explode keeps the optimizer from copying the
    whole concatenation into every use of the line, as no text file would have it."""
    return rows.select(F.explode(F.array(line)).alias("value"))


def _delivery_fields() -> list[Column]:
    runs, extra = F.col("l_quantity").cast("int"), F.col("l_linenumber") % 2
    wicket = F.col("l_returnflag") == "R"
    return [
        F.col("l_orderkey"),
        F.lit(1) + F.col("l_linenumber") % 2,
        F.col("l_partkey") % 20,
        F.col("l_linenumber"),
        F.col("l_suppkey"),
        F.col("l_partkey"),
        F.concat(F.lit("B"), F.col("l_partkey") % 11),
        runs,
        extra,
        runs + extra,
        F.lit(0),
        F.when(wicket, "1").otherwise("0"),
        F.col("l_linestatus"),
        F.when(wicket, F.col("l_suppkey").cast("string")).otherwise("NA"),
        F.lit("NA"),
        F.col("l_returnflag"),
        F.concat(F.lit("T"), F.col("l_suppkey") % 8),
        F.concat(F.lit("T"), F.col("l_partkey") % 8),
    ]


def delivery_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    return _lines(items, F.concat_ws(",", *_delivery_fields()))


def match_input_lines(spark: SparkSession, sf_dir: str, cut_short: bool = False) -> DataFrame:
    """Match lines; with ``cut_short`` those of pending orders lack their last field."""
    orders = _table(spark, sf_dir, "orders")
    head = [
        F.col("o_orderkey"),
        F.col("o_orderpriority"),
        F.date_format("o_orderdate", "MM/dd/yy"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        F.lit(0),
        F.concat(F.lit("T"), F.col("o_custkey") % 8),
        F.concat(F.lit("T"), F.col("o_orderkey") % 8),
        F.concat(F.lit("T"), F.col("o_custkey") % 8),
        F.lit("bat"),
        F.concat(F.lit("T"), F.col("o_orderkey") % 8),
        F.lit("runs"),
        F.coalesce(F.nullif(F.col("o_custkey") % 9, F.lit(0)).cast("string"), F.lit("NA")),
        F.lit("N"),
        F.lit("NA"),
        F.concat(F.lit("U"), F.col("o_custkey") % 5),
    ]
    last = F.concat(F.lit("U"), F.col("o_orderkey") % 5)
    if cut_short:
        last = F.when(F.col("o_orderstatus") == "P", "").otherwise(last)
    return _lines(orders, F.concat_ws(",", *head, last))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select(F.col("props").alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON payloads; those of error events do not parse."""
    events = _table(spark, sf_dir, "events")
    payload = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.concat(F.lit("#"), payload)
    value = F.when(F.col("event_type") == "error", broken).otherwise(payload)
    return events.select(value.alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def with_closing_row(rows: DataFrame, payload: str = "") -> DataFrame:
    """Append one message a day after the last, so that every real window ends."""
    last = rows.agg(F.max("ts").alias("ts"))
    closing = last.select(F.lit(payload).alias("value"), F.expr("ts + INTERVAL 1 DAY").alias("ts"))
    return rows.unionByName(closing)


def _read_back(spark: SparkSession, directory: str) -> DataFrame:
    """Lines below a folder with the path of their file inside it."""
    lines = spark.read.option("recursiveFileLookup", True).text(directory)
    file = F.url_decode(F.substring_index("_metadata.file_path", directory.rstrip("/") + "/", -1))
    return lines.select(file.alias("path"), "value")


# ---------------------------------------------------------------- sources


def q_read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = hadoop.join(scratch_dir(spark, "lines"), "text")
    delivery_lines(spark, sf_dir).write.text(path)
    return read_lines(spark, path)


def q_read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "messages")
    source, sink = hadoop.join(base, "in"), hadoop.join(base, "out")
    messages(spark, sf_dir).write.parquet(source)
    stream = read_messages(
        spark, "parquet", {"path": source}, "value string, ts timestamp", time="ts"
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", hadoop.join(base, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    back = spark.read.parquet(sink)
    return back.select("value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


def q_read_typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed stream, run to its end; its good records read back."""
    base = scratch_dir(spark, "typed")
    source, sink = hadoop.join(base, "in"), hadoop.join(base, "out")
    typed_messages(spark, sf_dir).write.parquet(source)
    stream = read_typed_messages(
        spark, "parquet", EVENT_RECORD, {"path": source}, "value string, ts timestamp", time="ts"
    )
    rows = records_to_rows(stream.where(~F.col(BAD)))
    query = (
        rows.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", hadoop.join(base, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(sink)


def q_route_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters written as a batch that runs twice; each is there once."""
    path = scratch_dir(spark, "letters")
    good, bad = route_dead_letters(decode_messages(typed_messages(spark, sf_dir), EVENT_RECORD))
    write = dead_letter_files(path)
    for _ in range(2):
        write(bad, 0)
    kept = good.select(F.lit("good").alias("side"), F.col("value").alias("payload"))
    letters = read_dead_letters(spark, path)
    dead = letters.select(F.lit("dead").alias("side"), F.col("payloadString").alias("payload"))
    return kept.unionByName(dead).select("side", "payload", F.length("payload").alias("n_chars"))


def q_dead_letter_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed stream with message headers; bad payloads keep theirs in the dead letter."""
    base = scratch_dir(spark, "attributes")
    source, dead = hadoop.join(base, "in"), hadoop.join(base, "dead")
    events = _table(spark, sf_dir, "events")
    payload = F.concat(F.when(F.col("event_type") == "error", "#").otherwise(""), F.to_json(F.struct("event_id", "user_id")))
    headers = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"))
    stamped = events.select(payload.alias("value"), F.col("ts").cast("timestamp").alias("ts"), headers.alias("headers"))
    stamped.write.parquet(source)
    stream = read_typed_messages(
        spark,
        "parquet",
        EVENT_RECORD,
        {"path": source},
        "value string, ts timestamp, headers map<string,string>",
        time="ts",
        attributes="headers",
    )
    query = (
        route_dead_letters(stream)[1]
        .writeStream.option("checkpointLocation", hadoop.join(base, "checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(dead_letter_files(dead))
        .start()
    )
    query.awaitTermination()
    pairs = F.transform("attributes", lambda a: F.concat_ws("=", a["key"], a["value"]))
    return read_dead_letters(spark, dead).select(
        F.col("payloadString").alias("payload"), F.array_join(F.array_sort(pairs), ",").alias("attributes")
    )


# ---------------------------------------------------------------- shaping


def q_split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = match_input_lines(spark, sf_dir, cut_short=True)
    return split_fields(lines).select(
        F.size("cols").cast("int").alias("n_fields"),
        F.element_at("cols", 1).alias("first_field"),
        F.element_at("cols", -1).alias("last_field"),
    )


def q_parse_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_delivery(delivery_lines(spark, sf_dir))


def q_parse_match_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_match(match_input_lines(spark, sf_dir, cut_short=True))


def q_parse_match_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_match(match_input_lines(spark, sf_dir), extras=True)
    day = F.date_format("match_date", "MM/dd/yy")
    return rows.select("id", day.alias("match_day"), "result_margin")


def q_filter_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_flag(split_fields(delivery_lines(spark, sf_dir)))
    return kept.select("value")


def q_key_player_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_player_kind(filter_flag(split_fields(delivery_lines(spark, sf_dir))))


def q_key_match_batsman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_match_batsman(parse_delivery(delivery_lines(spark, sf_dir)))


def q_key_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = key_by(parse_match(match_input_lines(spark, sf_dir)), "id")
    return rows.select("key", "id", "player_of_match")


def q_decode_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = key_match_batsman(parse_delivery(delivery_lines(spark, sf_dir)))
    return decode_key(sum_by_key(keyed)).select("id", "batsman", "total")


def q_format_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_lines(
        joined_match_runs(delivery_lines(spark, sf_dir), match_input_lines(spark, sf_dir))
    )


def q_row_to_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_messages(typed_messages(spark, sf_dir), EVENT_RECORD)
    return row_to_delimited(records_to_rows(decoded.where(~F.col(BAD))))


def q_nested_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joined_match_runs(delivery_lines(spark, sf_dir), match_input_lines(spark, sf_dir))
    return to_nested_record(joined).select(
        "id",
        "batsman",
        "total_runs",
        "batsman_runs",
        F.col("match.id").alias("match_id"),
        F.col("match.city").alias("city"),
        F.col("match.player_of_match").alias("player_of_match"),
        F.col("match.result_margin").alias("result_margin"),
        F.col("match.umpire2").alias("umpire2"),
    )


def q_flat_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = to_flat_record(parse_delivery(delivery_lines(spark, sf_dir)))
    return flat.select(*[f.name for f in DELIVERY], F.col("match.id").alias("match_id"))


def q_attach_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_match(match_input_lines(spark, sf_dir))
    folded = attach_nested(rows, [f.name for f in MATCH if f.name != "id"])
    return folded.select("id", F.to_json("match").alias("match_text"))


# ---------------------------------------------------------------- joins and groups


def q_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    left = items.select(
        F.col("l_orderkey").alias("id"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("item"),
    )
    orders = _table(spark, sf_dir, "orders")
    right = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return cogroup(left, right, "id").select(
        "id",
        "chunk",
        F.size("left").cast("int").alias("n_left"),
        F.size("right").cast("int").alias("n_right"),
        F.array_join(F.array_sort(F.transform("left", lambda s: s["item"])), "|").alias("items"),
        F.array_join(F.array_sort(F.transform("right", lambda s: s["status"])), "|").alias(
            "statuses"
        ),
    )


def q_cogroup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys that hold all rows, so every list comes in chunks; opened again here."""
    items = _table(spark, sf_dir, "lineitem")
    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    left = items.select(F.col("l_linestatus").alias("key"), line.alias("line"))
    orders = _table(spark, sf_dir, "orders")
    right = orders.select(F.col("o_orderstatus").alias("key"), F.col("o_orderkey").alias("order"))
    lists = cogroup(left, right, "key", max_values=2_000)
    fits = (F.size("left") <= 2_000) & (F.size("right") <= 2_000)
    lines = F.transform("left", lambda s: F.struct(F.lit("left").alias("side"), s["line"].alias("value")))
    order = F.transform(
        "right", lambda s: F.struct(F.lit("right").alias("side"), s["order"].cast("string").alias("value"))
    )
    rows = lists.select("key", fits.alias("fits"), F.explode(F.concat(lines, order)).alias("row"))
    return rows.select("key", "row.side", "row.value", "fits")


def _lookup(spark: SparkSession, sf_dir: str, on_violation: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    left = items.select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey")
    orders = _table(spark, sf_dir, "orders")
    right = orders.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderpriority")
    return lookup_join_strict(left, right, "id", on_violation).select(
        "id",
        "l_linenumber",
        "l_partkey",
        F.col("match.o_custkey").alias("o_custkey"),
        F.col("match.o_orderpriority").alias("o_orderpriority"),
    )


def q_lookup_join_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "error")


def q_lookup_join_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of customers with exactly one order, looked up by customer."""
    orders = _table(spark, sf_dir, "orders")
    lookup = orders.select(F.col("o_custkey").alias("id"), "o_orderkey")
    customers = _table(spark, sf_dir, "customer")
    left = customers.select(F.col("c_custkey").alias("id"), "c_name")
    joined = lookup_join_strict(left, lookup, "id", "drop", name="first_order")
    return joined.select("id", "c_name", F.col("first_order.o_orderkey").alias("o_orderkey"))


def q_group_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    rows = items.select(
        F.col("l_orderkey").alias("key"),
        F.concat_ws("-", "l_linenumber", "l_partkey").alias("value"),
    )
    return group_by_key(rows).select(
        "key", "chunk", F.array_join(F.array_sort("values"), "|").alias("values_text")
    )


def q_group_by_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys with a third of all rows each; lists come in chunks and are opened again here."""
    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("key"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("value")
    )
    lists = group_by_key(rows, max_values=4_096)
    fits = (F.size("values") <= 4_096).alias("fits")
    return lists.select("key", fits, F.explode("values").alias("value"))


def q_sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = sum_by_key(key_match_batsman(parse_delivery(delivery_lines(spark, sf_dir))))
    return sums.select("key", "total", F.concat_ws(",", "key", "total").alias("line"))


def q_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = key_player_kind(filter_flag(split_fields(delivery_lines(spark, sf_dir))))
    return count_by_key(keyed)


def q_match_batsman_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_runs_by_match_batsman(parse_delivery(delivery_lines(spark, sf_dir)))


# ---------------------------------------------------------------- sinks


def q_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "table")
    path = hadoop.join(base, "rows")
    table = "windrow_append_" + base.rsplit("-", 1)[-1]
    rows = parse_match(match_input_lines(spark, sf_dir)).select("id", "city", "winner")
    append_table(rows, table, options={"path": path})
    append_table(rows, table, options={"path": path})
    spark.sql(f"DROP TABLE `{table}`")
    return spark.read.parquet(path)


def q_write_single_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = hadoop.join(scratch_dir(spark, "single"), "outs.csv")
    outs = outs_by_player_and_kind(delivery_lines(spark, sf_dir))
    return read_lines(spark, write_single_text(format_line(outs), target))


def q_write_windowed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "windowed")
    windowed = tumbling_window(messages(spark, sf_dir), "1h")
    write_windowed_text(windowed, f"{out}/{DATE_DIRS}", suffix=".txt", **WRAPPED)
    return _read_back(spark, out)


def q_write_windowed_text_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards; a line's shard is free, so only the folder and the line are compared."""
    out = scratch_dir(spark, "sharded")
    windowed = tumbling_window(messages(spark, sf_dir), "6h")
    write_windowed_text(windowed, f"{out}/{DATE_DIRS}{{HH}}/", num_shards=8, **WRAPPED)
    file = F.substring_index("path", "/", -1)
    name = F.regexp_replace(file, "-[0-9]{2}-of-", "-xx-of-")
    back = _read_back(spark, out)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return back.select(folder.alias("folder"), name.alias("name"), "value")


def q_write_windowed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice in eight shards, then once in one: no file of the first write may stay."""
    out = scratch_dir(spark, "partitions")
    windowed = tumbling_window(messages(spark, sf_dir), "6h")
    write_windowed_partitions(windowed.union(windowed), out, num_shards=8)
    write_windowed_partitions(windowed, out)
    back = spark.read.text(out)
    return back.select(F.col("day").cast("string").alias("day"), "window", "value")


def q_rewrite_windowed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with eight shards written again with as many as their rows need."""
    out = scratch_dir(spark, "rewritten")
    windowed = tumbling_window(messages(spark, sf_dir), "6h")
    write_windowed_text(windowed, f"{out}/{DATE_DIRS}", num_shards=8, **WRAPPED)
    write_windowed_text(windowed, f"{out}/{DATE_DIRS}", num_shards=None, **WRAPPED)
    return _read_back(spark, out)


def q_write_one_file_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "per-window")
    windowed = tumbling_window(messages(spark, sf_dir), "1h")
    write_one_file_per_window(windowed, f"{out}/", time_format="HHmm")
    return _read_back(spark, out).groupBy("path").agg(F.count("*").alias("n"))


def q_hour_minute_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = hour_minute_filename(
        F.col("window.start"), F.col("window.end"), F.lit(0), F.lit(1), "outs", ".csv"
    )
    return _distinct_windows(spark, sf_dir).groupBy(name.alias("name")).agg(F.sum("n").alias("n"))


def _distinct_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = tumbling_window(messages(spark, sf_dir))
    return windowed.groupBy("window").agg(F.count("*").alias("n"))


def q_resolve_date_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("window.end")
    bare = resolve_date_dirs("/out/yyyy/MM/dd/HH/mm", end)
    fallback = resolve_date_dirs("/out/YYYY/MM/DD/", end, None, None, None, None, None)
    wrapped = resolve_date_dirs("/out/m={MM}/", end, month="{MM}", minute="{m}")
    return _distinct_windows(spark, sf_dir).select(
        bare.alias("bare"), fallback.alias("fallback"), wrapped.alias("wrapped"), "n"
    )


def q_windowed_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.col("window.start"), F.col("window.end")
    name = windowed_filename(start, end, F.lit(3), F.lit(12), "windowed-file", suffix=".txt")
    return _distinct_windows(spark, sf_dir).select(name.alias("name"), "n")


def q_shard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_lines(tumbling_window(messages(spark, sf_dir), "24h"), 8)
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    inside = (F.col("shard") >= 0) & (F.col("shard") < F.col("shards"))
    return sharded.select(start.alias("window_start"), "shards", "value", inside.alias("inside"))


# ---------------------------------------------------------------- streaming


def q_tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    return _distinct_windows(spark, sf_dir).select(start.alias("window_start"), "n")


def q_finalize_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished windows of a stream that has not ended: its newest window stays open."""
    base = scratch_dir(spark, "finalize")
    source, sink = hadoop.join(base, "in"), hadoop.join(base, "out")
    messages(spark, sf_dir).write.parquet(source)
    stream = read_messages(
        spark, "parquet", {"path": source}, "value string, ts timestamp", time="ts"
    )
    finished = finalize_window(stream, "1h")
    query = (
        finished.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", hadoop.join(base, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    return spark.read.parquet(sink).select(start.alias("window_start"), "value")


def q_stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "stream")
    source, out = hadoop.join(base, "in"), hadoop.join(base, "out")
    with_closing_row(messages(spark, sf_dir)).write.parquet(source)
    stream = read_messages(
        spark, "parquet", {"path": source}, "value string, ts timestamp", time="ts"
    )
    query = messages_to_window_files(
        stream,
        f"{out}/{DATE_DIRS}",
        hadoop.join(base, "checkpoint"),
        length="1h",
        trigger={"availableNow": True},
        suffix=".txt",
        **WRAPPED,
    )
    query.awaitTermination()
    return _read_back(spark, out)


def q_stream_messages_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that are not finished: files of single batches, whose panes are left out here."""
    base = scratch_dir(spark, "per-batch")
    source, out = hadoop.join(base, "in"), hadoop.join(base, "out")
    messages(spark, sf_dir).repartition(2).write.parquet(source)
    stream = read_messages(
        spark,
        "parquet",
        {"path": source, "maxFilesPerTrigger": "1"},
        "value string, ts timestamp",
        time="ts",
    )
    query = messages_to_window_files(
        stream,
        f"{out}/{DATE_DIRS}",
        hadoop.join(base, "checkpoint"),
        length="6h",
        trigger={"availableNow": True},
        finalize=False,
        **WRAPPED,
    )
    query.awaitTermination()
    name = F.regexp_replace("path", "-pane-[0-9a-f]{8}-[0-9]+-", "-pane-x-")
    return _read_back(spark, out).select(name.alias("path"), "value")


def q_stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "records")
    source, out, dead = (hadoop.join(base, d) for d in ("in", "out", "dead"))
    rows = with_closing_row(typed_messages(spark, sf_dir), '{"event_id":-1,"user_id":-1}')
    rows.write.parquet(source)
    stream = read_messages(
        spark, "parquet", {"path": source}, "value string, ts timestamp", time="ts"
    )
    files, letters = records_to_window_files(
        decode_messages(stream, EVENT_RECORD),
        f"{out}/{DATE_DIRS}",
        hadoop.join(base, "checkpoint"),
        dead,
        length="1h",
        trigger={"availableNow": True},
        **WRAPPED,
    )
    await_all((files, letters))
    dead_rows = read_dead_letters(spark, dead).select(
        F.lit("dead").alias("path"), F.col("payloadString").alias("value")
    )
    return _read_back(spark, out).unionByName(dead_rows)


# ---------------------------------------------------------------- user code


def q_flat_map_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    def twice(batches):
        for pdf in batches:
            yield pdf.loc[pdf.index.repeat(2)]

    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("value")
    )
    return flat_map_fn(rows, twice, "key long, value int")


def q_map_and_predicate_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    kept = rows.where(predicate_fn(lambda flag: flag == "R", "l_returnflag"))
    total = map_fn(lambda a, b: a + b, "long", "l_orderkey", "l_linenumber")
    return kept.select("l_orderkey", "l_linenumber", total.alias("key_plus_line"))


def q_group_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user-written sum over three keys that hold a third of all rows each, in slices."""

    def sum_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("key", as_index=False).agg(total=("value", "sum"))

    def sum_parts(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("key", as_index=False).agg(total=("total", "sum"))

    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("key"), F.col("l_linenumber").cast("long").alias("value")
    )
    return group_fn(
        rows, ["key"], sum_rows, "key string, total long", combine=sum_parts, max_rows=10_000
    )


def q_cogroup_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    def attach_status(left: pa.Table, right: pa.Table) -> pa.Table:
        status = right["status"][0] if right.num_rows else pa.scalar(None, right.schema.field("status").type)
        return left.append_column("status", pa.repeat(status, left.num_rows))

    items = _table(spark, sf_dir, "lineitem")
    left = items.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"))
    orders = _table(spark, sf_dir, "orders")
    right = orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    return cogroup_fn(
        left,
        right,
        ["key"],
        attach_status,
        "key long, line int, status string",
        per_left_row=True,
        arrow=True,
    )


def q_group_batches_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sum read batch by batch: no call holds a whole key."""

    def sum_batches(batches):
        key, total, rows, calls = None, 0, 0, 0
        for pdf in batches:
            key, total, rows, calls = pdf["key"].iloc[0], total + int(pdf["value"].sum()), rows + len(pdf), calls + 1
        yield pd.DataFrame({"key": [key], "total": [total], "in_batches": [calls >= rows // 10_000]})

    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("key"), F.col("l_linenumber").cast("long").alias("value")
    )
    return group_batches_fn(rows, ["key"], sum_batches, "key string, total long, in_batches boolean")


def q_cogroup_fn_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys that hold nearly all rows of both sides, matched by order inside the function."""

    def match_orders(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return left.merge(right.drop(columns="key"), on="order")

    items = _table(spark, sf_dir, "lineitem")
    left = items.select(
        F.col("l_linestatus").alias("key"), F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line")
    )
    orders = _table(spark, sf_dir, "orders")
    right = orders.select(
        F.col("o_orderstatus").alias("key"), F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("cust")
    )
    return cogroup_fn(
        left,
        right,
        ["key"],
        match_orders,
        "key string, order long, line int, cust long",
        per_left_row=True,
        per_right_row=True,
        max_rows=5_000,
        matching=["order"],
    )


def q_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = composite(split_fields, filter_flag, key_player_kind, sum_by_key)
    return delivery_lines(spark, sf_dir).transform(steps)


# ---------------------------------------------------------------- whole jobs


def q_outs_by_player_and_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outs_by_player_and_kind(delivery_lines(spark, sf_dir))


def q_match_batsman_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = match_batsman_runs(delivery_lines(spark, sf_dir), match_input_lines(spark, sf_dir))
    return runs.select(*[f.name for f in DELIVERY], F.col("match.id").alias("match_id"))


def q_match_batsman_runs_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders give malformed match lines, so their runs are left out."""
    runs = match_batsman_runs(
        delivery_lines(spark, sf_dir),
        match_input_lines(spark, sf_dir, cut_short=True),
        on_violation="drop",
        include_match=True,
    )
    return runs.select(
        "id", "batsman", "total_runs", F.col("match.player_of_match").alias("player_of_match")
    )


def entry(spark: SparkSession) -> DataFrame:
    """Wickets per player and kind of dismissal."""
    return q_outs_by_player_and_kind(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = _own_queries()
    if corpus_queries:
        own |= corpus_queries.queries() | {"pipeline": corpus_pipeline.run}
    return own


def oracle_sql() -> dict[str, str]:
    own = _own_sql()
    if corpus_queries:
        own |= corpus_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "outs_by_player_and_kind": q_outs_by_player_and_kind,
        "match_batsman_runs": q_match_batsman_runs,
        "match_batsman_runs_drop": q_match_batsman_runs_drop,
        "stream_messages_to_window_files": q_stream_messages,
        "stream_records_to_window_files": q_stream_records,
        "read_lines": q_read_lines,
        "read_messages": q_read_messages,
        "read_typed_messages": q_read_typed_messages,
        "route_dead_letters": q_route_dead_letters,
        "dead_letter_attributes": q_dead_letter_attributes,
        "write_single_text": q_write_single_text,
        "write_windowed_text": q_write_windowed_text,
        "write_windowed_text_sharded": q_write_windowed_text_sharded,
        "write_windowed_partitions": q_write_windowed_partitions,
        "rewrite_windowed_text": q_rewrite_windowed_text,
        "stream_messages_per_batch": q_stream_messages_per_batch,
        "windowed_filename": q_windowed_filename,
        "resolve_date_dirs": q_resolve_date_dirs,
        "shard_lines": q_shard_lines,
        "write_one_file_per_window": q_write_one_file_per_window,
        "hour_minute_filename": q_hour_minute_filename,
        "append_table": q_append_table,
        "split_fields": q_split_fields,
        "parse_delivery": q_parse_delivery,
        "parse_match_lenient": q_parse_match_lenient,
        "parse_match_extras": q_parse_match_extras,
        "filter_flag": q_filter_flag,
        "key_player_kind": q_key_player_kind,
        "key_match_batsman": q_key_match_batsman,
        "key_by": q_key_by,
        "decode_key": q_decode_key,
        "format_line": q_format_line,
        "row_to_delimited": q_row_to_delimited,
        "flat_record": q_flat_record,
        "nested_record": q_nested_record,
        "attach_nested": q_attach_nested,
        "cogroup": q_cogroup,
        "cogroup_hot_keys": q_cogroup_hot_keys,
        "lookup_join_strict": q_lookup_join_strict,
        "lookup_join_drop": q_lookup_join_drop,
        "group_by_key": q_group_by_key,
        "group_by_hot_key": q_group_by_hot_key,
        "sum_by_key": q_sum_by_key,
        "count_by_key": q_count_by_key,
        "match_batsman_sum": q_match_batsman_sum,
        "tumbling_window": q_tumbling_window,
        "finalize_window": q_finalize_window,
        "flat_map_fn": q_flat_map_fn,
        "map_and_predicate_fn": q_map_and_predicate_fn,
        "group_fn": q_group_fn,
        "cogroup_fn": q_cogroup_fn,
        "group_batches_fn": q_group_batches_fn,
        "cogroup_fn_both_sides": q_cogroup_fn_both_sides,
        "composite": q_composite,
    }


# ---------------------------------------------------------------- oracle

# The 18 delivery columns of each lineitem row.
_DELIVERY = """
  SELECT CAST(l_orderkey AS VARCHAR) AS id,
         CAST(1 + l_linenumber % 2 AS INTEGER) AS inning,
         CAST(l_partkey % 20 AS INTEGER) AS over,
         CAST(l_linenumber AS INTEGER) AS ball,
         CAST(l_suppkey AS VARCHAR) AS batsman,
         CAST(l_partkey AS VARCHAR) AS non_striker,
         'B' || CAST(l_partkey % 11 AS VARCHAR) AS bowler,
         CAST(l_quantity AS INTEGER) AS batsman_runs,
         CAST(l_linenumber % 2 AS INTEGER) AS extra_runs,
         CAST(l_quantity AS INTEGER) + CAST(l_linenumber % 2 AS INTEGER) AS total_runs,
         CAST(0 AS INTEGER) AS non_boundary,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS is_wicket,
         l_linestatus AS dismissal_kind,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) ELSE 'NA' END
           AS player_dismissed,
         'NA' AS fielder,
         l_returnflag AS extras_type,
         'T' || CAST(l_suppkey % 8 AS VARCHAR) AS batting_team,
         'T' || CAST(l_partkey % 8 AS VARCHAR) AS bowling_team
  FROM lineitem
"""

# The match columns of each order.
_MATCH = """
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         o_orderpriority AS city,
         CAST(o_custkey AS VARCHAR) AS player_of_match,
         o_orderstatus AS venue,
         '0' AS neutral_venue,
         'T' || CAST(o_custkey % 8 AS VARCHAR) AS team1,
         'T' || CAST(o_orderkey % 8 AS VARCHAR) AS team2,
         'T' || CAST(o_custkey % 8 AS VARCHAR) AS toss_winner,
         'bat' AS toss_decision,
         'T' || CAST(o_orderkey % 8 AS VARCHAR) AS winner,
         'runs' AS result,
         'N' AS eliminator,
         'NA' AS method,
         'U' || CAST(o_custkey % 5 AS VARCHAR) AS umpire1,
         'U' || CAST(o_orderkey % 5 AS VARCHAR) AS umpire2
  FROM orders
"""

_LINE = "concat_ws(',', " + ", ".join(f.name for f in DELIVERY) + ")"

_RUNS = f"""
  SELECT id, batsman, CAST(sum(batsman_runs) AS BIGINT) AS total_runs
  FROM ({_DELIVERY}) GROUP BY id, batsman
"""

_PAYLOAD = """
  '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
"""


def _score_defaults() -> str:
    """The output columns of summed runs: three computed, the rest their defaults."""
    parts = []
    for f in DELIVERY:
        if f.name in ("id", "batsman", "total_runs"):
            parts.append(f.name)
        elif f.dataType.typeName() == "integer":
            parts.append(f"CAST(0 AS INTEGER) AS {f.name}")
        else:
            parts.append(f"CAST(NULL AS VARCHAR) AS {f.name}")
    return ", ".join(parts)


def _window_name(hours: int, prefix: str, shard: str, suffix: str) -> str:
    start = f"time_bucket(INTERVAL {hours} HOUR, ts)"
    fmt = "'%Y%m%dT%H%M%SZ'"
    return (
        f"'{prefix}' || strftime({start}, {fmt}) || '-' || "
        f"strftime({start} + INTERVAL {hours} HOUR, {fmt}) || '-pane-0-last-{shard}{suffix}'"
    )


def _window_files(value: str, suffix: str, where: str = "true") -> str:
    day = "strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y/%m/%d/')"
    name = _window_name(1, "output", "00-of-01", suffix)
    return f"SELECT {day} || {name} AS path, {value} AS value FROM events WHERE {where}"


def _own_sql() -> dict[str, str]:
    minute_end = "(time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE)"
    delimited = "event_id || ',' || user_id || ',' || event_type || ',null,0,'"
    return {
        "outs_by_player_and_kind": f"""
            SELECT batsman, dismissal_kind, count(*) AS n FROM ({_DELIVERY})
            WHERE is_wicket = 1 GROUP BY batsman, dismissal_kind""",
        "match_batsman_runs": f"""
            SELECT {_score_defaults()}, CAST(NULL AS VARCHAR) AS match_id
            FROM ({_RUNS}) WHERE id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)""",
        "match_batsman_runs_drop": f"""
            SELECT r.id, r.batsman, r.total_runs, m.player_of_match
            FROM ({_RUNS}) r JOIN ({_MATCH}) m ON r.id = m.id WHERE m.venue <> 'P'""",
        "stream_messages_to_window_files": _window_files("props", ".txt"),
        "stream_records_to_window_files": f"""
            {_window_files(delimited, "", "event_type <> 'error'")}
            UNION ALL
            SELECT 'dead' AS path, '#' || {_PAYLOAD} AS value
            FROM events WHERE event_type = 'error'""",
        "read_lines": f"SELECT {_LINE} AS value FROM ({_DELIVERY})",
        "read_messages": """
            SELECT props AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "at" FROM events""",
        "read_typed_messages": """
            SELECT event_id, user_id, event_type, CAST(NULL AS VARCHAR) AS note,
                   CAST(0 AS INTEGER) AS retries
            FROM events WHERE event_type <> 'error'""",
        "dead_letter_attributes": """
            SELECT '#{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS payload,
                   'kind=error,user=' || user_id AS attributes
            FROM events WHERE event_type = 'error'""",
        "route_dead_letters": f"""
            SELECT side, payload, CAST(length(payload) AS INTEGER) AS n_chars FROM (
              SELECT CASE WHEN event_type = 'error' THEN 'dead' ELSE 'good' END AS side,
                     CASE WHEN event_type = 'error' THEN '#' ELSE '' END || {_PAYLOAD} AS payload
              FROM events)""",
        "write_single_text": f"""
            SELECT batsman || ',' || dismissal_kind || ',' || count(*) AS value
            FROM ({_DELIVERY}) WHERE is_wicket = 1 GROUP BY batsman, dismissal_kind""",
        "write_windowed_text": _window_files("props", ".txt"),
        "write_windowed_text_sharded": f"""
            SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y/%m/%d/%H')
                     AS folder,
                   {_window_name(6, "output", "xx-of-08", "")} AS name,
                   props AS value
            FROM events""",
        "write_windowed_partitions": """
            SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y-%m-%d') AS day,
                   strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y%m%dT%H%M%SZ') || '-' ||
                   strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y%m%dT%H%M%SZ')
                     AS "window", props AS value
            FROM events""",
        "rewrite_windowed_text": f"""
            SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y/%m/%d/')
                     || {_window_name(6, "output", "00-of-01", "")} AS path, props AS value
            FROM events""",
        "stream_messages_per_batch": f"""
            SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y/%m/%d/')
                     || replace({_window_name(6, "output", "00-of-01", "")}, '-pane-0-last-', '-pane-x-')
                     AS path, props AS value
            FROM events""",
        "windowed_filename": """
            SELECT 'windowed-file' || strftime(w, '%Y%m%dT%H%M%SZ') || '-' ||
                   strftime(w + INTERVAL 1 MINUTE, '%Y%m%dT%H%M%SZ') ||
                   '-pane-0-last-03-of-12.txt' AS name, count(*) AS n
            FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS w FROM events) GROUP BY w""",
        "resolve_date_dirs": f"""
            SELECT strftime(e, '/out/%Y/%m/%d/%H/%M/') AS bare,
                   strftime(e, '/out/%Y/%m/') ||
                     CASE WHEN dayofyear(e) < 10 THEN '0' ELSE '' END || dayofyear(e) || '/'
                     AS fallback,
                   strftime(e, '/out/m=%m/') AS wrapped,
                   count(*) AS n
            FROM (SELECT {minute_end} AS e FROM events) GROUP BY e""",
        "shard_lines": """
            SELECT strftime(time_bucket(INTERVAL 24 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
                   CAST(8 AS INTEGER) AS shards, props AS value, true AS inside
            FROM events""",
        "write_one_file_per_window": """
            SELECT strftime(w, '%Y-%m-%d/-%H%M-') || strftime(w + INTERVAL 1 HOUR, '%H%M') ||
                   '-0-of-1' AS path, count(*) AS n
            FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w FROM events) GROUP BY w""",
        "hour_minute_filename": """
            SELECT 'outs-' || strftime(w, '%H:%M-') || strftime(w + INTERVAL 1 MINUTE, '%H:%M') ||
                   '-0-of-1.csv' AS name, count(*) AS n
            FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS w FROM events) GROUP BY 1""",
        "append_table": f"""
            SELECT id, city, winner FROM ({_MATCH})
            UNION ALL SELECT id, city, winner FROM ({_MATCH})""",
        "split_fields": """
            SELECT CAST(CASE WHEN o_orderstatus = 'P' THEN 16 ELSE 17 END AS INTEGER) AS n_fields,
                   CAST(o_orderkey AS VARCHAR) AS first_field,
                   'U' || CAST(CASE WHEN o_orderstatus = 'P' THEN o_custkey % 5
                                    ELSE o_orderkey % 5 END AS VARCHAR) AS last_field
            FROM orders""",
        "parse_delivery": f"SELECT * FROM ({_DELIVERY})",
        "parse_match_lenient": f"SELECT * FROM ({_MATCH}) WHERE venue <> 'P'",
        "parse_match_extras": """
            SELECT CAST(o_orderkey AS VARCHAR) AS id,
                   strftime(o_orderdate, '%m/%d/%y') AS match_day,
                   CAST(o_custkey % 9 AS INTEGER) AS result_margin
            FROM orders""",
        "filter_flag": f"SELECT {_LINE} AS value FROM ({_DELIVERY}) WHERE is_wicket = 1",
        "key_player_kind": f"""
            SELECT batsman || ',' || dismissal_kind AS key, CAST(1 AS INTEGER) AS value
            FROM ({_DELIVERY}) WHERE is_wicket = 1""",
        "key_match_batsman": f"""
            SELECT id || ',' || batsman AS key, batsman_runs AS value FROM ({_DELIVERY})""",
        "key_by": f"SELECT id AS key, id, player_of_match FROM ({_MATCH})",
        "decode_key": f"""
            SELECT id, batsman, CAST(sum(batsman_runs) AS BIGINT) AS total
            FROM ({_DELIVERY}) GROUP BY id, batsman""",
        "format_line": f"""
            SELECT r.id || ',' || r.batsman || ',' || r.total_runs || ',' || m.player_of_match
                     AS value
            FROM ({_RUNS}) r JOIN ({_MATCH}) m ON r.id = m.id""",
        "row_to_delimited": f"""
            SELECT {delimited} AS value FROM events WHERE event_type <> 'error'""",
        "flat_record": f"""
            SELECT * REPLACE (CAST(total_runs AS BIGINT) AS total_runs),
                   CAST(NULL AS VARCHAR) AS match_id
            FROM ({_DELIVERY})""",
        "nested_record": f"""
            SELECT r.id, r.batsman, r.total_runs, CAST(0 AS INTEGER) AS batsman_runs,
                   m.id AS match_id, m.city, m.player_of_match,
                   CAST(1 AS INTEGER) AS result_margin, m.umpire2
            FROM ({_RUNS}) r JOIN ({_MATCH}) m ON r.id = m.id""",
        "attach_nested": f"""
            SELECT id, CAST(to_json(struct_pack({", ".join(
                f"{f.name} := {f.name}" for f in MATCH if f.name != "id"
            )})) AS VARCHAR) AS match_text
            FROM ({_MATCH})""",
        "cogroup": """
            SELECT coalesce(l.id, r.id) AS id, CAST(0 AS INTEGER) AS chunk,
                   CAST(coalesce(l.n, 0) AS INTEGER) AS n_left,
                   CAST(coalesce(r.n, 0) AS INTEGER) AS n_right,
                   coalesce(l.items, '') AS items, coalesce(r.statuses, '') AS statuses
            FROM (SELECT l_orderkey AS id, count(*) AS n, string_agg(item, '|' ORDER BY item)
                           AS items
                  FROM (SELECT l_orderkey,
                               l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item
                        FROM lineitem) GROUP BY 1) l
            FULL JOIN (SELECT o_orderkey AS id, count(*) AS n,
                              string_agg(o_orderstatus, '|' ORDER BY o_orderstatus) AS statuses
                       FROM orders GROUP BY 1) r ON l.id = r.id""",
        "cogroup_hot_keys": """
            SELECT l_linestatus AS key, 'left' AS side, l_orderkey || '-' || l_linenumber AS value, true AS fits
            FROM lineitem
            UNION ALL SELECT o_orderstatus, 'right', CAST(o_orderkey AS VARCHAR), true FROM orders""",
        "lookup_join_strict": """
            SELECT l_orderkey AS id, l_linenumber, l_partkey, o_custkey, o_orderpriority
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "lookup_join_drop": """
            SELECT c_custkey AS id, c_name, o_orderkey
            FROM customer JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders
                                GROUP BY o_custkey HAVING count(*) = 1)
              ON c_custkey = o_custkey""",
        "group_by_key": """
            SELECT l_orderkey AS key, CAST(0 AS INTEGER) AS chunk,
                   string_agg(v, '|' ORDER BY v) AS values_text
            FROM (SELECT l_orderkey, l_linenumber || '-' || l_partkey AS v FROM lineitem)
            GROUP BY l_orderkey""",
        "group_by_hot_key": """
            SELECT l_returnflag AS key, l_orderkey || '-' || l_linenumber AS value, true AS fits
            FROM lineitem""",
        "sum_by_key": f"""
            SELECT id || ',' || batsman AS key, total_runs AS total,
                   id || ',' || batsman || ',' || total_runs AS line
            FROM ({_RUNS})""",
        "count_by_key": f"""
            SELECT batsman || ',' || dismissal_kind AS key, count(*) AS n
            FROM ({_DELIVERY}) WHERE is_wicket = 1 GROUP BY 1""",
        "match_batsman_sum": f"SELECT {_score_defaults()} FROM ({_RUNS})",
        "tumbling_window": """
            SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
            FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS w FROM events) GROUP BY w""",
        "finalize_window": """
            SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
                   props AS value
            FROM events
            WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
                  <= (SELECT max(ts) FROM events)""",
        "flat_map_fn": """
            SELECT l_orderkey AS key, l_linenumber AS value FROM lineitem
            UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem""",
        "map_and_predicate_fn": """
            SELECT l_orderkey, l_linenumber, l_orderkey + l_linenumber AS key_plus_line
            FROM lineitem WHERE l_returnflag = 'R'""",
        "group_fn": """
            SELECT l_returnflag AS key, CAST(sum(l_linenumber) AS BIGINT) AS total
            FROM lineitem GROUP BY l_returnflag""",
        "cogroup_fn": """
            SELECT l_orderkey AS key, l_linenumber AS line, o_orderstatus AS status
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
        "group_batches_fn": """
            SELECT l_returnflag AS key, CAST(sum(l_linenumber) AS BIGINT) AS total, true AS in_batches
            FROM lineitem GROUP BY l_returnflag""",
        "cogroup_fn_both_sides": """
            SELECT l_linestatus AS key, l_orderkey AS "order", l_linenumber AS line, o_custkey AS cust
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus""",
        "composite": f"""
            SELECT batsman || ',' || dismissal_kind AS key, count(*) AS total
            FROM ({_DELIVERY}) WHERE is_wicket = 1 GROUP BY 1""",
    }
