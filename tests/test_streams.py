from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from conftest import values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from windrow.plans import messages_to_window_files, records_to_window_files
from windrow.plans.streams import await_all
from windrow.schemas import DEAD_LETTER, avro_to_struct
from windrow.sinks import write_one_file_per_window, write_windowed_partitions
from windrow.sources import (
    dead_letter_files,
    dead_letter_messages,
    decode_messages,
    load_avro_schema,
    read_dead_letters,
    read_lines,
    read_messages,
    read_typed_messages,
    route_dead_letters,
)
from windrow.sources import messages as messages_module
from windrow.sources.messages import attribute_pairs, marked_schema
from windrow.streaming import finalize_window, windowed_sink

MESSAGE = "value string, ts timestamp"
RECORD = """{"type":"record","name":"R","fields":[
  {"name":"id","type":["null","string"],"default":null},
  {"name":"over","type":"int","default":0},
  {"name":"inner","type":["null",{"type":"record","name":"I","fields":[
     {"name":"n","type":"int","default":5},{"name":"tags","type":{"type":"array","items":"string"}}
  ]}],"default":null}]}"""


class Feed:
    """A folder read as a stream; each ``send`` adds one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, str(path), 0
        os.makedirs(self.path)

    def send(self, *rows):
        stamped = [(v, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for s, v in rows]
        frame = self.spark.createDataFrame(stamped, MESSAGE).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def read(self):
        return read_messages(self.spark, "parquet", {"path": self.path}, MESSAGE, time="ts")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def _files(out):
    found = {}
    for folder, folders, names in os.walk(out):
        folders[:] = [f for f in folders if not f.startswith("_")]
        for name in names:
            if not name.endswith(".crc"):
                with open(os.path.join(folder, name)) as f:
                    found[name] = sorted(f.read().split("\n")[:-1])
    return found


def _short(files):
    return {name[6:14] + name[15:19]: lines for name, lines in files.items()}


def test_windows_fire_once_and_late_rows_are_dropped(spark, feed, tmp_path):
    rows = []
    query = (
        finalize_window(feed.read())
        .writeStream.outputMode("append")
        .foreachBatch(
            lambda batch, _: rows.extend(
                (r["window"]["start"].minute, r["value"]) for r in batch.collect()
            )
        )
        .option("checkpointLocation", f"{tmp_path}/cp")
        .start()
    )
    try:
        feed.send((10, "a"), (150, "b"), (20, "a2"), (20, "a2"))
        query.processAllAvailable()
        assert sorted(rows) == [(0, "a"), (0, "a2"), (0, "a2")]
        rows.clear()
        feed.send((30, "late"), (125, "c"))
        query.processAllAvailable()
        assert rows == []
        dropped = sum(
            s["numRowsDroppedByWatermark"]
            for p in query.recentProgress
            for s in p["stateOperators"]
        )
        assert dropped == 1
        feed.send((180, "closing"))
        query.processAllAvailable()
        assert sorted(rows) == [(2, "b"), (2, "c")]
    finally:
        query.stop()


def test_allowed_delay_keeps_late_rows(spark, feed, tmp_path):
    feed.send((10, "a"), (100, "b"))
    out = f"{tmp_path}/out"

    def run():
        query = messages_to_window_files(
            feed.read(), out, f"{tmp_path}/cp", "1m", "2 minutes", {"availableNow": True}
        )
        query.awaitTermination()

    run()
    assert _files(out) == {}
    feed.send((20, "late"), (600, "closing"))
    run()
    assert _short(_files(out)) == {"202401010000": ["a", "late"], "202401010001": ["b"]}


def test_messages_to_files_restart_from_the_checkpoint(spark, feed, tmp_path):
    out = f"{tmp_path}/out"

    def run():
        query = messages_to_window_files(
            feed.read(), out, f"{tmp_path}/cp", trigger={"availableNow": True}, num_shards=2
        )
        query.awaitTermination()

    feed.send((1, "a"), (2, "b"), (3, "c"), (70, "d"))
    run()
    first = _files(out)
    assert sorted(sum(first.values(), [])) == ["a", "b", "c"]
    feed.send((130, "e"))
    run()
    both = _files(out)
    assert sorted(sum(both.values(), [])) == ["a", "b", "c", "d"]
    assert {k: both[k] for k in first} == first


def test_a_batch_written_again_replaces_its_files(spark, feed, tmp_path):
    """A crash after the files are written but before the batch is committed."""
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        query = messages_to_window_files(
            feed.read(), out, checkpoint, trigger={"availableNow": True}
        )
        query.awaitTermination()

    feed.send((1, "a"), (2, "b"), (70, "d"))
    run()
    first = _files(out)
    commits = sorted(
        (int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), reverse=True
    )
    for name in (f"{commits[0]}", f".{commits[0]}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert _files(out) == first
    assert sorted(sum(first.values(), [])) == ["a", "b"]


def test_records_to_files_and_dead_letters(spark, feed, tmp_path):
    feed.send(
        (1, '{"id":"1","over":2}'),
        (2, "nope"),
        (3, '{"id":"1","over":"x"}'),
        (4, '{"id":"2"}'),
        (90, '{"id":"9","over":9}'),
    )
    out, dead = f"{tmp_path}/out", f"{tmp_path}/dead"

    def run():
        queries = records_to_window_files(
            decode_messages(feed.read(), RECORD),
            out,
            f"{tmp_path}/cp",
            dead,
            trigger={"availableNow": True},
        )
        await_all(queries)

    run()
    assert list(_files(out).values()) == [["1,2,null,", "2,0,null,"]]

    def letters():
        return values(read_dead_letters(spark, dead).select("payloadString"))

    assert letters() == [("nope",), ('{"id":"1","over":"x"}',)]
    feed.send((5, "late and bad"), (6, '{"id":"late"}'))
    run()
    assert len(_files(out)) == 1
    assert ("late and bad",) in letters()


def test_dead_letter_layout(spark):
    rows = spark.createDataFrame([("{}",), ("nope",), (None,)], "value string")
    good, bad = route_dead_letters(decode_messages(rows, RECORD))
    assert [(f.name, f.dataType) for f in bad.schema] == [
        (f.name, f.dataType) for f in DEAD_LETTER
    ]
    assert [f.name for f in bad.schema if not f.nullable][:3] == [
        f.name for f in DEAD_LETTER if not f.nullable
    ]
    got = {r["payloadString"]: bytes(r["payloadBytes"]) for r in bad.collect()}
    assert got == {"nope": b"nope", "": b""}
    assert good.first()["record"]["over"] == 0
    carried = decode_messages(
        rows.withColumn("attributes", F.expr("array(named_struct('key','k','value','v'))")), RECORD
    )
    assert route_dead_letters(carried)[1].first()["attributes"][0]["key"] == "k"


def test_decode_nested_defaults(spark):
    rows = spark.createDataFrame([('{"inner":{"tags":["x"]}}',)], "value string")
    record = decode_messages(rows, RECORD).first()["record"]
    assert (record["id"], record["over"], record["inner"]["n"]) == (None, 0, 5)
    assert record["inner"]["tags"] == ["x"]


def test_typed_stream(spark, feed):
    stream = read_typed_messages(
        spark, "parquet", RECORD, {"path": feed.path}, MESSAGE, time="ts"
    )
    assert stream.isStreaming and stream.columns == ["value", "ts", "record", "_bad"]


def test_avro_codec_needs_its_module(spark):
    rows = spark.createDataFrame([(bytearray(b"x"),)], "value binary")
    with pytest.raises(AnalysisException, match="AVRO_NOT_LOADED"):
        decode_messages(rows, RECORD, codec="avro")
    with pytest.raises(ValueError, match="codec"):
        decode_messages(rows, RECORD, codec="other")


def test_avro_schema_file(spark, tmp_path):
    for name in ("a.avsc", "b.avsc"):
        (tmp_path / name).write_text(RECORD)
    assert load_avro_schema(spark, f"{tmp_path}/a.avsc") == RECORD
    with pytest.raises(ValueError, match="exactly 1"):
        load_avro_schema(spark, f"{tmp_path}/*.avsc")
    with pytest.raises(ValueError, match="no file"):
        load_avro_schema(spark, f"{tmp_path}/none")


@pytest.mark.parametrize(
    "kind",
    ['["int","string"]', '["null","int","string"]', '{"type":"map","values":"int"}', '"fixed"',
     '{"type":"int","logicalType":"date"}'],
)
def test_other_avro_types_are_refused(kind):
    record = '{"type":"record","name":"R","fields":[{"name":"x","type":%s}]}' % kind
    with pytest.raises(ValueError, match="unsupported"):
        avro_to_struct(record)


def test_avro_top_level_must_be_a_record():
    with pytest.raises(ValueError, match="record"):
        avro_to_struct('"int"')


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'head\nx,"y\n\nz"\r\nlast')
    lines = read_lines(spark, str(tmp_path))
    assert sorted(r[0] for r in lines.collect()) == ["", "head", "last", 'x,"y', 'z"']
    assert read_lines(spark, str(tmp_path), skip_header="head").count() == 4


def test_one_file_per_window_on_a_stream(spark, feed, tmp_path):
    feed.send((1, "a"), (2, "b"), (70, "c"), (130, "d"))
    messages_to_window_files(
        feed.read(),
        f"{tmp_path}/out/pre",
        f"{tmp_path}/cp",
        trigger={"availableNow": True},
        writer=write_one_file_per_window,
        suffix=".txt",
    ).awaitTermination()
    assert _files(f"{tmp_path}/out/2024-01-01") == {
        "pre-0000-0001-0-of-1.txt": ["a", "b"],
        "pre-0001-0002-0-of-1.txt": ["c"],
    }


def test_windowed_sink_takes_a_name(spark, feed, tmp_path):
    feed.send((1, "a"))
    finished = finalize_window(feed.read())
    query = windowed_sink(
        finished, f"{tmp_path}/out", f"{tmp_path}/cp", {"availableNow": True}, "named"
    )
    assert query.name == "named"
    query.awaitTermination()


def test_payloads_that_are_not_one_whole_record(spark):
    schema = (
        '{"type": "record", "name": "E", "fields": [{"name": "event_id", "type": "long"},'
        ' {"name": "n", "type": "int", "default": 0}, {"name": "s", "type": ["null", "string"]}]}'
    )
    good = ['{"event_id":1}', '{"event_id":1,"s":"a]b}"} ']
    bad = ["{}", '{"event_id":1} junk', '{"event_id":1},{"event_id":2}', '{"event_id":1}]', '{"event_id":1}}', "", None, "nope"]
    rows = spark.createDataFrame([(x,) for x in good + bad], "value string")
    got = {r["value"]: r["_bad"] for r in decode_messages(rows, schema).collect()}
    assert got == {**dict.fromkeys(good, False), **dict.fromkeys(bad, True)}


def test_marked_schema_takes_a_free_name():
    reader, marker = marked_schema(RECORD)
    fields = json.loads(reader)["fields"]
    assert fields[:-1] == json.loads(RECORD)["fields"]
    assert fields[-1] == {"name": marker, "type": "boolean", "default": True} and marker == "decoded"
    again, other = marked_schema(reader)
    assert other == "_decoded" and len(json.loads(again)["fields"]) == len(fields) + 1


def test_damaged_avro_is_told_by_the_marker(spark, monkeypatch):
    """Spark's decoder gives a record of nulls for a damaged payload; a stand-in does so here."""
    asked = {}

    def decoder(column, schema, options):
        asked.update(options, schema=schema)
        kinds = {"id": "string", "over": "int", "inner": "struct<n:int,tags:array<string>>"}
        nulls = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
        good = F.when(column.cast("string") != "damaged", F.lit(True))
        whole = F.struct(F.when(column.cast("string") == "full", "x").alias("id"), *nulls[1:], good.alias("decoded"))
        return F.when(column.isNotNull(), whole)

    monkeypatch.setattr(messages_module, "from_avro", decoder)
    rows = spark.createDataFrame([("full",), ("empty",), ("damaged",), (None,)], "value string")
    decoded = decode_messages(rows, RECORD, codec="avro")
    assert asked["schema"] == RECORD and asked["mode"] == "PERMISSIVE" and asked["avroSchema"] == marked_schema(RECORD)[0]
    assert decoded.schema["record"].dataType.names == ["id", "over", "inner"]
    got = {r["value"]: r for r in decoded.collect()}
    assert [got[v]["_bad"] for v in ("full", "empty", "damaged", None)] == [False, False, True, True]
    assert got["full"]["record"]["id"] == "x" and got["empty"]["record"] is not None
    assert got["damaged"]["record"] is None
    good, bad = route_dead_letters(decoded)
    assert values(bad.select("payloadString")) == [("",), ("damaged",)] and good.count() == 2


def test_attributes_of_maps_pairs_and_others(spark):
    rows = spark.sql(
        "SELECT map('a', 1) AS m, array(named_struct('k', 'x', 'v', X'79')) AS p, 1 AS n "
        "UNION ALL SELECT null, null, 2"
    )
    pairs = rows.select(attribute_pairs(rows, "m").alias("m"), attribute_pairs(rows, F.col("p")).alias("p"))
    assert [tuple(map(tuple, r["m"])) for r in pairs.collect()] == [(("a", "1"),), ()]
    assert [tuple(map(tuple, r["p"])) for r in pairs.collect()] == [(("x", "y"),), ()]
    with pytest.raises(ValueError, match="attributes"):
        attribute_pairs(rows, "n")


def test_a_replayed_batch_gives_each_letter_once(spark, tmp_path):
    rows = spark.createDataFrame([("bad",), ("worse",)], "value string")
    letters = route_dead_letters(decode_messages(rows, RECORD))[1]
    for fmt in ("parquet", "json"):
        write = dead_letter_files(f"{tmp_path}/{fmt}", fmt)
        for batch, number in ((letters, 0), (letters, 0), (letters.limit(1), 1)):
            write(batch, number)
        back = read_dead_letters(spark, f"{tmp_path}/{fmt}", fmt)
        assert back.groupBy("query", "batch").count().orderBy("batch").collect() == [("none", 0, 2), ("none", 1, 1)]


def test_letters_of_an_earlier_query_stay(spark, feed, tmp_path):
    def run(checkpoint):
        bad = route_dead_letters(decode_messages(feed.read(), RECORD))[1]
        stream = bad.writeStream.option("checkpointLocation", f"{tmp_path}/{checkpoint}")
        stream.trigger(availableNow=True).foreachBatch(dead_letter_files(f"{tmp_path}/dead")).start().awaitTermination()

    feed.send((1, "one"), (2, "two"))
    run("a")
    run("b")
    feed.send((3, "three"))
    run("b")
    back = read_dead_letters(spark, f"{tmp_path}/dead")
    assert back.count() == 5 and back.select("query").distinct().count() == 2
    assert back.where("query = 'none'").count() == 0


def test_a_batch_that_failed_half_way_is_replaced_on_restart(spark, feed, tmp_path):
    feed.send((1, "one"), (2, "two"))
    write, tries = dead_letter_files(f"{tmp_path}/dead"), []

    def failing(batch, number):
        write(batch, number)
        tries.append(number)
        if len(tries) == 1:
            raise RuntimeError("after the write")

    def run():
        bad = route_dead_letters(decode_messages(feed.read(), RECORD))[1]
        stream = bad.writeStream.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True)
        stream.foreachBatch(failing).start().awaitTermination()

    with pytest.raises(Exception, match="after the write"):
        run()
    run()
    assert tries == [0, 0]
    assert values(read_dead_letters(spark, f"{tmp_path}/dead").select("payloadString")) == [("one",), ("two",)]


def test_letters_to_a_sink_without_folders(spark, tmp_path):
    rows = spark.createDataFrame([("bad", [("k", "v")])], "value string, attributes array<struct<key:string,value:string>>")
    letters = route_dead_letters(decode_messages(rows, RECORD))[1]
    dead_letter_messages("json", {"path": f"{tmp_path}/sink"})(letters, 3)
    row = spark.read.json(f"{tmp_path}/sink").first()
    assert row["key"] == "none-3" and json.loads(row["value"])["payloadString"] == "bad"
    assert row["headers"][0]["key"] == "k"


def test_a_failed_query_stops_the_other(spark, feed, tmp_path):
    feed.send((1, "bad"), (2, '{"id":"1"}'))

    def failing(batch, number):
        raise RuntimeError("no room for letters")

    queries = records_to_window_files(
        decode_messages(feed.read(), RECORD), f"{tmp_path}/out", f"{tmp_path}/cp", failing, trigger={"processingTime": "1 second"}
    )
    with pytest.raises(Exception, match="no room for letters"):
        await_all(queries)
    assert not any(q.isActive for q in queries)


def test_batches_write_files_of_their_own_without_waiting(spark, feed, tmp_path):
    out = f"{tmp_path}/out"

    def run(checkpoint="cp", **more):
        messages_to_window_files(
            feed.read(), out, f"{tmp_path}/{checkpoint}", trigger={"availableNow": True}, finalize=False, **more
        ).awaitTermination()

    feed.send((1, "a"), (2, "b"), (70, "c"))
    run()
    first = _files(out)
    assert sorted(first.values()) == [["a", "b"], ["c"]] and all("-pane-" in n and "-0-00-of-01" in n for n in first)
    feed.send((3, "late, and kept"))
    run()
    assert sorted(_files(out).values()) == [["a", "b"], ["c"], ["late, and kept"]]
    # The last batch runs again, as after a crash, and with other shards.
    os.remove(f"{tmp_path}/cp/commits/1")
    crc = f"{tmp_path}/cp/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert sorted(_files(out).values()) == [["a", "b"], ["c"], ["late, and kept"]]
    run("other")
    assert sorted(sum(_files(out).values(), [])) == ["a", "a", "b", "b", "c", "c", "late, and kept", "late, and kept"]
    with pytest.raises(ValueError, match="no P|need a P"):
        run("third", template="W-SS")
    with pytest.raises(ValueError, match="per batch"):
        run("third", writer=write_one_file_per_window)


def test_a_stream_to_folders_of_windows(spark, feed, tmp_path):
    out = f"{tmp_path}/out"
    feed.send((1, "a"), (2, "b"), (70, "c"), (200, "end"))
    messages_to_window_files(
        feed.read(), out, f"{tmp_path}/cp", trigger={"availableNow": True}, writer=write_windowed_partitions, num_shards=2
    ).awaitTermination()
    back = spark.read.text(out)
    assert values(back.select("value", F.substring("window", 10, 6))) == [("a", "000000"), ("b", "000000"), ("c", "000100")]
