from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pytest
from conftest import values
from pyspark.sql import functions as F

from windrow import hadoop
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
from windrow.streaming import tumbling_window, window_length

BRACED = {"year": "{yyyy}", "month": "{MM}", "day": "{dd}", "hour": "{HH}", "minute": "{mm}"}


def _resolve(spark, directory, when, **patterns):
    end = F.lit(when).cast("timestamp")
    return spark.range(1).select(resolve_date_dirs(directory, end, **patterns)).first()[0]


NULLS = {p: None for p in ("year", "month", "day", "hour", "minute")}


@pytest.mark.parametrize(
    "directory, patterns, when, expected",
    [
        ("/o/yyyy/MM/dd/HH/mm/", {}, "2021-02-01 03:04:00", "/o/2021/02/01/03/04/"),
        ("/o/yyyy/MM/dd", {}, "2021-02-01 03:04:00", "/o/2021/02/01/"),
        ("/o/YYYY/MM/DD/", NULLS, "2021-02-01 03:04:00", "/o/2021/02/32/"),
        ("/o/YYYY/MM/DD/", NULLS, "2017-01-08 00:00:00", "/o/2017/01/08/"),
        ("/o/YYYY/MM/DD/", NULLS, "2021-12-31 00:00:00", "/o/2021/12/365/"),
        ("/o/YYYY/MM/DD/", {}, "2021-02-01 03:04:00", "/o/YYYY/02/DD/"),
        ("/o/{MM}/", {"month": "{MM}"}, "2021-02-01 03:04:00", "/o/02/"),
        ("/summary/yyyy/", {}, "2021-02-01 03:04:00", "/su04ary/2021/"),
        ("/o/yy/M/d/H/m/", dict(year="yy", month="M", day="d", hour="H", minute="m"),
         "2021-02-01 03:04:00", "/o/21/2/1/3/4/"),
        ("/o/MMM/", {"month": "MMM"}, "2021-02-01 03:04:00", "/o/Feb/"),
        ("/o/_MMMM_/", {"month": "_MMMM_"}, "2021-02-01 03:04:00", "/o/February/"),
        ("/o/DDD/", {"day": "DDD"}, "2021-02-01 03:04:00", "/o/032/"),
        ("/o/", {"year": ""}, "2021-02-01 03:04:00", "/o/"),
    ],
)
def test_resolve_date_dirs(spark, directory, patterns, when, expected):
    assert _resolve(spark, directory, when, **patterns) == expected


@pytest.mark.parametrize("part", ["year", "month", "day", "hour", "minute"])
def test_resolve_date_dirs_rejects_other_letters(part):
    with pytest.raises(ValueError, match=part):
        resolve_date_dirs("/o/", F.current_timestamp(), **{part: "zz"})


def test_resolve_date_dirs_needs_a_directory():
    with pytest.raises(ValueError, match="directory"):
        resolve_date_dirs(None, F.current_timestamp())


@pytest.mark.parametrize(
    "parts, expected",
    [
        ({}, "output20210201T030300Z-20210201T030400Z-pane-0-last-03-of-12"),
        (dict(prefix=None, template="S-N", suffix=None), "3-12"),
        (dict(prefix="p", template=None, suffix=".txt"), "p.txt"),
        (dict(prefix="a-", template="SSSSS-of-NNN", suffix=".csv"), "a-00003-of-012.csv"),
    ],
)
def test_windowed_filename(spark, parts, expected):
    start = F.lit("2021-02-01 03:03:00").cast("timestamp")
    end = F.lit("2021-02-01 03:04:00").cast("timestamp")
    name = windowed_filename(start, end, F.lit(3), F.lit(12), **parts)
    assert spark.range(1).select(name).first()[0] == expected
    plain = hour_minute_filename(start, end, F.lit(0), F.lit(2), "pre", ".txt")
    assert spark.range(1).select(plain).first()[0] == "pre-03:03-03:04-0-of-2.txt"


def test_window_length():
    assert [window_length(t) for t in ("5s", "12m", "2h", "3 minutes")] == [
        "5 seconds",
        "12 minutes",
        "2 hours",
        "3 minutes",
    ]


def _windowed(spark, rows, length="1 minute"):
    stamped = [(v, dt.datetime.fromisoformat(t)) for v, t in rows]
    return tumbling_window(spark.createDataFrame(stamped, "value string, ts timestamp"), length)


ROWS = [
    ("a", "2021-02-01 00:00:00"),
    ("b", "2021-02-01 00:00:59.999999"),
    ("b", "2021-02-01 00:00:59.999999"),
    ("c", "2021-02-01 00:01:00"),
    ("d", "2021-02-02 00:00:10"),
]


def _lines_of(files):
    found = {}
    for f in files:
        with open(f.removeprefix("file:")) as lines:
            found[os.path.basename(f)] = sorted(lines.read().split("\n")[:-1])
    return found


def test_write_windowed_text(spark, tmp_path):
    out = f"{tmp_path}/out"
    files = write_windowed_text(_windowed(spark, ROWS), f"{out}/{{yyyy}}/{{MM}}-{{dd}}/", **BRACED)
    assert _lines_of(files) == {
        "output20210201T000000Z-20210201T000100Z-pane-0-last-00-of-01": ["a", "b", "b"],
        "output20210201T000100Z-20210201T000200Z-pane-0-last-00-of-01": ["c"],
        "output20210202T000000Z-20210202T000100Z-pane-0-last-00-of-01": ["d"],
    }
    assert files[0].startswith(f"{out}/2021/02-01/") and files[2].startswith(f"{out}/2021/02-02/")
    assert glob.glob(f"{out}/_staging/*/*") == []
    again = write_windowed_text(_windowed(spark, ROWS), f"{out}/{{yyyy}}/{{MM}}-{{dd}}/", **BRACED)
    assert again == files and _lines_of(files) == _lines_of(again)


def test_write_windowed_text_shards_keep_every_copy(spark, tmp_path):
    rows = spark.range(4_000).select(
        F.lit("same").alias("value"), F.lit("2021-02-01 00:00:00").cast("timestamp").alias("ts")
    )
    single = spark.range(500).select(F.col("id").cast("string").alias("value"), F.expr(
        "timestamp '2021-02-01 00:05:00'").alias("ts"))
    both = tumbling_window(rows.union(single))
    files = write_windowed_text(both, f"{tmp_path}/fixed", num_shards=4)
    assert len(files) == 8
    sizes = {name: len(lines) for name, lines in _lines_of(files).items()}
    assert sum(sizes.values()) == 4_500
    same = [n for name, n in sizes.items() if "T000000Z-" in name]
    assert sum(same) == 4_000 and max(same) < 1_400
    few = write_windowed_text(both, f"{tmp_path}/few", num_shards=2, rows_per_shard=None)
    assert len(few) == 4
    raised = write_windowed_text(both, f"{tmp_path}/raised", num_shards=2, rows_per_shard=500)
    assert [n[-8:] for n in sorted(_lines_of(raised))] == [
        *[f"{i:02d}-of-08" for i in range(8)],
        "00-of-02",
        "01-of-02",
    ]
    assert sum(map(len, _lines_of(raised).values())) == 4_500
    opened = write_windowed_text(both, f"{tmp_path}/open", num_shards=None, rows_per_shard=1_000)
    names = sorted(_lines_of(opened))
    assert [n[-8:] for n in names] == ["00-of-04", "01-of-04", "02-of-04", "03-of-04", "00-of-01"]
    assert sum(map(len, _lines_of(opened).values())) == 4_500


def test_heavy_windows_in_an_hour_the_local_clock_repeats(spark, monkeypatch):
    monkeypatch.setenv("TZ", "Europe/Berlin")
    time.tzset()
    try:
        hours = [F.expr(f"timestamp '2021-10-31 0{h}:30:00'").alias("ts") for h in (0, 1)]
        text = F.col("id").cast("string").alias("value")
        frames = [spark.range(n).select(text, ts) for n, ts in zip((50, 500), hours)]
        sharded = shard_lines(tumbling_window(frames[0].union(frames[1]), "1h"), 1, 100)
        start = F.hour("window.start")
        assert values(sharded.groupBy(start, "shards").count()) == [(0, 1, 50), (1, 5, 500)]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_shard_lines_checks_the_number(spark):
    with pytest.raises(ValueError, match="num_shards"):
        shard_lines(_windowed(spark, ROWS), 0)


def test_colliding_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="share the file"):
        write_windowed_text(_windowed(spark, ROWS), f"{tmp_path}/out", template="SS-of-NN")


def test_unwindowed_rows_are_refused(spark, tmp_path):
    rows = _windowed(spark, ROWS).drop("window")
    for write in (write_windowed_text, write_one_file_per_window):
        with pytest.raises(ValueError, match="no window"):
            write(rows, f"{tmp_path}/out/")


def test_other_zones_are_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            write_windowed_text(_windowed(spark, ROWS), f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_temp_dir_and_run_label(spark, tmp_path):
    temp = f"{tmp_path}/temp"
    files = write_windowed_text(
        _windowed(spark, ROWS), f"{tmp_path}/out", temp_dir=temp, run_label="7", suffix=".txt"
    )
    assert os.path.isdir(f"{temp}/_staging") and len(files) == 3
    assert not os.path.exists(f"{tmp_path}/out/_staging")
    assert all(f.endswith(".txt") for f in files)


def test_write_one_file_per_window(spark, tmp_path):
    files = write_one_file_per_window(_windowed(spark, ROWS), f"{tmp_path}/out/pre", suffix=".txt")
    short = [f.removeprefix(f"{tmp_path}/out/") for f in files]
    assert short == [
        "2021-02-01/pre-0000-0001-0-of-1.txt",
        "2021-02-01/pre-0001-0002-0-of-1.txt",
        "2021-02-02/pre-0000-0001-0-of-1.txt",
    ]


def test_write_one_file_per_window_legacy_names(spark, tmp_path):
    first_day = _windowed(spark, ROWS[:4])
    files = write_one_file_per_window(first_day, f"{tmp_path}/out/", legacy_names=True)
    assert [os.path.basename(f) for f in files] == ["-0000-0001-0-of-1", "-0001-0002-0-of-1"]
    with pytest.raises(ValueError, match="share the file"):
        write_one_file_per_window(_windowed(spark, ROWS), f"{tmp_path}/x/", legacy_names=True)
    with pytest.raises(ValueError, match="exists already"):
        write_one_file_per_window(_windowed(spark, ROWS[4:]), f"{tmp_path}/out/", legacy_names=True)


def test_write_single_text(spark, tmp_path):
    rows = spark.range(1_000).repartition(4).select(F.concat(F.lit("x\r,"), "id").alias("value"))
    target = f"{tmp_path}/out.csv"
    expected = sorted(r[0] for r in rows.collect())
    for _ in range(2):
        assert write_single_text(rows, target) == [target]
        with open(target, newline="\n") as f:
            assert sorted(f.read().split("\n")[:-1]) == expected
    parts = write_single_text(rows, f"{tmp_path}/big.csv", files="parts")
    assert [p[-14:] for p in parts] == [f"{i:05d}-of-00004" for i in range(4)]
    got = []
    for p in parts:
        with open(p, newline="\n") as f:
            got += f.read().split("\n")[:-1]
    assert sorted(got) == expected
    assert glob.glob(f"{tmp_path}/*staging*") == []


def test_write_single_text_of_nothing(spark, tmp_path):
    target = f"{tmp_path}/none.csv"
    assert write_single_text(spark.range(0).select(F.lit("x").alias("value")), target) == [target]
    assert os.path.getsize(target) == 0


def test_append_table(spark, tmp_path):
    rows = spark.createDataFrame([("1", 2)], "id string, n int")
    for _ in range(2):
        append_table(rows, "append_test", options={"path": f"{tmp_path}/t"})
    assert values(spark.table("append_test")) == [("1", 2), ("1", 2)]
    spark.sql("DROP TABLE append_test")


def test_hadoop_join():
    assert hadoop.join("s3a://b/x/", "/y/", "z") == "s3a://b/x/y/z"


def test_each_form_of_a_single_text_removes_the_other(spark, tmp_path):
    target = f"{tmp_path}/out.csv"
    many = spark.range(0, 40, 1, 4).selectExpr("cast(id as string) as value")
    write_single_text(many, target, files="parts")
    write_single_text(many, target)
    assert [n for n in sorted(os.listdir(tmp_path)) if n.startswith("out")] == ["out.csv"]
    write_single_text(many, target, files="parts")
    assert [n for n in sorted(os.listdir(tmp_path)) if n.startswith("out")] == [f"out.csv-{i:05d}-of-00004" for i in range(4)]


def test_a_failed_rename_loses_nothing(spark, tmp_path):
    target = tmp_path / "kept.txt"
    target.write_text("old")
    with pytest.raises(Exception):
        hadoop.replace_all(spark, [(f"{tmp_path}/missing", str(target))])
    assert target.read_text() == "old"


def test_a_given_shard_number_is_exact(spark):
    rows = spark.range(50).selectExpr("cast(id as string) as value", "timestamp'2021-02-01 00:00:10' as ts")
    windowed = tumbling_window(rows, "1 minute")
    assert shard_lines(windowed, 2).select("shards").distinct().collect() == [(2,)]
    assert shard_lines(windowed, None, 10).select("shards").distinct().collect() == [(5,)]


def _all_lines(out):
    found = []
    for folder, folders, files in os.walk(out):
        folders[:] = [f for f in folders if not f.startswith("_")]
        for name in files:
            if not name.startswith("."):
                with open(os.path.join(folder, name)) as f:
                    found += f.read().split("\n")[:-1]
    return sorted(found)


def _numbered(spark, n, minute=0):
    at = F.expr(f"timestamp '2021-02-01 00:0{minute}:10'").alias("ts")
    return tumbling_window(spark.range(n).select(F.col("id").cast("string").alias("value"), at))


def test_a_window_written_again_keeps_no_older_shards(spark, tmp_path):
    out = f"{tmp_path}/out"
    write_windowed_text(_numbered(spark, 10), out, num_shards=None, rows_per_shard=3)
    write_windowed_text(_numbered(spark, 4, minute=1), out, num_shards=2)
    (tmp_path / "out" / "not ours-00-of-09").write_text("")
    write_windowed_text(_numbered(spark, 3), out, num_shards=None, rows_per_shard=5)
    assert _all_lines(out) == sorted(["0", "1", "2", "0", "1", "2", "3"])
    # Other settings are another output: their files stay.
    write_windowed_text(_numbered(spark, 2), out, suffix=".txt")
    write_windowed_text(_numbered(spark, 5, minute=1), out, num_shards=3)
    assert _all_lines(out) == sorted(["0", "1", "2", "0", "1", "2", "3", "4", "0", "1"])
    assert os.path.exists(f"{out}/not ours-00-of-09")


@pytest.mark.parametrize("renames", [0, 1, 2, 3])
def test_a_broken_off_write_is_finished_by_the_next(spark, tmp_path, monkeypatch, renames):
    out = f"{tmp_path}/out"
    write_windowed_text(_numbered(spark, 40), out, num_shards=4)
    whole, done = hadoop.replace_all, []

    def killed(session, moves, moved_before=False):
        moves = list(moves)
        if not moved_before:
            return whole(session, moves)
        whole(session, moves[:renames], moved_before)
        done.append(len(moves))
        raise KeyboardInterrupt

    monkeypatch.setattr(hadoop, "replace_all", killed)
    with pytest.raises(KeyboardInterrupt):
        write_windowed_text(_numbered(spark, 30), out, num_shards=3)
    monkeypatch.undo()
    assert done == [3] and glob.glob(f"{out}/_staging/*/*/_journal.json")
    write_windowed_text(_numbered(spark, 5, minute=1), out)
    assert _all_lines(out) == sorted([str(i) for i in range(30)] + [str(i) for i in range(5)])
    assert glob.glob(f"{out}/_staging/*/*") == []
    names = [n for n in os.listdir(out) if n[0] not in "._"]
    assert sorted(n[-8:] for n in names) == ["00-of-01", "00-of-03", "01-of-03", "02-of-03"]


def test_a_write_broken_off_late_is_finished(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    write_windowed_text(_numbered(spark, 40), out, num_shards=4)
    for step in ("delete", "write_text"):
        whole, calls = getattr(hadoop, step), []

        def killed(*args):
            calls.append(args)
            # The first deletion clears the staging folder, the first text is the journal.
            if len(calls) == 2:
                raise KeyboardInterrupt
            return whole(*args)

        monkeypatch.setattr(hadoop, step, killed)
        with pytest.raises(KeyboardInterrupt):
            write_windowed_text(_numbered(spark, 7), out, num_shards=2)
        monkeypatch.undo()
    write_windowed_text(_numbered(spark, 1, minute=1), out)
    assert _all_lines(out) == sorted([str(i) for i in range(7)] + ["0"])


def test_panes_do_not_replace_each_other(spark, tmp_path):
    out = f"{tmp_path}/out"
    for pane, n in (("pane-1", 4), ("pane-2", 2), ("pane-2", 1)):
        write_windowed_text(_numbered(spark, n), out, pane=pane, num_shards=2)
    assert _all_lines(out) == ["0", "0", "1", "2", "3"]
    with pytest.raises(ValueError, match="no P"):
        write_windowed_text(_numbered(spark, 1), out, pane="pane-3", template="W-SS")


def test_write_windowed_partitions(spark, tmp_path):
    out = f"{tmp_path}/out"
    write_windowed_partitions(_windowed(spark, ROWS), out, num_shards=3)
    write_windowed_partitions(_windowed(spark, [("x", "2021-02-01 00:00:30")]), out)
    back = spark.read.text(out).selectExpr("cast(day as string)", "window", "value")
    assert values(back) == [
        ("2021-02-01", "20210201T000000Z-20210201T000100Z", "x"),
        ("2021-02-01", "20210201T000100Z-20210201T000200Z", "c"),
        ("2021-02-02", "20210202T000000Z-20210202T000100Z", "d"),
    ]
    write_windowed_partitions(_windowed(spark, ROWS).where("false"), out)
    assert spark.read.text(out).count() == 3
    with pytest.raises(ValueError, match="no window"):
        write_windowed_partitions(_windowed(spark, ROWS).drop("window"), out)


def test_files_move_between_file_systems(spark, tmp_path):
    (tmp_path / "a").write_text("new")
    (tmp_path / "b").write_text("old")
    # Hadoop's viewfs over the local disk is another file system by its address.
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.far.link./d", f"file://{tmp_path}")
    hadoop.replace_all(spark, [("viewfs://far/d/a", f"{tmp_path}/b")])
    assert (tmp_path / "b").read_text() == "new" and not (tmp_path / "a").exists()
    hadoop.replace_all(spark, [("viewfs://far/d/a", f"{tmp_path}/b")], moved_before=True)
    assert (tmp_path / "b").read_text() == "new"
