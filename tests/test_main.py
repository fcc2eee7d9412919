from __future__ import annotations

import os

import pytest
from conftest import DELIVERIES, HEADER, MATCHES, values

from windrow.__main__ import run
from windrow.sources import read_dead_letters

STREAM = ["--input-format", "parquet", "--input-schema", "value string, ts timestamp"]


def _write(path, rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_outs_job(spark, tmp_path):
    source = _write(tmp_path / "in.csv", [HEADER, *DELIVERIES])
    run(spark, ["outs", "--input-file", source, "--output-file", f"{tmp_path}/out.csv"])
    assert sorted((tmp_path / "out.csv").read_text().split()) == ["Ann,bowled,2", "Bo,caught,1"]


def test_match_runs_job(spark, tmp_path):
    files = [
        "--deliveries", _write(tmp_path / "d.csv", DELIVERIES),
        "--matches", _write(tmp_path / "m.csv", MATCHES),
    ]
    spark.sql("DROP TABLE IF EXISTS runs_test")
    for _ in range(2):
        run(spark, ["match-runs", *files, "--table", "runs_test"])
    table = spark.table("runs_test")
    assert values(table.select("id", "batsman", "total_runs").distinct()) == [
        ("100", "Ann", 5),
        ("100", "Bo", 0),
        ("101", "Ann", 6),
    ]
    assert table.count() == 6
    spark.sql("DROP TABLE runs_test")


def _stream(spark, tmp_path, rows):
    spark.sql(
        "SELECT * FROM VALUES "
        + ", ".join(f"('{v}', TIMESTAMP '2024-01-01 {t}')" for t, v in rows)
        + " AS t(value, ts)"
    ).write.parquet(f"{tmp_path}/in")
    return [
        *STREAM,
        "--input-option", f"path={tmp_path}/in",
        "--time-column", "ts",
        "--checkpoint", f"{tmp_path}/cp",
        "--output-directory", f"{tmp_path}/out/{{yyyy}}",
        "--year-pattern", "{yyyy}",
        "--user-temp-location", f"{tmp_path}/temp",
        "--output-filename-prefix", "windowed-file",
        "--output-filename-suffix", ".txt",
        "--output-shard-template=-W-SS",
        "--month-pattern", "{MM}", "--day-pattern", "{dd}",
        "--hour-pattern", "{HH}", "--minute-pattern", "{mm}",
        "--available-now",
    ]


@pytest.mark.parametrize("shards", ["1", "0"])
def test_messages_job(spark, tmp_path, shards):
    args = _stream(spark, tmp_path, [("00:00:01", "a"), ("00:00:02", "b"), ("00:09:00", "end")])
    run(spark, ["messages", *args, "--window-duration", "5m", "--num-shards", shards])
    name = "windowed-file-20240101T000000Z-20240101T000500Z-00.txt"
    assert sorted((tmp_path / "out" / "2024" / name).read_text().split()) == ["a", "b"]


def test_records_job(spark, tmp_path):
    schema = '{"type":"record","name":"R","fields":[{"name":"n","type":"int"}]}'
    rows = [("00:00:01", '{"n":1}'), ("00:00:02", "bad"), ("00:09:00", '{"n":2}')]
    args = _stream(spark, tmp_path, rows)
    run(spark, [
        "records", *args,
        "--schema-path", _write(tmp_path / "r.avsc", [schema]),
        "--dead-letter-path", f"{tmp_path}/dead",
    ])
    name = "windowed-file-20240101T000000Z-20240101T000100Z-00.txt"
    assert (tmp_path / "out" / "2024" / name).read_text() == "1,\n"
    assert values(read_dead_letters(spark, f"{tmp_path}/dead").select("payloadString")) == [("bad",)]
    assert os.listdir(f"{tmp_path}/out") == ["2024"]
