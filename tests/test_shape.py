from __future__ import annotations

import pytest
from conftest import DELIVERIES, HEADER, plan, values
from pyspark.sql import Observation
from pyspark.sql import functions as F

from windrow.operators import (
    attach_nested,
    decode_key,
    filter_flag,
    format_line,
    key_by,
    key_match_batsman,
    key_player_kind,
    parse_delivery,
    parse_match,
    records_to_rows,
    row_to_delimited,
    split_fields,
    to_flat_record,
    to_nested_record,
)
from windrow.schemas import DELIVERY, SCORE_OUT


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a,,b,,", ["a", "", "b"]),
        ("a,b", ["a", "b"]),
        ('"a,b",c', ['"a', 'b"', "c"]),
        (",,", []),
        ("", [""]),
        (",x", ["", "x"]),
        (" a , b ", [" a ", " b "]),
    ],
)
def test_split_fields(lines, line, expected):
    assert split_fields(lines([line])).first()["cols"] == expected


def test_split_fields_first_keeps_the_rest_together(lines):
    assert split_fields(lines(["a,b,c,d,"]), first=2).first()["cols"] == ["a", "b", "c,d"]


def test_filter_flag(lines, deliveries):
    kept = filter_flag(split_fields(deliveries)).select("value")
    assert values(kept) == [(line,) for line in sorted(DELIVERIES[2:])]
    spaced = DELIVERIES[2].replace(",1,caught", ", 1,caught")
    assert filter_flag(split_fields(lines([spaced, HEADER]))).count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_filter_flag_fails_on_short_rows(spark, lines, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="position 11"):
            filter_flag(split_fields(lines(["a,b,c,d,e,f,g,h,i,j,k"]))).count()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_filter_flag_ignores_case(lines):
    rows = split_fields(lines(["a,Yes", "b,YES", "c,no"]))
    assert values(filter_flag(rows, 1, "yes").select("value")) == [("a,Yes",), ("b,YES",)]


def test_parse_delivery(deliveries):
    rows = parse_delivery(deliveries)
    assert [f.name for f in rows.schema] == [f.name for f in DELIVERY]
    assert [f.dataType for f in rows.schema] == [f.dataType for f in DELIVERY]
    first = rows.first()
    assert (first["id"], first["over"], first["batsman_runs"]) == ("100", 0, 4)


BAD_DELIVERIES = [
    HEADER,
    DELIVERIES[0].replace("Reds,Blues", "Reds,"),
    DELIVERIES[0].replace(",0,0,NA", ",0, 1,NA"),
    DELIVERIES[0].replace(",0,0,NA", ",0,,NA"),
    DELIVERIES[0].replace(",4,0,4,", ",1.0,0,4,"),
    DELIVERIES[0].replace(",4,0,4,", ",99999999999,0,4,"),
    "a,b",
    "",
]


@pytest.mark.parametrize("line", BAD_DELIVERIES)
def test_parse_delivery_fails_fast_even_when_pruned(lines, line):
    rows = parse_delivery(lines([DELIVERIES[0], line]))
    with pytest.raises(Exception, match="malformed line"):
        rows.select("id").collect()
    with pytest.raises(Exception, match="malformed line"):
        rows.count()


def test_parse_delivery_accepts_what_the_int_parser_accepts(lines):
    signs = DELIVERIES[0].replace(",4,0,4,", ",+4,-2147483648,2147483647,")
    long_line = DELIVERIES[0] + ",more,fields"
    zeros = DELIVERIES[0].replace(",4,0,4,", ",000000000000004,0,4,")
    empty_last = DELIVERIES[0].replace("Reds,Blues", "Reds,,x")
    rows = parse_delivery(lines([signs, long_line, zeros, empty_last])).collect()
    assert (rows[0]["batsman_runs"], rows[0]["extra_runs"]) == (4, -2147483648)
    assert rows[0]["total_runs"] == 2147483647
    assert rows[1]["bowling_team"] == "Blues"
    assert rows[2]["batsman_runs"] == 4
    assert rows[3]["bowling_team"] == ""


def test_parse_delivery_modes(lines):
    source = lines(DELIVERIES + BAD_DELIVERIES)
    assert parse_delivery(source, "DROPMALFORMED").count() == 5
    marked = parse_delivery(source, "PERMISSIVE")
    bad = [r["_corrupt"] for r in marked.where("_corrupt is not null").collect()]
    assert sorted(bad) == sorted(BAD_DELIVERIES)
    assert marked.where("_corrupt is not null and id is not null").count() == 0
    with pytest.raises(ValueError, match="mode"):
        parse_delivery(source, "OTHER")


def test_parse_match_drops_and_counts(matches):
    seen = Observation()
    rows = parse_match(matches, observation=seen)
    assert values(rows.select("id")) == [("100",), ("101",), ("102",)]
    assert seen.get["dropped"] == 1
    assert "date" not in rows.columns and "result_margin" not in rows.columns
    with pytest.raises(Exception, match="malformed line"):
        parse_match(matches, "FAILFAST").count()


def test_parse_match_keeps_header_as_data(lines):
    header = "id,city,date,player_of_match,venue,neutral_venue,team1,team2,toss_winner,"
    header += "toss_decision,winner,result,result_margin,eliminator,method,umpire1,umpire2"
    assert parse_match(lines([header])).first()["id"] == "id"


def test_parse_match_extras(matches):
    rows = parse_match(matches, extras=True).select("id", "match_date", "result_margin")
    got = [(i, str(d), m) for i, d, m in values(rows)]
    assert got == [
        ("100", "2008-04-18", 12),
        ("101", "2008-04-19", 0),
        ("102", "2008-04-20", 3),
    ]


def test_keys(deliveries, matches):
    kinds = key_player_kind(filter_flag(split_fields(deliveries)))
    assert values(kinds) == [("Ann,bowled", 1), ("Ann,bowled", 1), ("Bo,caught", 1)]
    runs = key_match_batsman(parse_delivery(deliveries))
    assert values(runs)[0] == ("100,Ann", 1)
    assert values(decode_key(runs).select("id", "batsman").distinct()) == [
        ("100", "Ann"),
        ("100", "Bo"),
        ("101", "Ann"),
    ]
    assert values(key_by(parse_match(matches)).select("key"))[0] == ("100",)


def test_decode_key_fails_without_batsman(spark):
    with pytest.raises(Exception, match="position 1"):
        decode_key(spark.createDataFrame([("100,",)], "key string")).select("batsman").collect()


def test_text_forms(spark):
    df = spark.createDataFrame([(1, None, (2, "x"))], "a int, b string, c struct<d:int,e:string>")
    assert row_to_delimited(df.select("a", "b")).first()["value"] == "1,null,"
    assert format_line(df, "b", "a").first()["value"] == "null,1"
    assert row_to_delimited(df).first()["value"] == '1,null,{"d":2,"e":"x"},'
    kept = row_to_delimited(df.select("a", "b"), keep=["a"])
    assert (kept.first()["value"], kept.first()["a"]) == ("null,", 1)
    assert records_to_rows(df, "c").columns == ["d", "e"]


def test_records(deliveries, matches):
    scores = parse_delivery(deliveries)
    flat = to_flat_record(scores)
    assert [f.name for f in flat.schema] == [f.name for f in SCORE_OUT]
    assert flat.where("match is not null").count() == 0
    both = scores.join(parse_match(matches).withColumnRenamed("id", "mid"), F.expr("id = mid"))
    names = [c for c in parse_match(matches).columns if c != "id"]
    folded = attach_nested(both, ["mid", *names]).withColumn(
        "match", F.expr("named_struct('id', match.mid)")
    )
    full = both.withColumn("match", F.struct(F.col("mid").alias("id"), *names))
    nested = to_nested_record(full)
    assert [f.name for f in nested.schema["match"].dataType] == [
        f.name for f in SCORE_OUT["match"].dataType
    ]
    assert {r["match"]["result_margin"] for r in nested.collect()} == {1}
    assert {r["match"]["id"] for r in folded.collect()} == {"100", "101"}
    with pytest.raises(Exception, match="without a match"):
        to_nested_record(full.withColumn("match", F.when(F.col("id") != "100", F.col("match")))
                         ).collect()


def test_shaping_needs_no_python(deliveries):
    assert "Python" not in plan(parse_delivery(deliveries))
