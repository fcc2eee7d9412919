from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from conftest import DELIVERIES, HEADER, MATCHES, plan, values
from pyspark.sql import functions as F

from windrow.plans import match_batsman_runs, outs_by_player_and_kind
from windrow.plans.batch import joined_match_runs, match_lines, outs_lines
from windrow.schemas import SCORE_OUT
from windrow.session import scratch_dir


def test_outs(lines, deliveries):
    counts = values(outs_by_player_and_kind(deliveries))
    assert counts == [("Ann", "bowled", 2), ("Bo", "caught", 1)]
    assert values(outs_lines(lines([HEADER, *DELIVERIES]))) == [("Ann,bowled,2",), ("Bo,caught,1",)]


def test_outs_fails_where_the_kind_is_missing(lines):
    with pytest.raises(Exception, match="position 12"):
        outs_by_player_and_kind(lines([DELIVERIES[2].split(",caught")[0]])).collect()


def test_outs_plan(deliveries):
    text = plan(outs_by_player_and_kind(deliveries))
    assert "partial_count" in text and "Python" not in text
    assert text.count("Exchange") == 1


def test_match_runs(deliveries, matches):
    flat = match_batsman_runs(deliveries, matches)
    assert [f.name for f in flat.schema] == [f.name for f in SCORE_OUT]
    expected = [("100", "Ann", 5), ("100", "Bo", 0), ("101", "Ann", 6)]
    assert values(flat.select("id", "batsman", "total_runs")) == expected
    assert flat.where("match is not null").count() == 0
    nested = match_batsman_runs(deliveries, matches, include_match=True)
    assert values(nested.select("id", "match.player_of_match", "match.result_margin")) == [
        ("100", "Ann", 1),
        ("100", "Ann", 1),
        ("101", "Flo", 1),
    ]
    assert values(match_lines(joined_match_runs(deliveries, matches))) == [
        ("100,Ann,5,Ann",),
        ("100,Bo,0,Ann",),
        ("101,Ann,6,Flo",),
    ]


def test_match_runs_violations(lines, deliveries):
    without = lines([MATCHES[0], MATCHES[2]])
    with pytest.raises(Exception, match="no lookup row for key 101"):
        match_batsman_runs(deliveries, without).count()
    assert match_batsman_runs(deliveries, without, "drop").count() == 2
    with pytest.raises(Exception, match="several lookup rows for key 102"):
        match_batsman_runs(deliveries, lines([*MATCHES, MATCHES[2]])).collect()
    with pytest.raises(Exception, match="malformed line"):
        match_batsman_runs(lines([HEADER, *DELIVERIES]), without).collect()


def test_match_runs_plan(deliveries, matches):
    text = plan(match_batsman_runs(deliveries, matches))
    assert "partial_sum" in text and "Python" not in text and "Cartesian" not in text


def test_scratch_dir_uses_the_shared_folder():
    unset = SimpleNamespace(conf={})
    assert os.path.isdir(scratch_dir(unset, "x"))
    shared = SimpleNamespace(conf={"spark.checkpoint.dir": "s3a://bucket/shared/"})
    assert scratch_dir(shared, "x").startswith("s3a://bucket/shared/windrow-x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")


def test_runs_are_summed_and_joined_in_a_fixed_number_of_partitions(spark, lines, matches):
    """File splits and merged partitions grow with the input, and so would sums and sorts on them."""
    numbers = spark.range(0, 4_000, numPartitions=8)
    hot = numbers.select(F.concat(F.lit("100,1,0,1,Ann,Bo,Cy,"), F.col("id") % 7, F.lit(",0,4,0,0,NA,NA,NA,NA,Reds,Blues")).alias("value"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = match_batsman_runs(hot, matches.limit(3))
        left = plan(runs).split("SortMergeJoin")[1].split("Sort [_key")[0]
        assert left.count("Exchange") == left.count("REPARTITION_BY_NUM") == 2
        # The rows of one key are dealt to several partitions by where they come from.
        assert "SPARK_PARTITION_ID()" in left
        got = [(r["id"], r["batsman"], r["total_runs"]) for r in runs.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [("100", "Ann", sum(i % 7 for i in range(4_000)))]
