from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pytest
from conftest import plan, values
from pyspark.sql import functions as F

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
    cogroup,
    count_by_key,
    group_by_key,
    lookup_join_strict,
    parse_delivery,
    skew,
    sum_by_key,
    sum_runs_by_match_batsman,
)


def test_group_by_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "key string, value int")
    lists = group_by_key(rows).collect()
    got = {r["key"]: (r["chunk"], sorted(r["values"], key=str)) for r in lists}
    assert got == {"a": (0, [1, 2]), "b": (0, [None])}


@pytest.mark.parametrize("bound", [skew.MAX_BROADCAST_KEYS, 1])
def test_group_by_key_slices_hot_keys_and_copies(spark, monkeypatch, bound):
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", bound)
    copies = spark.range(5_000).select(F.lit("copies").alias("key"), F.lit(7).alias("value"))
    spread = spark.range(3_000).select(F.lit("hot").alias("key"), F.col("id").cast("int"))
    nulls = spark.range(300).select(F.lit(None).cast("string"), F.lit(None).cast("int"))
    cold = spark.createDataFrame([("cold", 1), ("cold", 1)], "key string, value int")
    rows = copies.union(spread).union(nulls).union(cold)
    grouped = group_by_key(rows, max_values=100)
    sizes = grouped.select("key", F.size("values").alias("n")).collect()
    per_key = {}
    for r in sizes:
        per_key.setdefault(r["key"], []).append(r["n"])
    assert {k: sum(v) for k, v in per_key.items()} == {
        "copies": 5_000,
        "hot": 3_000,
        None: 300,
        "cold": 2,
    }
    assert len(per_key["cold"]) == 1
    assert len(per_key["hot"]) > 20 and len(per_key["copies"]) > 20
    assert max(per_key["copies"]) <= 800 and max(per_key["hot"]) <= 400
    back = grouped.select("key", F.explode("values").alias("value"))
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_sums_and_counts(deliveries, spark):
    scores = parse_delivery(deliveries)
    rows = spark.createDataFrame([("a", 2**31 - 1), ("a", 1)], "key string, value int")
    assert values(sum_by_key(rows)) == [("a", 2**31)]
    assert values(count_by_key(rows)) == [("a", 2)]
    totals = sum_runs_by_match_batsman(scores)
    assert values(totals.select("id", "batsman", "total_runs")) == [
        ("100", "Ann", 5),
        ("100", "Bo", 0),
        ("101", "Ann", 6),
    ]
    row = totals.first()
    assert row["inning"] == 0 and row["bowler"] is None and row["batsman_runs"] == 0
    assert "partial_sum" in plan(totals) and "Python" not in plan(totals)


def test_empty_batsman_is_kept(spark):
    rows = spark.createDataFrame([("1", "", 3)], "id string, batsman string, batsman_runs int")
    assert sum_runs_by_match_batsman(rows).first()["total_runs"] == 3


def _cogroup_rows(grouped):
    return sorted(
        (r["k"], r["chunk"], sorted(x["a"] for x in r["left"]), sorted(x["b"] for x in r["right"]))
        for r in grouped.collect()
    )


def test_cogroup(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, a string")
    right = spark.createDataFrame([(1, 10), (3, 30), (3, 31)], "k int, b int")
    assert _cogroup_rows(cogroup(left, right, "k")) == [
        (1, 0, ["x", "y"], [10]),
        (2, 0, ["z"], []),
        (3, 0, [], [30, 31]),
    ]
    # The rows move once, to their key; the one join is with the broadcast list of heavy keys.
    steps = plan(cogroup(left, right, "k"))
    assert "SortMergeJoin" not in steps and steps.count("BroadcastHashJoin") == 1 and "Python" not in steps


def test_cogroup_slices_hot_keys(spark):
    left = spark.range(2_000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("a"))
    right = spark.range(1_000).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    grouped = cogroup(left, right, "k", max_values=100)
    assert grouped.count() > 10
    a = grouped.select(F.explode("left").alias("s")).select("s.a")
    b = grouped.select(F.explode("right").alias("s")).select("s.b")
    assert values(a.groupBy("a").count()) == [(i, 400) for i in range(5)]
    assert values(b) == [(i,) for i in range(1_000)]


LEFT = "id string, runs int"
RIGHT = "id string, city string"


def _join(spark, left, right, mode):
    a = spark.createDataFrame(left, LEFT)
    b = spark.createDataFrame(right, RIGHT)
    return lookup_join_strict(a, b, "id", mode)


@pytest.mark.parametrize("mode", ["error", "drop"])
def test_lookup_join_one_match(spark, mode):
    joined = _join(spark, [("1", 4), ("1", 5)], [("1", "Pune"), ("2", "Goa")], mode)
    got = sorted((r["id"], r["runs"], r["match"]["city"]) for r in joined.collect())
    assert got == [("1", 4, "Pune"), ("1", 5, "Pune")]


@pytest.mark.parametrize(
    "left, right, message",
    [
        ([("1", 4), ("3", 1)], [("1", "Pune")], "no lookup row for key 3"),
        ([("1", 4)], [("1", "Pune"), ("1", "Goa")], "several lookup rows for key 1"),
        ([("1", 4)], [("1", "Pune"), ("2", "Goa"), ("2", "Goa")], "several lookup rows for key 2"),
        ([], [("2", "Goa"), ("2", "Goa")], "several lookup rows for key 2"),
        ([("1", 4)], [], "no lookup row for key 1"),
    ],
)
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_join_violations(spark, left, right, message, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        actions = (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("id").count())
        for action in actions:
            with pytest.raises(Exception, match=message):
                action(_join(spark, left, right, "error"))
        kept = _join(spark, left, right, "drop")
        single = {k for k, _ in right if [r[0] for r in right].count(k) == 1}
        assert kept.count() == sum(k in single for k, _ in left)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_lookup_join_rejects_unknown_mode(spark):
    with pytest.raises(ValueError, match="on_violation"):
        _join(spark, [], [], "other")


def _numbers(spark):
    return spark.range(1_000).select((F.col("id") % 2).alias("key"), F.col("id").alias("value"))


def test_row_functions(spark):
    def twice(batches):
        for pdf in batches:
            yield pdf.loc[pdf.index.repeat(pdf["value"] % 3)]

    rows = _numbers(spark)
    native = rows.select("*", F.explode(F.expr("array_repeat(1, cast(value % 3 as int))"))).count()
    assert flat_map_fn(rows, twice, rows.schema).count() == native
    added = rows.select(map_fn(lambda a, b: a + b, "long", "key", "value").alias("s"))
    assert added.agg(F.sum("s")).first()[0] == sum(i + i % 2 for i in range(1_000))
    assert rows.where(predicate_fn(lambda v: v < 10, "value")).count() == 10


def test_group_fn_slices_with_combine(spark):
    def total(pdf):
        return pdf.groupby("key", as_index=False).agg(total=("value", "sum"))

    def fold(pdf):
        return pdf.groupby("key", as_index=False).agg(total=("total", "sum"))

    rows = _numbers(spark)
    expected = values(rows.groupBy("key").agg(F.sum("value")))
    schema = "key long, total long"
    assert values(group_fn(rows, ["key"], total, schema)) == expected
    assert values(group_fn(rows, ["key"], total, schema, fold, max_rows=50)) == expected
    with pytest.raises(ValueError, match="combine"):
        group_fn(rows, ["key"], total, schema, max_rows=50)


def test_cogroup_fn_slices_left(spark):
    def attach(left, right):
        name = right["name"].iloc[0] if len(right) else None
        return left.assign(name=name)

    rows = _numbers(spark)
    names = spark.createDataFrame([(0, "even"), (2, "none")], "key long, name string")
    schema = "key long, value long, name string"
    expected = values(rows.join(names, "key", "left").select("key", "value", "name"))

    def as_text(df):
        return sorted(str(tuple(r)) for r in df.collect())

    assert as_text(cogroup_fn(rows, names, ["key"], attach, schema)) == sorted(map(str, expected))
    sliced = cogroup_fn(rows, names, ["key"], attach, schema, per_left_row=True, max_rows=100)
    assert as_text(sliced) == sorted(map(str, expected))
    with pytest.raises(ValueError, match="left key"):
        cogroup_fn(rows, names, ["key"], attach, schema, max_rows=100)
    with pytest.raises(ValueError, match="right key"):
        cogroup_fn(names, rows, ["key"], attach, schema, max_rows=100)


def test_composite(spark):
    chain = composite(lambda d: d.where("value < 4"), sum_by_key)
    assert values(_numbers(spark).transform(chain)) == [(0, 2), (1, 4)]


@pytest.mark.parametrize("threshold", ["-1", "10000000"])
def test_lookup_checks_survive_later_steps(spark, threshold):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    repeated = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "id string, city string")
    lacking = spark.createDataFrame([("a", "x")], "id string, city string")
    steps = [
        lambda j: j.where("v = 1"),
        lambda j: j.where("v is not null"),
        lambda j: j.where("id = 'a'"),
        lambda j: j.where("match.city = 'x'"),
        lambda j: j.join(left.withColumnRenamed("v", "w"), "id"),
        lambda j: j.select("v"),
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for right in (repeated, lacking):
            for step in steps:
                with pytest.raises(Exception, match="lookup row"):
                    step(lookup_join_strict(left, right)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_list_passes_the_limit(spark):
    rows = spark.range(1000).selectExpr("id % 2 as key", "id as value")
    lists = group_by_key(rows, max_values=10).collect()
    assert max(len(r["values"]) for r in lists) <= 10
    assert sorted(v for r in lists for v in r["values"]) == list(range(1000))
    assert len({(r["key"], r["chunk"]) for r in lists}) == len(lists)


def test_groups_of_any_size_run_unless_a_limit_is_given(spark):
    rows = spark.range(300).selectExpr("'k' as key", "id as value")
    total = lambda pdf: pdf.groupby("key", as_index=False)["value"].sum()
    assert values(group_fn(rows, ["key"], total, "key string, value long")) == [("k", 44850)]


def test_values_come_back_as_they_were_light_or_heavy(spark):
    """-0.0, maps and variants, in lists of one and of many chunks, by the same plan."""
    rows = spark.range(60).selectExpr(
        "'k' as key",
        "named_struct('d', 0.0D * (2 * (id % 2) - 1), 'm', map('n', id), 'v', parse_json(cast(id as string))) as value",
    )
    plans = set()
    for limit in (7, 1_000):
        lists = group_by_key(rows, max_values=limit)
        back = lists.select(F.explode("values").alias("v"), F.size("values").alias("n"))
        got = back.selectExpr("cast(v.d as string) as d", "v.m['n'] as m", "cast(v.v as int) as v", "n").collect()
        assert sorted((r["d"], r["m"], r["v"]) for r in got) == sorted(("0.0" if i % 2 else "-0.0", i, i) for i in range(60))
        assert max(r["n"] for r in got) <= limit
        plans.add(tuple(line.split("(")[0].strip() for line in lists._jdf.queryExecution().optimizedPlan().toString().split("\n")))
    assert len({len(p) for p in plans}) == 1
    assert group_by_key(rows, max_values=1_000).select("chunk").collect() == [(0,)]


def test_grouping_runs_nothing_until_it_is_read(spark):
    failing = spark.range(10).select(F.lit("k").alias("key"), F.expr("raise_error('read')").cast("int").alias("value"))
    lists = group_by_key(failing, max_values=2)
    both = cogroup(failing, failing, "key", max_values=2)
    assert lists.columns == ["key", "chunk", "values"] and both.columns == ["key", "chunk", "left", "right"]
    with pytest.raises(Exception, match="read"):
        lists.collect()
    assert group_by_key(spark.range(0).selectExpr("'k' as key", "id as value")).collect() == []


def test_group_batches_fn_reads_a_group_in_batches(spark):
    def sizes(batches):
        key, seen = None, []
        for pdf in batches:
            key = int(pdf["key"].iloc[0])
            seen.append(len(pdf))
        yield pd.DataFrame({"key": [key], "n": [sum(seen)], "longest": [max(seen)]})

    rows = spark.range(5_000).select((F.col("id") % 10 == 0).cast("long").alias("key"), F.col("id").alias("value"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = values(group_batches_fn(rows, ["key"], sizes, "key long, n long, longest long"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(0, 4_500, 100), (1, 500, 100)]


def test_cogroup_fn_cuts_both_sides(spark):
    def match(left, right):
        assert len(left) <= 400 and len(right) <= 400
        return left.merge(right.drop(columns="k"), on="x")

    left = spark.range(1_000).selectExpr("if(id < 900, 1, id) as k", "id % 50 as x", "id as a")
    right = spark.range(800).selectExpr("if(id < 750, 1, id + 200) as k", "id % 50 as x", "id as b")
    schema = "k long, x long, a long, b long"
    both = cogroup_fn(left, right, ["k"], match, schema, per_left_row=True, per_right_row=True, max_rows=100)
    expected = left.join(right, ["k", "x"]).select("k", "x", "a", "b")
    assert values(both) == values(expected) and both.count() > 10_000
    with pytest.raises(ValueError, match="per_left_row"):
        cogroup_fn(left, right, ["k"], match, schema, per_right_row=True)


def test_group_batches_fn_never_sorts_a_heavy_key(spark, monkeypatch):
    from windrow.functions import user

    def sizes(batches):
        key, seen = None, []
        for pdf in batches:
            assert pdf["key"].nunique(dropna=False) == 1 and list(pdf.columns) == ["key", "value"]
            key = pdf["key"].iloc[0]
            seen.append(len(pdf))
        yield pd.DataFrame({"key": [key], "n": [sum(seen)], "longest": [max(seen)]})

    monkeypatch.setattr(user, "MAX_GROUP_ROWS", 1_000)
    rows = spark.range(9_000).selectExpr("nullif(case when id < 4000 then 'a' when id < 7000 then 'b' else 'c' || id % 3 end, 'b') as key", "id as value")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        grouped = group_batches_fn(rows, ["key"], sizes, "key string, n long, longest long")
        got = {r["key"]: (r["n"], r["longest"]) for r in grouped.collect()}
        steps = plan(grouped)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {"a": (4_000, 100), None: (3_000, 100), "c0": (666, 100), "c1": (667, 100), "c2": (667, 100)}
    heavy = steps[steps.index("MapInPandas") : steps.index("FlatMapGroups")]
    assert "Sort " not in heavy


def test_cogroup_fn_reads_many_keys_in_one_stream(spark):
    """A call per key, with the pandas types of a group that came alone, whatever the batches."""
    left = spark.sql(
        "select if(id % 7 = 0, null, id % 7) as k, if(id % 3 = 0, null, 9007199254740993 + id) as v, cast(id as short) as s,"
        " if(id % 2 = 0, null, id % 4 = 1) as b, cast(id as string) as t, timestamp_seconds(id) as at, array(id) as l from range(60)"
    )
    right = spark.sql("select if(id % 9 = 0, null, id % 9) as k, cast(if(id % 5 = 0, null, id) as int) as w from range(30)")

    def seen(a, b):
        key = (a if len(a) else b)["k"].iloc[0]
        held = [str(df.dtypes.to_dict()) + str(df.index) + str(sorted(map(str, df.to_numpy().tolist()))) for df in (a, b)]
        return pd.DataFrame([(str(key), *held)])

    schema = "k string, a string, b string"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = cogroup_fn(left, right, ["k"], seen, schema)
        assert "MapInPandas" in plan(got) and "CoGroup" not in plan(got)
        want = left.groupBy("k").cogroup(right.groupBy("k")).applyInPandas(seen, schema)
        assert values(got) == values(want) and got.count() == 9
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    none = cogroup_fn(left, right, ["k"], lambda a, b: pd.DataFrame(), schema)
    assert none.collect() == []
    with pytest.raises(Exception, match="returned columns"):
        cogroup_fn(left, right, ["k"], lambda a, b: a, schema).collect()


def test_cogroup_fn_matching_columns_meet_only_their_like(spark):
    calls = spark.sparkContext.accumulator(0)

    def match(left, right):
        calls.add(1)
        assert len(left) <= 200 and len(right) <= 200
        return left.merge(right.drop(columns="k"), on="x")

    left = spark.range(4_000).selectExpr("1 as k", "if(id % 100 = 0, null, id % 1000) as x", "id as a")
    right = spark.range(3_000).selectExpr("1 as k", "if(id % 500 = 0, null, id % 1500) as x", "id as b")
    both = {"per_left_row": True, "per_right_row": True, "max_rows": 100}
    got = cogroup_fn(left, right, ["k"], match, "k int, x long, a long, b long", matching=["x"], **both)
    expected = left.join(right, left["k"].eqNullSafe(right["k"]) & left["x"].eqNullSafe(right["x"])).select(left["k"], left["x"], "a", "b")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    calls.value = 0
    got.collect()
    # Pairs of all slices are 1200 calls.
    assert calls.value < 200
    with pytest.raises(ValueError, match="per_right_row"):
        cogroup_fn(left, right, ["k"], match, "k int", per_left_row=True, matching=["x"])
    with pytest.raises(ValueError, match="one type"):
        cogroup_fn(left, right.withColumn("x", F.col("x").cast("int")), ["k"], match, "k int", matching=["x"], **both)


def test_cogroup_fn_matching_one_value_of_many_rows(spark):
    left = spark.range(500).selectExpr("'k' as k", "7 as x", "id as a")
    right = spark.range(300).selectExpr("'k' as k", "7 as x", "id as b")

    def match(a, b):
        assert len(a) < 250 and len(b) < 250
        return a.merge(b.drop(columns="k"), on="x")

    got = cogroup_fn(
        left, right, ["k"], match, "k string, x int, a long, b long",
        per_left_row=True, per_right_row=True, max_rows=100, matching=["x"],
    )
    assert got.count() == got.distinct().count() == 150_000


def test_cogroup_fn_over_arrow_tables(spark):
    """A call per key with the tables that Spark's own cogroup gives, whatever the batches."""
    left = spark.sql(
        "select if(id % 7 = 0, null, id % 7) as k, if(id % 4 = 0, null, concat('é', id % 3)) as n, if(id % 3 = 0, null, 9007199254740993 + id) as v,"
        " if(id % 2 = 0, null, id % 4 = 1) as b, timestamp_seconds(id) as at, array(id) as l from range(60)"
    )
    right = spark.sql("select cast(if(id % 5 = 0, null, id) as int) as w, if(id % 9 = 0, null, id % 9) as k, if(id % 2 = 0, null, 'é1') as n from range(30)")
    calls = spark.sparkContext.accumulator(0)

    def seen(a, b):
        calls.add(1)
        held = [str(t.schema.types) + str(t.column_names) + str(sorted(map(str, t.to_pylist()))) for t in (a, b)]
        return pa.table({"a": [held[0]], "b": [held[1]]})

    schema = "a string, b string"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for keys, count in ((["k"], 9), (["n"], 4), (["n", "k"], left.select("n", "k").union(right.select("n", "k")).distinct().count())):
            got = cogroup_fn(left, right, keys, seen, schema, arrow=True)
            assert "MapInArrow" in plan(got) and "CoGroup" not in plan(got)
            calls.value = 0
            rows = values(got)
            assert calls.value == len(rows) == count
            assert rows == values(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(seen, schema))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # A key of another type takes Spark's cogroup.
    times = left.withColumnRenamed("at", "t"), right.selectExpr("timestamp_seconds(w) as t", "w")
    assert cogroup_fn(*times, ["t"], seen, schema, arrow=True).count() == 61


def test_cogroup_fn_output_of_arrow_tables(spark):
    left, right = spark.range(25).selectExpr("id % 5 as k", "cast(id as int) as a"), spark.range(3).selectExpr("id as k", "id as b")

    def ran(fn, schema="k long, a long, none string"):
        return cogroup_fn(left, right, ["k"], fn, schema, arrow=True)

    def wide(a, b):
        # Columns in another order, of types that are cast.
        return pa.table({"none": pa.nulls(a.num_rows), "a": a["a"], "k": a["k"]}) if b.num_rows else pa.table({})

    assert sorted(tuple(r) for r in ran(wide).select("k", "a").collect()) == sorted((i % 5, i) for i in range(25) if i % 5 < 3)
    assert ran(wide).where("none is not null").count() == 0
    assert ran(lambda a, b: pa.table({})).collect() == []
    with pytest.raises(Exception, match="returned columns"):
        ran(lambda a, b: a).collect()
    with pytest.raises(Exception, match="an Arrow table"):
        ran(lambda a, b: a.to_pandas()).collect()
    with pytest.raises(Exception, match="not in range|out of bounds|overflow"):
        ran(lambda a, b: a.append_column("x", pa.array([2**40] * a.num_rows)), "k long, a int, x int").collect()


def test_cogroup_fn_cuts_arrow_tables(spark):
    def match(a, b):
        assert a.num_rows <= 400 and b.num_rows <= 400 and a.column_names == ["k", "x", "a"] and b.column_names == ["k", "x", "b"]
        return a.join(b.drop_columns("k"), "x", join_type="inner")

    left = spark.range(1_000).selectExpr("if(id < 900, 1, id) as k", "id % 50 as x", "id as a")
    right = spark.range(800).selectExpr("if(id < 350, 1, id + 200) as k", "id % 50 as x", "id as b")
    expected = values(left.join(right, ["k", "x"]).select("k", "x", "a", "b"))
    assert len(expected) > 5_000
    for how in ({}, {"per_right_row": True}, {"per_right_row": True, "matching": ["x"]}):
        limit = {"max_rows": 100} if how else {"max_rows": 400}
        got = cogroup_fn(left, right, ["k"], match, "k long, x long, a long, b long", per_left_row=True, arrow=True, **limit, **how)
        assert values(got) == expected


def test_cogroup_fn_query_builds_no_pandas_frame_per_key(spark, tmp_path):
    import __spark_entry__ as entry

    lines = "l_orderkey long, l_linenumber int"
    orders = "o_orderkey long, o_orderstatus string"
    spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (3, None), (None, 7)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "O"), (3, "F"), (2, None), (4, "P")], orders).write.parquet(f"{tmp_path}/orders.parquet")
    got = entry.queries()["cogroup_fn"](spark, str(tmp_path))
    assert "MapInArrow" in plan(got) and "MapInPandas" not in plan(got)
    rows = {(r["key"], r["line"], r["status"]): 0 for r in got.collect()}
    assert rows.keys() == {(1, 1, "O"), (1, 2, "O"), (2, 1, None), (3, None, "F"), (None, 7, None)}
    assert got.count() == 6 and got.dtypes == [("key", "bigint"), ("line", "int"), ("status", "string")]
