"""Operators against plain-Python models on random data."""

from __future__ import annotations

import collections
import datetime as dt
import random
import re

import pytest
from conftest import DELIVERIES, plan
from pyspark.sql import functions as F

from windrow.operators import (
    cogroup,
    lookup_join_strict,
    parse_delivery,
    split_fields,
    sum_by_key,
)
from windrow.operators.shape import CORRUPT
from windrow.schemas import DELIVERY
from windrow.sources import read_messages
from windrow.streaming import finalize_window, tumbling_window


def _split(line):
    if line == "":
        return [""]
    fields = line.split(",")
    while fields and fields[-1] == "":
        fields.pop()
    return fields


def test_split_fields_on_random_lines(spark, lines):
    rng = random.Random(1)
    texts = ["".join(rng.choices('a,,," \té', k=rng.randrange(8))) for _ in range(2_000)]
    rows = split_fields(lines(texts)).collect()
    assert [r["cols"] for r in rows] == [_split(t) for t in texts]
    first = split_fields(lines(texts), first=3).collect()
    assert [r["cols"][:3] for r in first] == [_split(t)[:3] for t in texts]


def _delivery(line):
    fields = _split(line)
    if len(fields) < 18:
        return None
    row = []
    for f, text in zip(DELIVERY, fields):
        if f.dataType.typeName() == "string":
            row.append(text)
        elif re.fullmatch("[+-]?[0-9]+", text) and -(2**31) <= int(text) < 2**31:
            row.append(int(text))
        else:
            return None
    return tuple(row)


def test_parse_delivery_on_damaged_lines(spark, lines):
    rng = random.Random(2)
    odd = ["", " 1", "1.0", "+7", "-0", "x", "+", "1,2"]
    odd += ["2147483648", "-2147483648", "00000000000012"]
    texts = []
    for _ in range(3_000):
        fields = rng.choice(DELIVERIES).split(",")
        for _ in range(rng.randrange(3)):
            fields[rng.randrange(18)] = rng.choice(odd)
        kept = fields[: rng.choice([18, 18, 18, 17, 12])]
        texts.append(",".join(kept) + rng.choice(["", ",", ",,z"]))
    expected = collections.Counter(_delivery(t) for t in texts)
    dropped = expected.pop(None)
    kept = parse_delivery(lines(texts), "DROPMALFORMED").collect()
    assert collections.Counter(map(tuple, kept)) == expected
    marked = parse_delivery(lines(texts), "PERMISSIVE")
    assert marked.where(F.col(CORRUPT).isNotNull()).count() == dropped
    two = parse_delivery(lines(texts), "DROPMALFORMED", columns=["id", "ball"]).collect()
    assert collections.Counter(map(tuple, two)) == collections.Counter(
        (r[0], r[3]) for r in expected.elements()
    )


@pytest.mark.parametrize("seed", range(4))
def test_joins_on_random_keys(spark, seed):
    rng = random.Random(seed)
    keys = [*range(12), None]
    left = [(rng.choice(keys), rng.randrange(5)) for _ in range(rng.randrange(60))]
    right = [(rng.choice(keys), rng.randrange(5)) for _ in range(rng.randrange(40))]
    a = spark.createDataFrame(left, "k int, a int")
    b = spark.createDataFrame(right, "k int, b int")
    for limit in (1_000, 3):
        got = collections.defaultdict(lambda: ([], []))
        for r in cogroup(a, b, "k", max_values=limit).collect():
            got[r["k"]][0].extend(x["a"] for x in r["left"])
            got[r["k"]][1].extend(x["b"] for x in r["right"])
        want = collections.defaultdict(lambda: ([], []))
        for k, v in left:
            want[k][0].append(v)
        for k, v in right:
            want[k][1].append(v)
        assert {k: (sorted(x), sorted(y)) for k, (x, y) in got.items()} == {
            k: (sorted(x), sorted(y)) for k, (x, y) in want.items()
        }
    times = collections.Counter(k for k, _ in right)
    single = {k: v for k, v in right if k is not None and times[k] == 1}
    kept = lookup_join_strict(a, b, "k", "drop").select("k", "a", "match.b").collect()
    assert sorted(map(tuple, kept)) == sorted((k, v, single[k]) for k, v in left if k in single)


def test_heavy_left_keys_are_split_in_the_lookup_join(spark):
    """Without a broadcast, adaptive execution splits the key that holds most rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        keys = F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 1_000)
        left = spark.range(0, 60_000, 1, 8).select(keys.alias("k"), F.col("id").alias("a"))
        right = spark.range(1_000).select(F.col("id").alias("k"), F.col("id").alias("b"))
        joined = lookup_join_strict(left, right, "k").select("k", "a", "match.b")
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _batches(rng):
    """Messages in bursts, mostly in order, with some rows far behind."""
    now = 0
    for _ in range(5):
        rows = []
        for _ in range(30):
            now += rng.randrange(20)
            rows.append((f"m{rng.randrange(6)}", max(0, now - rng.choice([0, 0, 0, 5, 150]))))
        yield rows


@pytest.mark.parametrize("seed", range(2))
def test_stream_windows_on_random_bursts(spark, tmp_path, seed):
    source, got = f"{tmp_path}/in", []
    schema = "value string, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(source)
    stream = read_messages(spark, "parquet", {"path": source}, schema, time="ts")
    query = (
        finalize_window(stream)
        .writeStream.option("checkpointLocation", f"{tmp_path}/cp")
        .foreachBatch(
            lambda b, _: got.extend(
                (int(r["window"]["start"].timestamp()), r["value"]) for r in b.collect()
            )
        )
        .start()
    )
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    base = int(start.timestamp())
    want, open_rows, watermark = [], [], 0
    try:
        for rows in _batches(random.Random(seed)):
            frame = [(v, start + dt.timedelta(seconds=s)) for v, s in rows]
            spark.createDataFrame(frame, schema).coalesce(1).write.mode("append").parquet(source)
            query.processAllAvailable()
            open_rows += [(s // 60 * 60, v) for v, s in rows if s // 60 * 60 + 60 > watermark]
            watermark = max([watermark, *(s for _, s in rows)])
            want += [(w, v) for w, v in open_rows if w + 60 <= watermark]
            open_rows = [(w, v) for w, v in open_rows if w + 60 > watermark]
            assert sorted((w - base, v) for w, v in got) == sorted(want)
    finally:
        query.stop()
    assert len(want) > 50


def test_sums_match_windows_in_batch(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(4), dt.datetime(2024, 1, 1, 0, rng.randrange(9), 5)) for _ in range(500)]
    df = tumbling_window(spark.createDataFrame(rows, "value int, ts timestamp"), "2m")
    got = {
        (r["window"]["start"].minute, r["total"]) for r in sum_by_key(df, "window").collect()
    }
    want = collections.Counter()
    for v, t in rows:
        want[t.minute // 2 * 2] += v
    assert got == set(want.items())
