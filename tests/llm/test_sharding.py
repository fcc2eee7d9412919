from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.llm import sharding


def places(seed, parts, shards, cell_rows):
    """Shard and slot of every row, part by part, without Spark."""
    starts = np.cumsum([0, *parts])
    cells, homes, offsets = sharding._cells(int(starts[-1]), shards, cell_rows)
    out = []
    for part in range(len(parts)):
        for cell, place in zip(*sharding._dealt(seed, starts, cells, part)):
            again = sharding._permutation(seed, 3, int(cell), int(cells[cell]))
            out.append((int(homes[cell]), int(offsets[cell] + again[place])))
    return out


def test_the_matrix_has_exact_margins():
    starts = np.cumsum([0, 7, 0, 20, 1, 300, 44])
    cells = np.array([100, 101, 0, 71, 100])
    rows = [sharding.matrix_row(5, starts, cells, p) for p in range(6)]
    matrix = np.array([own for own, _ in rows])
    assert (matrix >= 0).all() and (matrix.sum(axis=1) == np.diff(starts)).all() and (matrix.sum(axis=0) == cells).all()
    assert all((before == matrix[:p].sum(axis=0)).all() for p, (_, before) in enumerate(rows))


def test_every_permutation_is_equally_likely():
    seen = Counter(tuple(places(seed, [2, 3], 2, 2)) for seed in range(12_000))
    assert len(seen) == 120
    expected = 100
    assert sum((n - expected) ** 2 / expected for n in seen.values()) < 180  # 119 degrees, 0.9998


def test_wide_draws_follow_the_same_law():
    rng = np.random.default_rng(6)
    good, bad, sample = np.full(20_000, 60), np.full(20_000, 90), np.full(20_000, 40)
    wide = np.bincount(sharding.hypergeometric(rng, good, bad, sample, wide=1), minlength=41)
    plain = np.bincount(rng.hypergeometric(good, bad, sample), minlength=41)
    both = wide + plain >= 20
    assert (((wide - plain) ** 2)[both] / (wide + plain)[both]).sum() < 60
    sizes = np.full(16, 6 * 10**9)
    got = sharding.split(rng, sizes, 48 * 10**9)
    assert got.sum() == 48 * 10**9 and (abs(got - 3 * 10**9) < 10 * 40_000).all() and len(set(got)) > 10
    assert sharding.split(rng, sizes, 0).sum() == 0 and (sharding.split(rng, sizes, int(sizes.sum())) == sizes).all()


@pytest.mark.parametrize("n, shards", [(0, 3), (2, 5), (1000, 7)])
def test_sizes_and_slots(spark, n, shards):
    rows = [(i % 400 if i % 9 else None, "x" * (i % 5), "s", None) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, c0 string, shard string, `Cell` int").repartition(6)
    done = sharding.shuffle_into_shards(docs, shards, file_rows=90, cell_rows=50)
    assert done.columns == ["doc_id", "c0", "Cell", "shard", "slot"]
    got = done.collect()
    assert Counter((r["doc_id"], r["c0"]) for r in got) == Counter(r[:2] for r in rows)
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(shards)}
    assert sum(map(len, slots.values())) == n
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(map(repr, got)) == sorted(map(repr, done.collect()))


def test_texts_travel_and_seeds_differ(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(i, long if i == 7 else f"t{i}") for i in range(300)], "doc_id long, text string")
    first = {r["doc_id"]: (r["shard"], r["slot"], len(r["text"])) for r in sharding.shuffle_into_shards(docs, 4).collect()}
    second = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(docs, 4, seed=1).collect()}
    assert first[7][2] == len(long)
    assert sum(first[i][:2] == second[i] for i in first) < 20
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs, 0)


def test_sizes_of_texts(spark):
    docs = spark.createDataFrame([(None,), ("",), ("é",), ("ab",)], "text string")
    assert [r[0] for r in docs.select(sharding.text_size(F.col("text"))).collect()] == [1, 1, 3, 3]
