"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows are written once, in files of at most FILE_ROWS rows: the partitions. Each shard is cut into
cells of at most CELL_ROWS slots. How many rows go from each partition to each cell is drawn first, as the
matrix with these exact margins that a uniform permutation of all rows has: halving the partitions again
and again, the left half's share of every cell is multivariate hypergeometric. A partition draws only the
halvings above itself, each from a seed of its own, so all partitions agree without any of them, or the
driver, holding the matrix. Then the rows are permuted locally, exchanged by cell, and permuted again.

All numbers come from the seed, the files written and the rows' places in them, so a task that is run again
gives the same rows the same slots. The driver keeps one number per file. No row is looked into: nulls, very
long texts, ties and repeated rows are rows like any others, and all columns stay; ``shard`` and ``slot`` are
replaced where they exist. With fewer rows than shards the last shards are empty; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.session import scratch_dir

SEED = 42
FILE_ROWS = 1 << 20
CELL_ROWS = 1 << 17
#: From so many rows of one kind on, numpy's generator refuses to draw.
WIDE = 10**9
#: Standard deviations on each side of the mean in which a wide draw falls; beyond lies under 1e-30.
REACH = 12


def _wide_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric number of any size, by inversion around its mean."""
    total = good + bad
    least, most = max(0, sample - bad), min(good, sample)
    mean = sample * (good / total)
    spread = np.sqrt(mean * (bad / total) * ((total - sample) / max(total - 1, 1)))
    low = max(least, int(mean - REACH * spread) - REACH)
    high = min(most, int(mean + REACH * spread) + REACH)
    x = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - x) + np.log(sample - x) - np.log(x + 1) - np.log(bad - sample + x + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    shares = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(shares, rng.random() * shares[-1], side="right").clip(0, len(shares) - 1))


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, sample: np.ndarray, wide: int = WIDE) -> np.ndarray:
    """Good ones among ``sample`` rows drawn from ``good + bad``, element by element."""
    far = (good >= wide) | (bad >= wide)
    out = rng.hypergeometric(np.where(far, 0, good), np.where(far, 0, bad), np.where(far, 0, sample))
    for i in np.flatnonzero(far):
        out[i] = _wide_hypergeometric(rng, int(good[i]), int(bad[i]), int(sample[i]))
    return out


def split(rng: np.random.Generator, sizes: np.ndarray, taken: int, wide: int = WIDE) -> np.ndarray:
    """How many of ``taken`` rows fall on each kind, drawn from kinds of ``sizes`` rows: pairs of kinds
    are drawn as one kind first, then divided."""
    if len(sizes) == 1:
        return np.array([taken], np.int64)
    pairs = np.append(sizes, 0)[: len(sizes) + len(sizes) % 2].reshape(-1, 2)
    both = split(rng, pairs.sum(axis=1), taken, wide)
    left = hypergeometric(rng, pairs[:, 0], pairs[:, 1], both, wide)
    return np.stack([left, both - left], axis=1).ravel()[: len(sizes)]


def matrix_row(seed: int, starts: np.ndarray, cells: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows from ``part`` to each cell, and those of the parts before it. ``starts`` has the rows before
    each part and, last, all rows; ``cells`` the sizes of the cells."""
    low, high, here, before = 0, len(starts) - 1, cells, np.zeros(len(cells), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, 1, low, high])
        left = split(rng, here, int(starts[middle] - starts[low]))
        if part < middle:
            high, here = middle, left
        else:
            low, here, before = middle, here - left, before + left
    return here, before


def _permutation(seed: int, kind: int, number: int, size: int) -> np.ndarray:
    return np.random.default_rng([seed, kind, number]).permutation(size)


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart, the larger ones first."""
    return np.full(shards, rows // shards, np.int64) + (np.arange(shards) < rows % shards)


def _cells(rows: int, shards: int, cell_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each cell: its size, its shard, and the slots of the shard before it."""
    sizes, homes, offsets = [], [], []
    for shard, size in enumerate(shard_sizes(rows, shards)):
        inner = shard_sizes(int(size), max(1, -(-int(size) // cell_rows)))
        sizes.append(inner)
        homes.append(np.full(len(inner), shard, np.int64))
        offsets.append(np.cumsum(inner) - inner)
    return np.concatenate(sizes), np.concatenate(homes), np.concatenate(offsets)


def _dealt(seed: int, starts: np.ndarray, cells: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of the part, in its order: the cell, and the place among all rows that the cell gets."""
    own, before = matrix_row(seed, starts, cells, part)
    order = _permutation(seed, 2, part, int(own.sum()))
    place = np.arange(len(order)) - np.repeat(np.cumsum(own) - own - before, own)
    return np.repeat(np.arange(len(own)), own)[order], place[order]


class _Last(dict):
    """What ``make`` gives for a key; only that of the last key is held."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        self.clear()
        self[key] = self.make(key)
        return self[key]


def shuffle_into_shards(
    df: DataFrame, shards: int, seed: int = SEED, file_rows: int = FILE_ROWS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``df`` with ``shard int`` from 0 and ``slot long``, gapless from 0 in each shard.

    Every way to place the rows in shards and slots is equally likely, and shard sizes are at most one
    apart. ``df`` is computed once, into the shared scratch folder, and its rows cross the network once. The
    draw depends on how the rows lie in files, so another layout of the same rows gives other places.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "shards")
    named = df.drop("shard", "slot")
    safe = [f"c{i}" for i in range(len(named.columns))]
    named.toDF(*safe).write.option("maxRecordsPerFile", file_rows).parquet(path)
    rows = spark.read.schema(named.toDF(*safe).schema).parquet(path)
    counted = rows.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("size"))
    counted = sorted(tuple(r) for r in counted.collect())
    files = {name: i for i, (name, _) in enumerate(counted)}
    starts = np.cumsum([0, *(size for _, size in counted)], dtype=np.int64)
    total = int(starts[-1])
    shared = spark.sparkContext.broadcast((files, starts))

    @F.arrow_udf("struct<cell: long, place: long>")
    def deal(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        numbers, parts = shared.value
        sizes, _, _ = _cells(total, shards, cell_rows)
        dealt = _Last(lambda name: _dealt(seed, parts, sizes, numbers[name]))
        for names, indexes in batches:
            coded, index = names.dictionary_encode(), np.asarray(indexes, np.int64)
            code = np.asarray(coded.indices)
            cell, place = np.empty(len(index), np.int64), np.empty(len(index), np.int64)
            for i, name in enumerate(coded.dictionary.to_pylist()):
                cells, places = dealt[name]
                here = code == i
                cell[here], place[here] = cells[index[here]], places[index[here]]
            yield pa.StructArray.from_arrays([pa.array(cell), pa.array(place)], ["cell", "place"])

    @F.arrow_udf("struct<shard: int, slot: long>")
    def settle(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sizes, homes, offsets = _cells(total, shards, cell_rows)
        again = _Last(lambda cell: _permutation(seed, 3, cell, int(sizes[cell])))
        for cells, places in batches:
            cell, place = np.asarray(cells, np.int64), np.asarray(places, np.int64)
            slot = np.empty(len(cell), np.int64)
            for c in np.unique(cell):
                here = cell == c
                slot[here] = offsets[c] + again[int(c)][place[here]]
            yield pa.StructArray.from_arrays([pa.array(homes[cell].astype(np.int32)), pa.array(slot)], ["shard", "slot"])

    placed = rows.select("*", deal(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("to"))
    # Sorted, so that a task needs one cell's permutation at a time.
    cells = placed.select(*safe, "to.cell", "to.place").repartition("cell").sortWithinPartitions("cell")
    done = cells.select(*safe, settle("cell", "place").alias("at"))
    return done.select(*[F.col(s).alias(c) for s, c in zip(safe, named.columns)], "at.shard", "at.slot")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text and one more; a null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
