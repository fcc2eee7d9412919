"""Near-duplicate documents by circulant MinHash.

One permutation shuffles the shingles' ids, a second one, shifted circularly by 1, 2, ..., gives all
coordinates of the signature: the least of ``second((first(x) + k) mod 2**32)`` over the set. Runs of
coordinates are hashed into bands; documents that agree in a band are compared on their full sets.

Texts with equal sets are one class first. In a band's bucket every class meets the bucket's least
one. What that leaves in different components meets block by block: first each component's nearest
pair, then all pairs. Before texts are moved, the pairs are judged by parity maps, an exact filter:
one bit per place tells whether an odd number of the set's shingles falls there, so two maps differ
in no more places than their sets have shingles that are not shared. No pair of a bucket's members
in different components that can reach the threshold is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.components import components, written
from windrow.llm.hashing import mix64, shingle_set

ROWS = 6
MISS = 1e-6
# Ids up to this count are broadcast (8 bytes each), more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
# Set members signed at a time; keeps the work inside the processor's cache.
BLOCK = 1 << 16
# Rounds of comparing the nearest pairs of components in mixed buckets, before all the rest.
NEAREST_ROUNDS = 2
# Members of a bucket that meet another such number in one go, and the most bits of a parity map.
MEET = 1024
PARITY_BITS = 1 << 16


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair just at the threshold shares none with a probability under ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def _permute(x: np.ndarray, a: int, b: int, room: np.ndarray) -> None:
    """A bijection of 32-bit numbers, in place."""
    for shift, factor in ((16, a), (13, b), (16, 1)):
        np.right_shift(x, np.uint32(shift), out=room)
        np.bitwise_xor(x, room, out=x)
        np.multiply(x, np.uint32(factor), out=x)


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``len(sets) x count`` coordinates; the sets are not empty."""
    out = np.empty((len(sets), count), np.uint32)
    members = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    members = (members ^ (members >> np.uint64(32))).astype(np.uint32)
    _permute(members, 0x7FEB352D, 0x846CA68B, np.empty_like(members))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    at = 0
    while at < len(sets):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK)))
        block = members[starts[at] : starts[to - 1] + sizes[to - 1]]
        x, room, cuts = np.empty_like(block), np.empty_like(block), starts[at:to] - starts[at]
        for k in range(count):
            np.add(block, np.uint32(k + 1), out=x)
            _permute(x, 0x85EBCA6B, 0xC2B2AE35, room)
            out[at:to, k] = np.minimum.reduceat(x, cuts)
        at = to
    return out


def band_keys(signed: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, count = signed.shape
    grouped = signed.reshape(n, count // rows, rows).astype(np.uint64)
    keys = np.tile(np.arange(count // rows, dtype=np.uint64), (n, 1))
    for k in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return keys


def sketch(docs: DataFrame, size: int, percent: int, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, class, bands, parity``: set size, 128-bit key of the set, band keys, parity map.
    Empty sets have none of the last three."""
    bands = bands_for(percent, rows)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = [shingle_set(t.as_py(), size) for t in batch.column(1)]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(signatures([sets[i] for i in full], bands * rows), rows).view(np.int64)
                of_row = dict(zip(full, keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([of_row.get(i) for i in range(len(sets))], pa.list_(pa.int64())),
                        pa.array([parity(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n", "class", "bands", "parity"],
                )

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows_in.mapInArrow(sketched, "doc_id long, n long, class binary, bands array<long>, parity binary")


def _set_key(members: np.ndarray) -> bytes:
    again = mix64(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return np.array([mix64(members).sum(dtype=np.uint64), again.sum(dtype=np.uint64)]).tobytes()


def parity(members: np.ndarray) -> bytes:
    """A map of at least two bits per member: whether an odd number of members falls on each."""
    bits = min(PARITY_BITS, 64 << ((2 * len(members) - 1) // 64).bit_length())
    counts = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(maps: np.ndarray, width: int) -> np.ndarray:
    """The maps as they are with fewer bits, ``width`` 64-bit words."""
    while maps.shape[1] > width:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def _by_width(maps: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each map length in 64-bit words: which maps have it, and those as rows."""
    lengths = np.fromiter(map(len, maps), np.int64, len(maps)) // 8
    out = {}
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        out[width] = at, np.frombuffer(b"".join([maps[i] for i in at.tolist()]), np.uint64).reshape(len(at), width)
    return out


def _room(n_a, n_b, percent: int):
    """How many shingles two sets of these sizes may not share and still reach the threshold."""
    both = n_a + n_b
    return both - 2 * -(-percent * both // (100 + percent))


def near_first(sizes: np.ndarray, maps: list[bytes], first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may reach the threshold with the row ``first`` names for each, and how far they are (0 to 1)."""
    apart = np.abs(sizes - sizes[first])
    widths = _by_width(maps)
    width_of, place = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for width, (at, _) in widths.items():
        width_of[at], place[at] = width, np.arange(len(at))
    for wide, (_, rows) in widths.items():
        for narrow, (_, others) in widths.items():
            for mine, yours in ((wide, narrow), (narrow, wide)) if wide > narrow else ((wide, narrow),) if wide == narrow else ():
                at = np.flatnonzero((width_of == mine) & (width_of[first] == yours))
                own, other = widths[mine][1][place[at]], widths[yours][1][place[first[at]]]
                differ = np.bitwise_count(_folded(own, narrow) ^ _folded(other, narrow)).sum(1, dtype=np.int64)
                apart[at] = np.maximum(apart[at], differ)
    room = _room(sizes, sizes[first], percent)
    at = np.flatnonzero((apart <= room) & (first != np.arange(len(sizes))))
    return at, apart[at] / np.maximum(room[at], 1)


def near_pairs(sizes: np.ndarray, maps: list[bytes], groups: np.ndarray, sides: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Pairs of rows of different ``groups`` that may reach the threshold, and how far they are (0 to 1).

    With two ``sides`` only pairs of one row of each are meant.
    """
    left, right, far = [], [], []
    two = bool(sides.any()) and not bool(sides.all())
    widths = _by_width(maps)
    for wide, (rows, of_rows) in widths.items():
        for narrow, (others, of_others) in widths.items():
            if narrow > wide:
                continue
            mine = _folded(of_rows, narrow)
            for k, row in enumerate(rows.tolist()):
                # Only sizes that fit, so that most others are not looked at.
                may = (groups[others] != groups[row]) & ((sides[others] != sides[row]) if two else (others != row))
                may &= (others > row) | (wide != narrow)
                room = _room(sizes[row], sizes[others], percent)
                at = np.flatnonzero(may & (np.abs(sizes[others] - sizes[row]) <= room))
                if not len(at):
                    continue
                differ = np.bitwise_count(of_others[at] ^ mine[k]).sum(1, dtype=np.int64)
                near = differ <= room[at]
                left.append(np.full(int(near.sum()), row))
                right.append(others[at[near]])
                far.append(differ[near] / np.maximum(room[at[near]], 1))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.concatenate(left), np.concatenate(right), np.concatenate(far)


def similar(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets have a Jaccard similarity of ``percent`` or more.

    ``texts`` are ``doc_id, text``. Only texts of the pairs' ids are moved.
    """
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    needed = texts.join(ids, "doc_id", "left_semi")
    left = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = lru_cache(maxsize=64)(lambda text: shingle_set(text, size))
        for batch in batches:
            linked = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                a, b = members(ta.as_py()), members(tb.as_py())
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            mask = pa.array(linked, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compared, "a long, b long").distinct()


def _to_least(members: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each member with the nearest one of its buckets' least members, if that may be similar."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            bucket = table["bucket"].to_numpy()
            if not len(bucket):
                continue
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            first = np.repeat(starts, np.diff(np.append(starts, len(bucket))))
            at, far = near_first(table["n"].to_numpy(), table["parity"].to_pylist(), first, percent)
            rep = table["rep"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(rep[first[at]]), pa.array(rep[at]), pa.array(far)], ["a", "b", "far"])
            # Rows come sorted: the last bucket's least one is held for the rest of it.
            held = table.slice(starts[-1], 1)

    slots = members.join(maps, "rep").repartition("bucket").sortWithinPartitions("bucket", "rep")
    found = slots.select("bucket", "rep", "n", "parity").mapInArrow(met, "a long, b long, far double")
    return found.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")).select("a", "b")


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """``bucket, rep, component, blocks`` of the buckets whose members lie in several components."""
    placed = members.join(found, F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    bucket = Window.partitionBy("bucket")
    placed = placed.select(
        "*", F.min("component").over(bucket).alias("low"), F.max("component").over(bucket).alias("high"),
        F.ceil(F.count("*").over(bucket) / MEET).cast("int").alias("blocks"),
    )
    return written(placed.where("low < high").select("bucket", "rep", "component", "blocks"), "mixed")


def _across(slots: DataFrame, maps: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """``a, b``: pairs of a bucket's members in different components that may be similar.

    ``nearest``: of each component only the nearest pair, block by block. A bucket of more than MEET
    members is cut into blocks that meet two at a time, so that no task gets a whole large one.
    """

    def pairs_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rep, group = table["rep"].to_numpy(), table["component"].to_numpy()
        i, j, far = near_pairs(table["n"].to_numpy(), table["parity"].to_pylist(), group, table["side"].to_numpy(), percent)
        if nearest:
            order = np.argsort(far, kind="stable")
            i, j = i[order], j[order]
            ends, at = np.concatenate([group[i], group[j]]), np.tile(np.arange(len(i)), 2)
            by_rank = np.argsort(at, kind="stable")
            chosen = np.unique(at[by_rank][np.unique(ends[by_rank], return_index=True)[1]])
            i, j = i[chosen], j[chosen]
        return np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def pairs(tables: list[pa.Table]) -> pa.RecordBatch:
            found = [pairs_of(t) for t in tables] or [(np.empty(0, np.int64),) * 2]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = [table[c].to_numpy() for c in ("bucket", "i", "j")]
            if not len(table):
                continue
            starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            yield pairs([table.slice(at, to - at) for at, to in zip(starts[:-1], starts[1:])])
            held = table.slice(starts[-1]).combine_chunks()
        if held is not None:
            yield pairs([held])

    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = slots.select("bucket", "rep", "component", block.alias("block"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    dealt = dealt.selectExpr("bucket", "rep", "component", "least(block, other) i", "greatest(block, other) j", "cast(block > other as int) side")
    key = ["bucket", "i", "j"]
    rows = dealt.join(maps, "rep").repartition(*key).sortWithinPartitions(*key)
    return rows.select(*key, "side", "rep", "n", "component", "parity").mapInArrow(met, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents whose sets of ``size``-word shingles are at least ``percent`` similar are linked;
    ``component_id`` is the least id reachable over links, ``kept`` marks the document that has it.
    Fewer words than ``size`` make one shingle. Null and empty texts and texts without words have
    none and are linked with nothing. Rows of one id are one document with the links of each. Rows
    without an id are never linked: their component is null and they are kept. Ids are whole
    numbers. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(sketch(texts, size, percent, rows), "sketches")
    classed = signed.where("doc_id is not null and n > 0")
    alike = [F.first(c).alias(c) for c in ("n", "bands", "parity")]
    classes = written(classed.groupBy("class").agg(F.min("doc_id").alias("rep"), *alike), "classes")
    slots = classes.select("rep", F.explode("bands").alias("bucket"))
    bucket = Window.partitionBy("bucket")
    slots = slots.select("bucket", "rep", F.min("rep").over(bucket).alias("least"), F.max("rep").over(bucket).alias("last"))
    members = written(slots.where("least < last").select("bucket", "rep"), "members")
    several = members.select("rep").distinct()
    maps = written(classes.select("rep", "n", "parity").join(several, "rep", "left_semi"), "maps")
    links = written(similar(written(_to_least(members, maps, percent), "pairs"), texts, size, percent), "links")
    copies = classed.join(classes.select("class", "rep"), "class").where("doc_id != rep").select("doc_id", "rep")
    copies = written(copies, "copies")
    found = components(links.union(copies))
    for turn in range(NEAREST_ROUNDS + 1):
        members = _mixed(members.select("bucket", "rep"), found)
        near = written(_across(members, maps, percent, nearest=turn < NEAREST_ROUNDS), "pairs")
        more = similar(near, texts, size, percent)
        links = written(links.union(more), "links")
        found = components(links.union(copies))
    component = F.coalesce("component", "doc_id")
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(found, F.col("doc_id") == F.col("node"), "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )
