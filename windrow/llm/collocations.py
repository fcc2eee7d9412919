"""Collocations from stripes.

Each prefix of words keys a stripe, an associative counter of the words that come next. The stripe of the
empty prefix counts single words, those of one word count pairs, and so on. Tasks fill stripes from texts,
send them in segments, and equal prefixes are merged element by element. An entry is the count of an
extension and, one level on, the total of that longer prefix; the largest entry of a stripe and, per ending,
over stripes tells whether a longer phrase takes a shorter one over.

A phrase that is common enough begins and ends with phrases that are so too. So only their places are
counted at the next level, told by a sieve: one bit per hash of a common phrase, SIEVE_BITS bits whatever
the corpus. It lets some rare phrases through, never holds a common one back, and the counts are exact.
Stripes whose prefix takes a share of over 1 / SHARES of all words are split by next word, so that no
task gets a larger share; there can be no more than SHARES such prefixes.

Null texts are empty and empty texts have no words; a null language is ``und``. Repeated rows count again.
A text of any length is read whole, in slices that end where a piece ends. Equal scores and counts
are put in order by the phrase's bytes. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.components import written
from windrow.llm.hashing import mix64, span_hashes, word_spans

LEAST = 10
LONGEST = 3
TOP = 2_000
#: A phrase goes if a longer one around it has this percent of its count.
COVERED_PERCENT = 50
SIEVE_BITS = 27
SHARES = 2_000
#: Words a task counts before it sends them, entries in one segment, and characters of text at once.
ENTRIES = 300_000
SEGMENT = 512
SLICE = 1 << 22
#: Parts of a language's phrases that are ranked apart first.
RANK_PARTS = 64

_UPPER = bytes(range(65, 91))
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PREPARED = bytes.maketrans(_UPPER + _PIECE_ENDS + b"\t", _UPPER.lower() + b"\n" * len(_PIECE_ENDS) + b" ")
_SPACES = np.zeros(256, bool)
_SPACES[[32, 10]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)

STRIPE = "lang string, prefix string, part int, next array<string>, count array<long>"
ENTRY = "lang string, prefix string, next string, f long"


def slices(texts: list[str]) -> Iterator[bytes]:
    """The texts in lower case, pieces between line ends and words between spaces; cut where pieces end."""
    data = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_PREPARED)
    at = 0
    while at < len(data):
        end = data.find(b"\n", at + SLICE)
        end = len(data) if end < 0 else end + 1
        yield data[at:end]
        at = end


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "big"))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed) -> np.ndarray:
    return mix64(span_hashes(data, starts, ends) ^ seed)


def _longer(runs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of runs with the word behind each."""
    return mix64(runs * _BASE + words)


def phrase_positions(langs: list[str], phrases: list[str], size: int) -> np.ndarray:
    """The sieve's bit of each phrase of ``size`` words."""
    data = np.frombuffer("\n".join(phrases).encode("utf-8", "surrogatepass"), np.uint8)
    seeds = {lang: _seed(lang) for lang in set(langs)}
    own = np.repeat(np.array([seeds[lang] for lang in langs], np.uint64), size)
    words = _word_hashes(data, *word_spans(data, _SPACES), own)
    runs = words[::size]
    for k in range(1, size):
        runs = _longer(runs, words[k::size])
    return (runs >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def sieve(common: DataFrame, size: int) -> bytes:
    """The bits of all phrases in ``common`` (``lang, phrase``), at most 2 ** SIEVE_BITS / 8 bytes."""

    @F.arrow_udf("long")
    def position(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, phrases in batches:
            # Spark numbers bits from one.
            yield pa.array(phrase_positions(langs.to_pylist(), phrases.to_pylist(), size) + 1)

    placed = common.select(position("lang", "phrase").alias("at"))
    maps = placed.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros((1 << SIEVE_BITS) // 8, np.uint8)
    for row in maps.collect():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["bucket"] - 1) * len(bits)
        out[at : at + len(bits)] |= bits
    return out.tobytes()


def _passes(bits: np.ndarray, runs: np.ndarray) -> np.ndarray:
    at = runs >> np.uint64(64 - SIEVE_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _common_places(data: bytes, size: int, bits: np.ndarray, seed: np.uint64) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the number of each word in turn, and where runs of ``size`` words start that lie
    in one piece and whose first and last ``size - 1`` words pass the sieve."""
    coded = pa.array(data.split(), pa.binary()).dictionary_encode()
    known, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    if len(ids) < size:
        return known, ids, np.empty(0, np.int64)
    codes = np.frombuffer(data, np.uint8)
    listed = np.frombuffer(b" ".join(known.to_pylist()), np.uint8)
    hashes = runs = _word_hashes(listed, *word_spans(listed, _SPACES), seed)[ids]
    for k in range(1, size - 1):
        runs = _longer(runs[:-1], hashes[k:])
    good = _passes(bits, runs)
    piece = np.cumsum(codes == 10, dtype=np.int32)[word_spans(codes, _SPACES)[0]]
    good = good[:-1] & good[1:] & (piece[: len(piece) - size + 1] == piece[size - 1 :])
    return known, ids, np.flatnonzero(good)


def common_runs(data: bytes, size: int, bits: np.ndarray, seed: np.uint64) -> Iterator[tuple[bytes, ...]]:
    """The words of the runs at ``_common_places``, in turn."""
    known, ids, at = _common_places(data, size, bits, seed)
    return zip(*(known.take(pa.array(ids[at + k])).to_pylist() for k in range(size)))


def _by_language(batch: pa.RecordBatch) -> dict[str, list[str]]:
    texts: dict[str, list[str]] = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if text:
            texts["und" if lang is None else lang].append(text)
    return texts


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, f``: the stripe of the empty prefix, from ``docs`` (``lang, text``)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, seen in counts.items():
                words = pa.array(list(seen), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(seen), pa.string()), words, pa.array(list(seen.values()), pa.int64())], ["lang", "phrase", "f"]
                )
            counts.clear()

        for batch in batches:
            for lang, texts in _by_language(batch).items():
                for data in slices(texts):
                    counts[lang].update(data.split())
                    if sum(map(len, counts.values())) >= ENTRIES:
                        yield from sent()
        yield from sent()

    parts = docs.mapInArrow(counted, "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _stripes(lang: str, data: bytes, size: int, bits: np.ndarray, parts_of: dict[tuple[str, str], int]) -> pa.RecordBatch:
    """Rows of STRIPE from the common runs of ``size`` words in one slice."""
    known, ids, at = _common_places(data, size, bits, _seed(lang))
    width, prefix = max(len(known), 1), ids[at]
    for k in range(1, size - 1):
        # Numbered anew, so that any number of words fits into 64 bits.
        prefix = np.unique(prefix * width + ids[at + k], return_inverse=True)[1]
    runs, first, count = np.unique(prefix * width + ids[at + size - 1], return_index=True, return_counts=True)
    stripe, after, first = runs // width, runs % width, at[first]
    part = np.zeros(len(runs), np.int64)
    word = lambda numbers: known.take(pa.array(numbers)).cast(pa.string())
    words_of = lambda places: pc.binary_join_element_wise(*(word(ids[places + k]) for k in range(size - 1)), " ")
    starts = np.flatnonzero(np.diff(stripe, prepend=-1))
    heavy = [(prefix, n) for (own, prefix), n in parts_of.items() if own == lang and n > 1]
    if heavy and len(runs):
        found = pc.index_in(words_of(first[starts]), value_set=pa.array([p for p, _ in heavy], pa.string()))
        ends = np.append(starts[1:], len(runs))
        for k in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
            own = slice(starts[k], ends[k])
            part[own] = [crc32(w) % heavy[found[k].as_py()][1] for w in known.take(pa.array(after[own])).to_pylist()]
        order = np.lexsort((part, stripe))
        stripe, after, first, count, part = (x[order] for x in (stripe, after, first, count, part))
        starts = np.flatnonzero((np.diff(stripe, prepend=-1) != 0) | (np.diff(part, prepend=0) != 0))
    # Long stripes are cut into segments.
    place = np.arange(len(runs)) - np.repeat(starts, np.diff(np.append(starts, len(runs))))
    starts = np.flatnonzero(place % SEGMENT == 0)
    offsets = pa.array(np.append(starts, len(runs)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(starts), pa.string()),
            words_of(first[starts]),
            pa.array(part[starts], pa.int32()),
            pa.ListArray.from_arrays(offsets, word(after)),
            pa.ListArray.from_arrays(offsets, pa.array(count, pa.int64())),
        ],
        ["lang", "prefix", "part", "next", "count"],
    )


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes merged element by element, their entries of ``least`` and more as rows of ENTRY. Segments come
    sorted; the stripe that a batch ends with is held for the next one."""
    names = ["lang", "prefix", "part", "next", "f"]
    held = None

    def entries(table: pa.Table) -> pa.Table:
        return table.filter(pc.greater_equal(table["f"], least)).select(["lang", "prefix", "next", "f"])

    for batch in batches:
        rows = pc.list_parent_indices(batch.column(3))
        columns = [batch.column(k).take(rows) for k in range(3)]
        flat = pa.Table.from_arrays([*columns, pc.list_flatten(batch.column(3)), pc.list_flatten(batch.column(4))], names)
        flat = flat if held is None else pa.concat_tables([held, flat])
        if not len(flat):
            continue
        summed = flat.group_by(names[:4], use_threads=False).aggregate([("f", "sum")]).rename_columns(names)
        last = [flat[k][-1] for k in names[:3]]
        is_last = pc.and_(pc.and_(pc.equal(summed["lang"], last[0]), pc.equal(summed["prefix"], last[1])), pc.equal(summed["part"], last[2]))
        held = summed.filter(is_last)
        yield from entries(summed.filter(pc.invert(is_last))).to_batches()
    if held is not None:
        yield from entries(held).to_batches()


def extensions(docs: DataFrame, common: DataFrame, size: int, words: int, least: int) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``size`` words that are found ``least`` times or more.

    ``common`` has the same of one word fewer, and ``words`` is the number of all words.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(sieve(common, size - 1))
    heavy = common.where(F.col("f").cast("decimal(38,0)") * SHARES > words).collect()
    parts_of = {(r["lang"], r["phrase"]): -(-r["f"] * SHARES // max(words, 1)) for r in heavy}

    def striped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        texts: dict[str, list[str]] = defaultdict(list)

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, own in texts.items():
                for data in slices(own):
                    rows = _stripes(lang, data, size, held, parts_of)
                    for at in range(0, rows.num_rows, 5_000):
                        yield rows.slice(at, 5_000)
            texts.clear()

        waiting = 0
        for batch in batches:
            # Gathered over batches, so that slices of rare languages are long as well.
            for lang, own in _by_language(batch).items():
                texts[lang] += own
                waiting += sum(map(len, own))
            if waiting >= SLICE:
                yield from sent()
                waiting = 0
        yield from sent()

    key = ["lang", "prefix", "part"]
    segments = docs.mapInArrow(striped, STRIPE).repartition(*key).sortWithinPartitions(*key)
    merged = segments.mapInArrow(lambda batches: _merged(batches, least), ENTRY)
    return merged.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "f")


def _first(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _last(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in decimals, as products pass 64 bits."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right))


def _scored(phrases: DataFrame, counts: dict[int, DataFrame], size: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` at the lowest-scoring cut."""
    rows, cuts = phrases.withColumnRenamed("f", "a"), []
    for k in range(1, size):
        for side, part, n in (("l", _first, k), ("r", _last, size - k)):
            known = counts[n].select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(f"{side}{k}"))
            rows = rows.join(known, (F.col("lang") == F.col("_lang")) & (part(F.col("phrase"), n) == F.col("_part"))).drop("_lang", "_part")
        cuts.append(F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), f"l{k}", f"r{k}"))
    cuts = [c.cast("struct<score: long, k: int, l: long, r: long>") for c in cuts]
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.withColumn("cut", lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered_percent: int = COVERED_PERCENT
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of the cut that scores lowest (ties: the first),
    ``n`` all words of the language, and ``score`` is floor(1000000 a a / (l r)). Phrases with a longer one
    around them that has ``covered_percent`` of their count are left out. ``docs`` has ``lang`` and ``text``.
    """
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = written(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    n = words.agg(F.sum("f")).first()[0] or 0
    counts = {1: words.where(F.col("f") >= least)}
    for size in range(2, longest + 1):
        counts[size] = written(extensions(docs, counts[size - 1], size, n, least), "phrases")
    kept = []
    for size in range(2, longest + 1):
        phrases = counts[size]
        if size < longest:
            # A longer phrase still around it has no higher count than one of the next length.
            around = [counts[size + 1].select("lang", part(F.col("phrase"), size).alias("phrase"), "f") for part in (_first, _last)]
            most = around[0].union(around[1]).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
            phrases = phrases.join(most, ["lang", "phrase"], "left").where(
                F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * covered_percent)
            )
        kept.append(_scored(phrases.select("lang", "phrase", "f"), counts, size))
    ranked = kept[0]
    for more in kept[1:]:
        ranked = ranked.union(more)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked in parts first, so that no task gets all phrases of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    near = ranked.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    near = near.where(F.col("rank") <= top)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return near.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
