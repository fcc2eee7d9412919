"""Quality by importance resampling.

Two generative models over hashed word n-grams, one of target text and one of all raw text, give each
document a log weight: the mean log ratio of its n-grams, scaled to SCALE of them so that length
does not decide. Adding Gumbel noise that depends on the id and the seed alone and keeping the k
largest keys draws k documents without replacement by their weights.

Null texts and texts without words have weight 0 in logarithm, that of a neutral text. Rows whose
key ties with the k-th are all kept. Repeated rows share their id's noise. Without target rows all
weights are equal. Texts of any length are read whole. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.components import written
from windrow.llm.hashing import as_bytes, run_hashes, span_hashes, word_spans

BUCKETS = 10_000
LONGEST = 2
SCALE = 50.0
SMOOTHING = 0.5
BINS = 4_096
# Bits of the sieve that target ids leave, in words of 64: at most 2**18 rows are broadcast.
SIEVE_BITS = 1 << 24
# A bin of no more rows than this is sorted to find the k-th key.
SORTED_ROWS = 10_000


def ngrams(text: str | None) -> np.ndarray:
    """Buckets of the text's words and word pairs, as they are written."""
    data = as_bytes(text)
    words = span_hashes(data, *word_spans(data))
    runs = [run_hashes(words, n) for n in range(1, LONGEST + 1) if len(words) >= n]
    return (np.concatenate(runs) % np.uint64(BUCKETS)).astype(np.int64) if runs else np.empty(0, np.int64)


def bucket_counts(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``bucket, raw, target``: n-grams of all documents and of those in ``target_ids``.

    A task sends one row per bucket, whatever it has read. All texts are counted where they are read;
    the target texts alone are moved, to meet their ids by key (Spark splits heavy keys). One plan for
    ``target_ids`` of any size.
    """
    wanted = target_ids.select(F.col("doc_id").alias("t")).where("t is not null").distinct()
    raw = _counted(docs.select("text")).withColumnRenamed("n", "raw").withColumn("target", F.lit(0).cast("long"))
    # An inner join with distinct ids: Catalyst would push a semi-join below the sieve.
    meant = sifted(docs.select("doc_id", "text"), wanted).join(wanted.hint("merge"), F.col("doc_id") == F.col("t"))
    target = _counted(meant.select("text")).select("bucket", F.lit(0).cast("long").alias("raw"), F.col("n").alias("target"))
    return raw.unionByName(target).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def sifted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` may be in ``wanted`` (``t``), with all that are: those whose
    hash meets a bit of the sieve, a table of fixed size. However full it is, none is lost. Ids are
    whole numbers of any width, or strings."""
    place = lambda x: F.pmod(F.xxhash64(F.col(x).cast("string")), F.lit(SIEVE_BITS))
    word = lambda x: F.shiftright(place(x), 6)
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place(x), F.lit(64)).cast("int"))
    words = wanted.groupBy(word("t").alias("word")).agg(F.bit_or(bit("t")).alias("bits"))
    near = docs.join(F.broadcast(words), word("doc_id") == F.col("word"))
    return near.where(F.col("bits").bitwiseAND(bit("doc_id")) != 0).drop("word", "bits")


def _counted(texts: DataFrame) -> DataFrame:
    """``bucket, n``: one row per bucket and task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                n += np.bincount(ngrams(text.as_py()), minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(n)], ["bucket", "n"])

    return texts.mapInArrow(counted, "bucket long, n long")


def log_ratios(counts: DataFrame) -> np.ndarray:
    """One number per bucket; BUCKETS rows reach the driver."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS))
    return share(target) - share(raw)


def with_log_weight(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", out_col: str = "log_weight") -> DataFrame:
    @F.arrow_udf("double")
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [ngrams(t.as_py()) for t in texts]
            yield pa.array([SCALE * float(ratios[g].mean()) if len(g) else 0.0 for g in found], pa.float64())

    return docs.withColumn(out_col, weighed(F.col(text_col)))


def kth_largest(rows: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest ``key``, exactly. Each pass counts by bins and goes on within one of them."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k < 1:
        return None
    k = min(k, n)
    while low < high and n > SORTED_ROWS:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1))
        bins = rows.where(F.col(key).between(low, high)).groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["b"]):
            if k <= row["n"]:
                low, high, n = row["low"], row["high"], row["n"]
                break
            k -= row["n"]
    if low == high:
        return low
    return rows.where(F.col(key).between(low, high)).orderBy(F.col(key).desc()).limit(k).agg(F.min(key)).first()[0]


def resample(
    docs: DataFrame, target_ids: DataFrame, share: float = 0.75, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, log_weight, key, kept``, one row per row of ``docs``; ``share`` of them are kept.

    The target model counts every document whose id is in ``target_ids``, the raw model every
    document.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ratios = log_ratios(bucket_counts(texts, target_ids))
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = with_log_weight(texts, ratios).select(
        "doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(uniform))).alias("key")
    )
    keyed = written(keyed, "weights")
    least = kth_largest(keyed, "key", int(np.ceil(share * keyed.count())))
    return keyed.select("*", (F.col("key") >= F.lit(least)).alias("kept") if least is not None else F.lit(False).alias("kept"))
