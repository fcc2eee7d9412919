"""Benchmark decontamination over a distributed positional inverted index, in DataFrame operations.

The index holds where each test term stands in the training texts. A phrase is looked up by the
posting lists of its rarest terms: shifted by their offsets in the phrase, the lists meet where it
may start. Each such start is then compared with the text itself.

Everywhere here: null and empty texts have no words and match nothing; repeated rows each get their
own result; null ids are kept and judged by their own texts; empty tables give empty results, or no
hits where only the test table is empty; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.session import scratch_dir

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
# Rarest terms of a window whose lists are intersected before the text is compared.
ANCHORS = 2


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    # Cutting between the words takes a seventh of the time of extracting each by a pattern.
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _phrase_key(tokens: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(tokens, " ").cast("binary"), 256))


def phrases(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``item_id, phrase, tokens``: each run of ``size`` words; a shorter text is one phrase."""
    tokens = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    runs = F.expr(f"transform(sequence(0, greatest(size(w) - {size}, 0)), i -> slice(w, i + 1, {size}))")
    return tokens.select("item_id", F.explode(runs).alias("tokens")).select(
        "item_id", _phrase_key(F.col("tokens")).alias("phrase"), "tokens"
    )


def build_index(docs: DataFrame, terms: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the postings ``doc_id, pos, term`` of the given ``term``s in all of ``docs`` to ``path``.

    One pass without a shuffle of the texts; ``terms`` (64-bit word hashes) are broadcast only if
    Spark finds them small enough. Rows lie by document, so each file compresses well.
    """
    tokens = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(words(F.col(text_col))).alias("pos", "word"))
    tokens = tokens.select("doc_id", "pos", F.xxhash64("word").alias("term"))
    tokens.join(terms.select("term").distinct(), "term", "left_semi").select("doc_id", "pos", "term").write.parquet(path)
    return docs.sparkSession.read.schema(tokens.schema).parquet(path)


def anchors(index: DataFrame, wanted: DataFrame, count: int = ANCHORS) -> DataFrame:
    """``phrase, n_tokens, n_anchors, anchor, offset, term``: the ``count`` rarest terms of each
    phrase, rarest first, ties by offset. Phrases with a term that the index lacks are left out."""
    frequency = index.groupBy("term").agg(F.count("*").alias("n"))
    terms = wanted.select("phrase", F.size("tokens").alias("n_tokens"), F.posexplode("tokens").alias("offset", "word"))
    found = terms.select("phrase", "n_tokens", "offset", F.xxhash64("word").alias("term")).join(frequency, "term")
    ranked = found.groupBy("phrase", "n_tokens").agg(
        F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("all")
    )
    rarest = ranked.where("size(all) = n_tokens").select("phrase", "n_tokens", F.slice("all", 1, count).alias("few"))
    return rarest.select(
        "phrase", "n_tokens", F.size("few").alias("n_anchors"), F.posexplode("few").alias("anchor", "a")
    ).select("phrase", "n_tokens", "n_anchors", "anchor", "a.offset", "a.term")


def _shifted(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """The anchors' posting lists, each shifted to where its phrase would start."""
    return index.join(rarest, "term").select(
        "doc_id", "phrase", "n_tokens", "n_anchors", "anchor", (F.col("pos") - F.col("offset")).alias("start")
    )


def phrase_candidates(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """``doc_id, phrase, n_tokens, start``: where all shifted lists of a phrase agree."""
    lists = _shifted(index, rarest).where("start >= 0")
    met = lists.groupBy("doc_id", "phrase", "n_tokens", "n_anchors", "start").agg(F.count("*").alias("n"))
    return met.where("n >= n_anchors").select("doc_id", "phrase", "n_tokens", "start")


def proximity_matches(index: DataFrame, rarest: DataFrame, slop: int) -> DataFrame:
    """``doc_id, phrase, start``: where the rarest term stands with each other anchor at most
    ``slop`` words off its place. Exact places count too; ``slop=0`` gives those alone."""
    lists, width = _shifted(index, rarest), slop + 1
    first = lists.where("anchor = 0").withColumn(
        "near", F.explode(F.array(*[F.floor(F.col("start") / width) + i for i in (-1, 0, 1)]))
    )
    others = lists.where("anchor > 0").select(
        "doc_id", "phrase", "anchor", F.col("start").alias("other"), F.floor(F.col("start") / width).alias("near")
    )
    close = first.drop("anchor").join(others, ["doc_id", "phrase", "near"]).where(f"abs(start - other) <= {slop}")
    close = close.select("doc_id", "phrase", "n_anchors", "start", "anchor").distinct()
    met = close.groupBy("doc_id", "phrase", "n_anchors", "start").agg(F.count("*").alias("n"))
    alone = lists.where("n_anchors = 1").select("doc_id", "phrase", "start")
    return met.where("n = n_anchors - 1").select("doc_id", "phrase", "start").unionByName(alone).distinct()


def phrase_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW, count: int = ANCHORS,
) -> tuple[DataFrame, DataFrame]:
    """Exact occurrences of the items' phrases in the documents.

    Returns ``doc_id, text_key, n_words, hits`` (one row per row of ``docs``; ``hits`` an array of
    ``start, n_tokens, phrase``) and ``phrase, item_id``, the items of each phrase. Rows of one id
    with different texts differ in ``text_key``. The index and the first result are written to the
    shared scratch folder, so lost executors cost only their tasks.
    """
    spark = docs.sparkSession
    of_item = phrases(items, item_col, item_text_col, size)
    wanted = of_item.dropDuplicates(["phrase"]).select("phrase", "tokens")
    terms = wanted.select(F.explode("tokens").alias("word")).select(F.xxhash64("word").alias("term"))
    index = build_index(docs, terms, scratch_dir(spark, "postings"), id_col, text_col)
    starts = phrase_candidates(index, anchors(index, wanted, count))
    by_doc = starts.groupBy(F.col("doc_id").alias("found_id")).agg(
        F.collect_list(F.struct("start", "n_tokens", "phrase")).alias("may")
    )
    # The texts go through the shuffle as they are and are cut into words behind it: word lists are larger.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(by_doc, F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    joined = joined.select("doc_id", "may", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    same = "filter(coalesce(may, array()), c -> c.phrase = unhex(sha2(cast(array_join(slice(w, c.start + 1, c.n_tokens), ' ') as binary), 256)))"
    path = scratch_dir(spark, "hits")
    joined.select("doc_id", "text_key", F.size("w").alias("n_words"), F.expr(same).alias("hits")).write.parquet(path)
    return spark.read.parquet(path), of_item.select("phrase", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, least_percent: int = 5, **columns) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, contaminated``, one row per row of ``docs``.

    ``n_hit`` counts the words that lie inside any phrase of an item, ``item_ids`` lists those items
    sorted as strings; a document is contaminated if it has hits and they are at least
    ``least_percent`` of its words.
    """
    found, of_item = phrase_hits(docs, items, **columns)
    covered = F.expr("size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.n_tokens - 1)))))")
    counted = found.select(
        "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit")
    )
    pairs = found.select("doc_id", "text_key", F.explode(F.expr("array_distinct(hits.phrase)")).alias("phrase"))
    pairs = pairs.join(of_item, "phrase").select("doc_id", "text_key", F.col("item_id").cast("string").alias("item_id"))
    listed = pairs.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    return counted.join(listed, here, "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= least_percent * F.col("n_words"))).alias("contaminated"),
    )
