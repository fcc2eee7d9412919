from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from windrow.llm import collocations

SCHEMA = "doc_id long, text string, lang string"
LOWER = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least=10, longest=3, top=2000, covered=50):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    common = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    inside = {}
    for (lang, p), a in common.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(a, inside.get((lang, p[i:j]), 0))
    out = {}
    for (lang, p), a in common.items():
        if 100 * inside.get((lang, p), -1) >= covered * a:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, docs=150, vocabulary=12):
    chance = random.Random(seed)
    words = ["The", "the", "é", "É", "日本", "a\xa0b", "x\x1cy", "-"] + [f"w{i}" for i in range(vocabulary)]
    text = lambda n: "".join(chance.choice(words) + chance.choice(["  ", " ", " ", " ", "\t", ", ", ".", "\n", "\r\n"]) for _ in range(n))
    rows = [(i, text(chance.randint(0, 60)), chance.choice(["en", "en", "fr", None])) for i in range(docs)]
    rows += [(1, "new york city " * 30, "en"), (1, "new york city " * 30, "en"), (2, None, "en"), (3, "", None), (4, " \t.,", "xx")]
    return rows


@pytest.mark.parametrize("seed, longest", [(1, 3), (2, 3), (3, 4), (4, 2)])
def test_against_counting_by_hand(spark, seed, longest):
    rows = corpus(seed)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), longest=longest).collect()
    assert sorted(map(tuple, got)) == by_hand(rows, longest=longest)
    assert got[0].asDict().keys() == {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}


def test_split_stripes_small_segments_and_slices_give_the_same(spark, monkeypatch):
    rows = corpus(5) + [(9, "hot " + " hot ".join(f"w{i % 12}" for i in range(4000)), "en")]
    wanted = by_hand(rows, top=20)
    for name, value in {"SHARES": 7, "SEGMENT": 2, "ENTRIES": 50, "SLICE": 64}.items():
        monkeypatch.setattr(collocations, name, value)
    # The tasks' own copy of the module: shipped by value, so that the small numbers reach them.
    cloudpickle.register_pickle_by_value(collocations)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), top=20).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(collocations)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == wanted


def test_a_sieve_that_is_full_changes_nothing():
    data = b"a b c\nd e"
    full, none = np.full((1 << collocations.SIEVE_BITS) // 8, 255, np.uint8), np.zeros((1 << collocations.SIEVE_BITS) // 8, np.uint8)
    assert list(collocations.common_runs(data, 2, full, np.uint64(1))) == [(b"a", b"b"), (b"b", b"c"), (b"d", b"e")]
    assert list(collocations.common_runs(data, 3, full, np.uint64(1))) == [(b"a", b"b", b"c")]
    assert list(collocations.common_runs(data, 2, none, np.uint64(1))) == []
    assert list(collocations.common_runs(b"a", 2, full, np.uint64(1))) == []


def test_counts_past_64_bits(spark):
    rows = spark.createDataFrame([("en", "a b", 3 * 10**12)], "lang string, phrase string, f long")
    words = spark.createDataFrame([("en", "a", 4 * 10**12), ("en", "b", 5 * 10**12)], "lang string, phrase string, f long")
    got = collocations._scored(rows, {1: words}, 2).first()
    assert got["score"] == 1_000_000 * 9 // 20 and got["l"] == 4 * 10**12


def test_long_texts_empty_tables_and_other_columns(spark):
    rows = [(1, "one two " * 200_000 + "x" * 100_000, "en", 5, "p")]
    docs = spark.createDataFrame(rows, SCHEMA + ", rank int, phrase string")
    got = collocations.collocations(docs).collect()
    assert sorted(map(tuple, got)) == by_hand([r[:3] for r in rows])
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_stripes_of_a_slice(monkeypatch):
    hashed = []
    word_hashes = collocations._word_hashes
    monkeypatch.setattr(collocations, "_word_hashes", lambda data, starts, *rest: hashed.append(len(starts)) or word_hashes(data, starts, *rest))
    full = np.full((1 << collocations.SIEVE_BITS) // 8, 255, np.uint8)
    data = b"a b c a b a\n" * 1000
    assert len(list(collocations.common_runs(data, 2, full, np.uint64(1)))) == 5000
    assert hashed == [3]  # each distinct word once
    rows = collocations._stripes("en", data, 2, full, {}).to_pylist()
    got = {(r["prefix"], r["part"], w): n for r in rows for w, n in zip(r["next"], r["count"])}
    assert got == {("a", 0, "b"): 2000, ("b", 0, "a"): 1000, ("b", 0, "c"): 1000, ("c", 0, "a"): 1000} and len(rows) == 3
    monkeypatch.setattr(collocations, "SEGMENT", 1)
    rows = collocations._stripes("en", data, 3, full, {("en", "a b"): 2, ("en", "b c"): 5, ("fr", "b a"): 3}).to_pylist()
    got = {(r["prefix"], tuple(r["next"])): (r["count"], r["part"]) for r in rows}
    part = lambda word, n: collocations.crc32(word) % n
    assert got == {("a b", ("a",)): ([1000], part(b"a", 2)), ("a b", ("c",)): ([1000], part(b"c", 2)), ("b c", ("a",)): ([1000], part(b"a", 5)), ("c a", ("b",)): ([1000], 0)}
