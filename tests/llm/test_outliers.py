from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from windrow.llm import outliers as o
from windrow.llm import queries


def stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def make(chance, n=90):
    return " ".join("".join(chance.choice("abcdefgh") for _ in range(chance.randint(2, 8))) for _ in range(n))


TRICKY = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\nx\nx \n\n \nx\x0b\x0cf", "é😀 #|<\xa0b", "$ " * 30_000]


def test_statistics_equal_brute_force(spark):
    chance = random.Random(1)
    texts = TRICKY + [" ".join(chance.choice("ab\n") for _ in range(chance.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, h int")
    for row in o.statistics(docs).collect():
        assert tuple(row[c] for c in o.STATISTICS) == stats(texts[row["doc_id"]]), texts[row["doc_id"]]


def brute_estimate(x, floors, share, steps):
    """The same concentration steps on all rows at once."""
    q = np.sort(x, axis=0)
    at = lambda p: q[int(np.ceil(p * len(x))) - 1]
    m, cov = at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + np.diag(np.square(floors))
    widen = share / o._chi_square(x.shape[1] + 2, o.chi_square_quantile(x.shape[1], share))
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        b = np.floor(np.log1p(d) * o.BINS_PER_E)
        near = x[b <= np.sort(b)[int(np.ceil(len(x) * share)) - 1]]
        m, cov = near.mean(axis=0), np.cov(near.T, bias=True) * widen + np.diag(np.square(floors))
    return m, cov


def test_estimates_equal_brute_force(spark):
    chance = np.random.default_rng(2)
    floors, rows, groups = [0.3, 0.1, 0.2], [], {}
    for g in ("a", "b"):
        x = chance.normal(size=(300, 3)) @ chance.normal(size=(3, 3)) + chance.normal(size=3)
        x[:60] += 25
        groups[g] = x
        rows += [(g, *map(float, v)) for v in x]
    got = o.robust_estimates(spark.createDataFrame(rows, "g string, x0 double, x1 double, x2 double"), floors).collect()
    for row in got:
        m, cov = brute_estimate(groups[row["g"]], floors, o.SHARE, o.STEPS)
        lower = np.zeros((3, 3))
        lower[np.tril_indices(3)] = row["e"]["l"]
        assert row["n"] == 300 and np.allclose(row["e"]["m"], m) and np.allclose(lower @ lower.T, cov)


def test_planted_outliers_go_and_clean_rows_stay(spark):
    chance, rows = random.Random(3), []
    for i in range(400):
        rows.append((i, make(chance), "en" if i % 2 else None, "hot" if i % 3 else f"s{i % 7}"))
    rows += [(1000 + i, make(chance).replace(" ", " ### "), "en", "hot") for i in range(30)]
    rows += [(2000 + i, t, "xx", None) for i, t in enumerate(TRICKY)] + [rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = o.reject_outliers(docs, least_rows=50).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] for r in got if r["doc_id"] < 1000)
    assert not any(r["kept"] for r in got if r["doc_id"] >= 1000)
    assert {r["base_failed"] for r in got if r["doc_id"] >= 2000} == {True}
    assert {r["base_failed"] for r in got if 1000 <= r["doc_id"] < 2000} == {False}
    assert o.reject_outliers(docs.where("false")).count() == 0


def test_query_has_no_python(spark, tmp_path):
    rows = [(i, make(random.Random(i)), "en", "s", 9) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    result = queries.op7_outliers(spark, str(tmp_path))
    assert "Python" not in result._jdf.queryExecution().toString()
    assert [r["kept"] for r in result.collect()] == [True] * 60
