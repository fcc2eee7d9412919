from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.llm import queries, toxicity
from windrow.llm.sampling import excerpt, sample_by_label

INSULTS = ["grumbolt", "snarkwit", "vilethorn"]


def make(chance, toxic, n=60):
    syllables = ["ka", "lo", "mir", "ten", "sa", "ru"]
    out = ["".join(chance.choice(syllables) for _ in range(chance.randint(1, 4))) for _ in range(n)]
    for _ in range(4 if toxic else 0):
        out[chance.randrange(n)] = chance.choice(INSULTS)
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(9)
    return [(i, make(chance, i % 5 == 0), int(i % 5 == 0)) for i in range(700)]


def test_held_out_accuracy(spark, tmp_path, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(-1, None, "x"), (-2, "", None), (3, rows[3][1], "y")], "doc_id long, text string, score string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op6_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 3 and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    truth = {i: y for i, _, y in rows}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["doc_id"] >= 0 or r["predicted"] == 0
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert sum(p for y, p in held if y) >= 0.9 * sum(y for y, _ in held)


def test_held_out_labels_are_never_read(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    flipped = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 3) = 1, 1 - toxic, toxic) toxic")
    assert toxicity.training_rows(docs, labels) == toxicity.training_rows(docs, flipped)


def test_few_or_no_labels(spark, rows):
    docs = spark.createDataFrame(rows[:4], "doc_id long, text string, toxic int")
    none = toxicity.score(docs, toxicity.fit([])).collect()
    assert all(r["score"] < 1e-9 for r in none)
    assert toxicity.score(docs.where("false"), toxicity.fit([])).count() == 0
    small = toxicity.fit([("grumbolt a", 1), ("ba", 0), ("grumbolt", 1), ("lo", 0)])
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, small).collect())


def test_samples_are_bounded_and_stable(spark):
    rows = spark.range(3000).selectExpr("id doc_id", "cast(id % 10 = 0 as int) toxic", "repeat('ab c', id) text")
    first = sample_by_label(rows, "toxic", 100, 200).select("doc_id", "toxic").collect()
    assert sorted(first) == sorted(sample_by_label(rows.repartition(7), "toxic", 100, 200).select("doc_id", "toxic").collect())
    assert len(first) <= 200 and 60 <= sum(r["toxic"] for r in first) <= 140
    assert {len(r[0]) for r in rows.where("doc_id > 10").select(excerpt(rows["text"], 30)).collect()} == {30}


def test_scores_keep_the_share_of_labels_at_every_size(spark, rows):
    # Labels that no word tells apart, 1 in 10 toxic: samples of equal size must not make it 1 in 2.
    docs = spark.createDataFrame([(i, t.replace("grumbolt", "ka").replace("snarkwit", "lo").replace("vilethorn", "sa")) for i, t, _ in rows], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 10 = 3 as int) toxic")
    sample = toxicity.training_rows(docs, labels, per_label=40)
    assert 0.3 < sum(y for _, y in sample) / len(sample) < 0.7
    cut = toxicity.score(docs, toxicity.trained(docs, labels, per_label=40)).agg({"score": "avg"}).first()[0]
    whole = toxicity.score(docs, toxicity.trained(docs, labels)).agg({"score": "avg"}).first()[0]
    assert abs(whole - 0.1) < 0.05 and abs(cut - 0.1) < 0.05
    assert toxicity.score(docs, toxicity.fit(sample)).agg({"score": "avg"}).first()[0] > 0.25


def test_order_of_words_counts():
    # Toxic texts differ from ordinary ones by nothing but one order of six words.
    chance = random.Random(4)
    six = "mirka lotensa rukalo samir tenmirlo karusa".split()

    def text(toxic):
        parts = []
        for _ in range(12):
            part = six[:]
            while part == six:
                chance.shuffle(part)
            parts.append(six if toxic and chance.random() < 0.6 else part)
        return " ".join(w for p in parts for w in p)

    model = toxicity.fit([(text(i % 2), i % 2) for i in range(600)])
    read = model.reader()
    right = sum((model.scores(np.array([read(text(i % 2))]))[0] >= 0.5) == bool(i % 2) for i in range(200))
    assert right >= 160, right


def test_long_texts_ties_and_repeated_ids(spark, rows):
    model = toxicity.fit([(t, y) for _, t, y in rows])
    long = " ".join(t for _, t, y in rows if not y) * 20
    docs = spark.createDataFrame([(1, long), (2, long + " grumbolt" * 4000), (3, long), (3, rows[0][1]), (3, rows[0][1])], "doc_id long, text string")
    got = sorted(map(tuple, toxicity.score(docs, model).select("doc_id", F.char_length("text"), "score").collect()))
    assert got[0][2] < got[1][2] and got[0][2] == got[4][2] and got[2] == got[3]
    labels = spark.createDataFrame([(3, 1), (2, 0), (1, 0)], "doc_id long, toxic int")
    sample = toxicity.training_rows(docs.union(docs), labels, per_label=50)
    assert len(sample) == len({i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 3 != 1})
    assert sample == toxicity.training_rows(docs.repartition(5), labels, per_label=50)
