from __future__ import annotations

import random

import corpus_pipeline


def test_stages_against_what_was_planted(spark, tmp_path):
    chance = random.Random(14)
    words = lambda n: " ".join("".join(chance.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    item = words(30)
    clean = [(i, words(80), "en", "s", 1) for i in range(150)]
    toxic = [(1000 + i, words(20) + " grumbolt vilethorn " + words(20) + " snarkwit grumbolt " + words(9), "en", "s", 1) for i in range(60)]
    copies = [(2000 + i, clean[i][1] + (" tail" if i % 2 else ""), "en", "s", 1) for i in range(10)]
    leaks = [(3000, words(5) + " " + item + " " + words(5), "en", "s", 1)]
    private = [(4000, words(40) + " write me@site.com", "en", "s", 1), (4001, words(40) + " or me@site.com", "en", "s", 1)]
    empty = [(5000, None, None, None, None), (5001, "", "", "", 0)]
    docs = spark.createDataFrame(clean + toxic + copies + leaks + private + empty, "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(1000 <= i < 2000)) for i, *_ in clean + toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, ids = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns and kept.schema == docs.schema
        ids.append({r["doc_id"] for r in kept.select("doc_id").collect()})
    assert len({i for i in ids[0] if 1000 <= i < 2000}) <= 6 and {i for i, *_ in clean} <= ids[0]
    assert ids[0] - ids[1] == {2000 + i for i in range(10)}
    assert ids[1] - ids[2] == {3000} and ids[3] == ids[2] >= {4000, 4001, 5000, 5001}
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    one, two = texts[4000][0].split()[-1], texts[4001][0].split()[-1]
    assert one == two != "me@site.com" and texts[4000][1] == len(texts[4000][0]) and texts[5000][0] is None
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in last} == ids[3] and all(r["round_trip"] for r in last)
    assert {r["doc_id"]: r["n_tokens"] for r in last}[5000] == 0


def test_clashing_names_a_long_text_and_an_empty_table(spark, tmp_path):
    chance = random.Random(15)
    words = lambda n: " ".join("".join(chance.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    schema = "doc_id long, text string, lang string, source string, n_chars int, _gone int, score string, _score int, decoded string"
    rows = [(i, words(60), "en", "s", 1, i, "x", 2, "y") for i in range(40)]
    rows += [(100, words(60_000), "en", "s", 1, 5, "x", 2, "y"), (None, None, None, None, None, None, None, None, None)]
    labels = [(i, 1, i % 2) for i in range(40)]
    for name, some in (("full", rows), ("empty", [])):
        sf_dir = f"{tmp_path}/{name}"
        spark.createDataFrame(some, schema).write.parquet(f"{sf_dir}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
        spark.createDataFrame([(1, words(30))], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == schema.replace(",", "").split(" ")[::2]
        got = {r["doc_id"]: r for r in corpus_pipeline.encode_texts(spark, docs, sf_dir).collect()}
        if some:
            assert {100, None} <= set(got) and got[100]["n_tokens"] > 60_000 and got[None]["n_tokens"] == 0
            assert all(r["round_trip"] for r in got.values())
        else:
            assert got == {}
