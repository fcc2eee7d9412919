from __future__ import annotations

import random

import pytest

from windrow.llm import language, queries

SYLLABLES = {"aa": ["ka", "lo", "mir"], "bb": ["sch", "ein", "ung"], "cc": ["ñe", "ción", "ra"], "rare": ["ш", "ка", "ло"]}


def make(chance, lang, n=30):
    return " ".join("".join(chance.choice(SYLLABLES[lang]) for _ in range(chance.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    chance, out = random.Random(10), []
    for i in range(600):
        lang = "rare" if i % 40 == 0 else ["aa", "bb", "cc"][i % 3]
        out.append((i, make(chance, lang, chance.choice([1, 5, 30])), lang))
    return out


def test_held_out_accuracy(spark, tmp_path, rows):
    odd = [(-1, None, "aa"), (-2, " 12 !", "bb"), (-3, "", None), (-4, make(random.Random(1), "aa", 200_000), None), (rows[0])]
    docs = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, lang string, language string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_language(spark, str(tmp_path)).collect()
    truth = {i: x for i, _, x in rows}
    assert len(got) == len(rows) + 5
    for r in got:
        if r["doc_id"] in (-1, -2, -3):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in SYLLABLES and 0 < r["score"] <= 1
    assert [r["lang_pred"] for r in got if r["doc_id"] == -4] == ["aa"]
    held = [(truth[r["doc_id"]], r["lang_pred"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_held_out_rows_are_never_read(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    changed = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 'zz', lang) lang")
    assert {x[1] for x in language.training_rows(changed)} == set(SYLLABLES)


def test_blocks_agree_with_one_pass(monkeypatch):
    text = "Ein Wort, noch 3 Wörter " * 40
    whole = sorted(x for part in language.subwords(text) for x in part.tolist())
    monkeypatch.setattr(language, "BLOCK", 37)
    assert whole == sorted(x for part in language.subwords(text) for x in part.tolist())


def test_nothing_to_learn_from(spark, rows):
    docs = spark.createDataFrame(rows[:3], "doc_id long, text string, lang string")
    model = language.fit([])
    assert {r["language"]["lang_pred"] for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(docs.where("false"), model).count() == 0
