from __future__ import annotations

import random

import pytest

from windrow.llm import licences as lc
from windrow.llm import queries


@pytest.fixture(scope="module")
def plain():
    chance, syllables = random.Random(11), ["ka", "lo", "mir", "the", "of", "this", "work", "is", "under"]
    word = lambda: "".join(chance.choice(syllables) for _ in range(chance.randint(1, 3)))
    return [" ".join(word() for _ in range(chance.randint(3, 40))) for _ in range(400)]


@pytest.fixture(scope="module")
def model(plain):
    return lc.fit(plain)


def test_whole_templates_are_found(model):
    for family, wordings in lc.TEMPLATES.items():
        for wording in wordings:
            assert [x[0] for x in lc.find(model, wording)] == [family], wording


def test_found_between_other_text(model, plain):
    wording = lc.TEMPLATES["GPL"][0]
    text = "\n".join([*plain[:5], wording.upper(), *plain[5:9]])
    (family, start, end), = lc.find(model, text)
    assert family == "GPL" and wording.upper().rstrip(".") in text.encode()[start:end].decode()
    joined = " ".join(plain[:30]) + " " + wording + " " + " ".join(plain[30:60])
    assert {x[0] for x in lc.find(model, joined)} == {"GPL"}


def test_ordinary_text_and_unknown_licences(model, plain):
    assert sum(bool(lc.find(model, p)) for p in plain) == 0
    assert {x[0] for w in lc.OTHER_WORDINGS for x in lc.find(model, w)} <= {"unknown"}
    for odd in (None, "", " \n ", "!!!", "a", "\n" * 50_000, "x " * 100_000):
        assert lc.find(model, odd) == []


def test_template_comparison_confirms(model):
    assert lc.agreement("Released under the MIT License!", "MIT") == 1.0
    assert lc.agreement("some other words here", "MIT") == 0.0


def test_query(spark, tmp_path, plain):
    rows = [(i, p) for i, p in enumerate(plain)] + [(-1, None), (-2, "x\n" + lc.TEMPLATES["MIT"][0]), (-2, "x\n" + lc.TEMPLATES["MIT"][0])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licences int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_licences(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {(r["families"], r["n_licence_paragraphs"]) for r in got if r["doc_id"] == -2} == {("MIT", 1)}
    assert {(r["families"], r["n_licence_paragraphs"]) for r in got if r["doc_id"] != -2} == {("", 0)}
    assert lc.scan(docs.where("false"), lc.fit([], each=5, epochs=1)).count() == 0
