from __future__ import annotations

import random
import re

import numpy as np
import pytest

from windrow.llm import near_duplicates as nd
from windrow.llm import queries
from windrow.llm.components import components
from windrow.llm.hashing import run_hashes, shingle_set, span_hashes, word_spans


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def reach(links, nodes):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, size))
    links = [
        (a, b) for a in sets for b in sets if a < b
        and any(len(x & y) and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    least = reach(links, sets)
    return sorted(((i, len(shingles(t, size)), least.get(i), i is None or least[i] == i) for i, t in rows), key=repr)


def make(chance, n):
    return [f"{chance.choice('abcdefgh')}{chance.randint(0, 400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    chance, out = random.Random(7), []
    for base in range(6):
        words = make(chance, 120)
        for _ in range(12):
            new = list(words)
            for _ in range(chance.randint(0, 5)):
                new[chance.randrange(len(new))] = "x" + str(chance.random())
            out.append(" ".join(new))
    chain = make(chance, 100)
    for step in range(25):  # neighbours alike, ends not
        chain = chain[1:] + make(chance, 1)
        out.append("  ".join(chain).upper())
    passage = " ".join(make(chance, 60))
    out += [passage + " " + " ".join(make(chance, 20)) for _ in range(30)]
    out += [None, "", " \n", "one", "ONE", "one two", "one two three", "w" * 50_000, out[0], out[0]]
    numbered = [(i * 3 % 1000, t) for i, t in enumerate(out)]
    return numbered + [(None, out[0]), (None, None), numbered[0], (numbered[0][0], out[20])]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, rows, size, percent):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, component string")
    got = sorted((tuple(r) for r in nd.near_duplicates(docs, size, percent).collect()), key=repr)
    assert got == brute(rows, size, percent)
    assert nd.near_duplicates(docs.where("false"), size, percent).count() == 0


def test_words_hash_alike_wherever_they_stand():
    a = np.frombuffer("  x yy\tzzz yy\n".encode(), np.uint8)
    h = span_hashes(a, *word_spans(a))
    assert len(h) == 4 and h[1] == h[3] and len(set(h.tolist())) == 3
    assert len(run_hashes(h, 3)) == 2 and len(run_hashes(h[:2], 3)) == 1 and len(run_hashes(h[:0], 3)) == 0
    assert len(shingle_set("É é", 1)) == 2


def test_signatures_estimate_the_similarity():
    chance = np.random.default_rng(1)
    pool = chance.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = nd.signatures([pool[:1000], pool[200:1200]], 480)
    assert abs((a == b).mean() - 800 / 1200) < 0.08
    assert len(np.unique(nd.band_keys(np.array([a]), 6))) == 80


def test_components(spark):
    chance = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(5, 5), (200, 201), (201, 200), (None, 3)]
    edges += [(300 + chance.randint(0, 40), 300 + chance.randint(0, 40)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "p long, q long")).collect()}
    nodes = {x for e in edges if None not in e for x in e}
    want = reach([e for e in edges if None not in e], nodes)
    assert got == {n: low for n, low in want.items() if n != low}


def test_query(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op4_minhash(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(rows, 3, 85)


def test_pairs_short_of_the_threshold_are_not_compared_on_their_texts(spark, monkeypatch):
    chance, out = random.Random(11), []
    shared = make(chance, 130)
    for _ in range(150):  # about 0.7 alike: many share a band, none is a link
        out.append(" ".join(shared + make(chance, 27)))
    rows, compared = list(enumerate(out)), []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    similar = nd.similar
    monkeypatch.setattr(nd, "similar", counted)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 3, 85)
    assert sum(compared) < 150


def test_parity_maps_never_hide_a_link():
    chance = np.random.default_rng(3)
    sets = []
    for n in (1, 2, 31, 33, 60, 400, 520, 1030):
        base = chance.integers(0, 2**63, n).astype(np.uint64)
        sets += [np.unique(np.concatenate([base[: n - n // k], chance.integers(0, 2**63, n // k).astype(np.uint64)])) for k in (5, 9, 15, 40, 2000)]
    sizes, maps = np.array([len(s) for s in sets]), [nd.parity(s) for s in sets]
    groups, sides = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    i, j, _ = nd.near_pairs(sizes, maps, groups, sides, 85)
    found = {frozenset(p) for p in zip(i.tolist(), j.tolist())}
    links = set()
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                links.add(frozenset((a, b)))
    assert len(links) > 20 and links <= found and len(found) == len(i)
    for a in range(len(sets)):
        at, _ = nd.near_first(sizes, maps, np.full(len(sets), a), 85)
        assert {frozenset((a, b)) for b in at.tolist()} == {p for p in found if a in p}
    half = (groups % 2).astype(np.int64)
    i, j, _ = nd.near_pairs(sizes, maps, groups, half, 85)
    assert {frozenset(p) for p in zip(i.tolist(), j.tolist())} == {p for p in found if len({half[k] for k in p}) == 2}
