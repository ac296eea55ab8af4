from __future__ import annotations

import random

import numpy as np
import pytest

from dailymart.llm import hyperminhash as hmh

WORDS = [f"w{i}" for i in range(3000)]


def brute(rows, size, percent):
    """Component of each id by comparing all pairs of sets."""
    sets = {}
    for i, text in rows:
        words = [w for w in (text or "").encode().lower().split()]
        runs = [tuple(words[j : j + size]) for j in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets[i] = set(runs)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, words, copies, edits):
    out = []
    for _ in range(copies):
        text = list(words)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = rng.choice(WORDS)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rng = random.Random(7)
    texts = [None, "", " \n\t", "One", "one", "one two", "one  TWO", "é É", "É é"]
    for length, copies, edits in ((150, 90, 8), (60, 40, 3), (12, 20, 1), (400, 30, 20), (4, 10, 1)):
        texts += family(rng, rng.choices(WORDS, k=length), copies, edits)
    texts += [" ".join(rng.choices(WORDS, k=80)) for _ in range(60)] + [texts[20]] * 30
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component long").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in hmh.near_duplicates(docs, size, percent).collect()}
    want = {i: (n, c, c == i) for i, (n, c) in brute(rows, size, percent).items()}
    assert got == want


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Chains whose links the centres miss are found in blocks as well."""
    monkeypatch.setattr(hmh, "BLOCK", 16)
    rng = random.Random(3)
    texts = family(rng, rng.choices(WORDS, k=150), 150, 16)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in hmh.near_duplicates(docs, 3, 85).collect()}
    assert got == {i: c for i, (_, c) in brute(list(enumerate(texts)), 3, 85).items()}


def test_empty_table_null_ids_and_one_of_each(spark):
    schema = "doc_id long, text string, kept string, found int"
    assert hmh.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(WORDS[:30])
    rows = [(None, text, "a", 1), (5, text, "b", 2), (3, text, None, 3), (3, text, "d", None), (9, None, "e", 5)]
    docs = spark.createDataFrame(rows, schema)
    found = {(r.doc_id, r.component_id, r.kept) for r in hmh.near_duplicates(docs).collect()}
    assert found == {(None, None, True), (5, 3, False), (3, 3, True), (9, 9, True)}
    assert sorted(r.kept or "" for r in hmh.one_of_each(docs).collect()) == ["", "a", "d", "e"]


def test_estimates_are_corrected():
    rng = np.random.default_rng(1)
    for n in (50, 5000):
        sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(200)]
        table = hmh.registers_of(np.concatenate(sets), np.arange(0, 200 * n, n))
        found = hmh.estimates(table[0], table[1:], np.full(199, n))
        assert abs(found.mean()) < 0.002
    half = np.concatenate([sets[0][: n // 3 * 2], sets[1][: n // 3]])
    both = hmh.registers_of(np.concatenate([sets[0], half]), np.array([0, n]))
    assert abs(hmh.estimates(both[0], both[1:], np.array([n]))[0] - 0.5) < 0.2
