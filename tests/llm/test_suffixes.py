from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dailymart.llm import suffixes


def brute(texts):
    """(bytes, removed, runs, hash of the rest) of each text by a table of all strings of 200 bytes."""
    seen = defaultdict(list)
    data = [(t or "").encode() for t in texts]
    for i, text in enumerate(data):
        for s in range(len(text) - 199):
            seen[text[s : s + 200]].append((i, s))
    gone = [bytearray(len(t)) for t in data]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + 200] = b"\1" * 200
    out = []
    for text, mark in zip(data, gone):
        rest = bytes(b for b, m in zip(text, mark) if not m)
        runs = sum(1 for k in range(len(mark)) if mark[k] and (k == 0 or not mark[k - 1]))
        out.append((len(text), sum(mark), runs, hashlib.sha256(rest).hexdigest()))
    return out


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n))


def corpus():
    rng = random.Random(11)
    passages = [words(rng, 60) for _ in range(6)]
    edge = "x" * 200
    texts = [None, "", "short", "a" * 199, "b" * 200, "c" * 201, "ab" * 130, "xyz" * 90 + "q", edge, edge + "y", "z" + edge]
    texts += ["d" * 70000 + words(rng, 30), words(rng, 30) + "d" * 500]
    for _ in range(40):
        parts = [words(rng, rng.randint(1, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3)
            parts += [p[a : a + rng.randint(150, 400)], words(rng, rng.randint(0, 30))]
        texts.append("".join(parts))
    return texts + [texts[20]] * 3 + [texts[25]]


@pytest.mark.parametrize("many", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, many):
    """With and without anchors whose segments are too many for one sort."""
    monkeypatch.setattr(suffixes, "SORTED_SEGMENTS", many)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.removals(docs.repartition(4)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_cut_texts_keep_characters_rows_and_columns(spark):
    rng = random.Random(2)
    shared = "é" * 150
    rows = [(1, words(rng, 9) + "n" + shared + "1", 7, "k"), (2, shared + "2", None, None), (None, None, 3, "z"), (4, "", 0, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row string")
    got = sorted((tuple(r) for r in suffixes.without_repeats(docs).collect()), key=str)
    want = [(1, rows[0][1].replace(shared, ""), len(rows[0][1]) - 150, "k"), (2, "2", 1, None), (None, None, None, "z"), (4, "", 0, "w")]
    assert got == sorted(want, key=str)
    assert suffixes.without_repeats(docs.limit(0)).columns == docs.columns
    assert suffixes.removals(docs.limit(0)).collect() == []


def test_a_range_inside_a_character_keeps_it():
    text = "aé☃b".encode()
    assert suffixes.without(text, [(2, 5)]) == "aé☃b"
    assert suffixes.without(text, [(1, 6)]) == "ab"
    assert suffixes.without(text, [(0, 2), (3, 6)]) == "é b".replace(" ", "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=200, max_size=230).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=12))
def test_order_is_the_sorted_order(contents):
    data = np.frombuffer(b"".join(contents), np.uint8)
    at = np.cumsum([0, *map(len, contents)])
    starts = np.concatenate([np.arange(a, b - 199) for a, b in zip(at, at[1:])])
    order, same = suffixes.deep_shallow_order(data, starts, np.zeros(len(starts), np.int64))
    strings = [data[s : s + 200].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert same.tolist() == [False, *(a == b for a, b in zip(strings, strings[1:]))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=6, max_size=6).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=40))
def test_blind_trie(strings):
    leaves = list(suffixes.blind_trie_order(strings))
    assert [strings[i] for leaf in leaves for i in leaf] == sorted(strings)
    assert len(leaves) == len(set(strings))
