from __future__ import annotations

import random

import numpy as np
import pytest

from dailymart.llm import decontaminate as dc

WORDS = [f"w{i}" for i in range(2000)]


def brute_score(item, text):
    """Smith-Waterman over the whole text, cell by cell."""
    best = 0
    above = [0] * (len(text) + 1)
    for a in item:
        here = [0]
        for j, b in enumerate(text, 1):
            here.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 1, here[-1] - 1))
        best, above = max(best, *here), here
    return best / (2 * len(item))


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        if r < 2 * share / 3:
            out.append(rng.choice(WORDS))
        out.append(rng.choice(WORDS) if share * 2 / 3 < r < share else w)
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    items = [rng.choices(WORDS, k=rng.randint(12, 60)) for _ in range(20)] + [["one", "two"], WORDS[:5] * 4]
    texts = []
    for k in range(160):
        words = rng.choices(WORDS, k=rng.randint(0, 300))
        if k % 2:
            copy = edited(rng, items[k // 2 % 20], rng.choice([0, 0.1, 0.2, 0.6]))
            at = rng.randint(0, len(words))
            words[at:at] = copy
        texts.append(words)
    texts += [["x", "one", "two", "y"], items[20], items[3] + items[3], items[4] + items[5]]
    return items, texts


def test_equals_whole_text_alignment(spark, monkeypatch, case):
    monkeypatch.setattr(dc, "BLOCK_WORDS", 700)  # several passes
    items, texts = case
    bench = spark.createDataFrame([(i, " ".join(w).title()) for i, w in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in dc.matches(docs.repartition(3), bench).collect()}
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            score = brute_score(item, text)
            if score >= 0.5 and (len(item) >= dc.SHORT or " ".join(item) in " ".join(text)):
                want[d, i] = score
    assert {k: r.score for k, r in got.items()} == pytest.approx(want)
    for (d, i), r in got.items():
        assert brute_score(items[i], texts[d][r.first_word : r.last_word + 1]) == pytest.approx(r.score)


def test_an_item_in_most_documents_is_found_and_common_words_are_not(spark):
    rng = random.Random(1)
    item = rng.choices(WORDS, k=30)
    common = ["of", "the", "and", "in"]
    other = rng.choices(WORDS, k=14) + common
    docs = [(i, " ".join(rng.choices(WORDS, k=50) + common + (item if i % 3 else []))) for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other))], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.matches(frame, bench).collect()}
    assert found == {(i, 1) for i in range(60) if i % 3}
    assert {r.doc_id for r in dc.clean(frame, bench).collect()} == {i for i in range(60) if i % 3 == 0}


def test_nulls_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e", "s"), (1, None, None), (2, "", "x"), (3, "A, b; c d!", "y"), (3, "A, b; c d!", "y")],
        "doc_id long, text string, item string",
    )
    bench = spark.createDataFrame([(7, "a b c d", 1.0), (8, None, 0.0), (None, "!", 2.0)], "item_id long, text string, score double")
    found = sorted(dc.matches(docs, bench).select("doc_id", "item_id", "score").collect(), key=str)
    assert [tuple(r) for r in found] == [(3, 7, 1.0), (None, 7, 1.0)]
    assert sorted(r.item or "" for r in dc.clean(docs, bench).collect()) == ["", "s", "x"]
    assert dc.matches(docs.limit(0), bench).collect() == []
    assert dc.matches(docs, bench.limit(0)).collect() == []
    assert dc.clean(docs, bench.limit(0)).count() == 5


def test_alignment_of_many_at_once():
    rng = np.random.default_rng(2)
    items = [rng.integers(1, 9, rng.integers(1, 12)).astype(np.uint64) for _ in range(50)]
    windows = [rng.integers(1, 9, rng.integers(1, 30)).astype(np.uint64) for _ in range(50)]
    best, _ = dc.align(items, windows)
    want = [brute_score(i.tolist(), w.tolist()) * 2 * len(i) for i, w in zip(items, windows)]
    assert best.tolist() == pytest.approx(want)


def test_edited_copies_beside_many_literal_ones_are_found(spark):
    """Seeds that stand in very many documents are often the only ones an edited copy has."""
    rng = random.Random(8)
    item = rng.sample(WORDS, 15)
    copies = [item] * 260 + [item[:6] + ["x", "y", "z"] + item[9:], item[:5] + ["x"] * 10]
    texts = [rng.choices(WORDS, k=8) + copy + rng.choices(WORDS, k=8) for copy in copies]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in dc.matches(frame, bench).collect()}
    want = {i: brute_score(item, t) for i, t in enumerate(texts)}
    assert got == pytest.approx({i: s for i, s in want.items() if s >= 0.5})
    assert got.keys() == set(range(261))


def test_no_copy_at_the_threshold_is_lost(spark):
    """Copies edited at random until they score a half or little more: all pairs of texts are aligned for comparison."""
    rng = random.Random(4)
    few = WORDS[:40]  # few words, so that seeds are common and many are left out
    items = [rng.choices(few if k % 2 else WORDS, k=rng.randint(8, 25)) for k in range(24)] + [rng.sample(WORDS, 15)]
    texts = [[w if k % 4 else "x" for k, w in enumerate(items[-1], 1)], [x for w in items[0] for x in (w, "y")]]
    for k in range(700):
        item = items[k % len(items)]
        copy = edited(rng, item, rng.uniform(0.2, 0.75))
        texts.append(rng.choices(few, k=rng.randint(0, 30)) + copy + rng.choices(few, k=rng.randint(0, 30)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in dc.matches(docs.repartition(4), bench).collect()}
    want = {(d, i): s for d, t in enumerate(texts) for i, w in enumerate(items) if (s := brute_score(w, t)) >= 0.5}
    assert got == pytest.approx(want)
    assert sum(0.5 <= s < 0.6 for s in want.values()) > 60 and (0, len(items) - 1) in got and (1, 0) in got


def test_seeds_left_out_are_the_common_ones():
    seeds = dc.Seeds(["a b c d e f g h i j", "a b c"])
    pairs = seeds.counted()
    common = dc._pairs(dc.word_hashes([b"c", b"d", b"e"]))[0]
    seeds.rare(pairs, np.isin(pairs, common) * 7 + 1)
    _, item, place, _ = seeds.tables[dc.PAIRS]
    # Ten words: three may go. Two begin pairs of c, d and e; of the others, which are equal, the first goes.
    assert set(item) == {0} and set(place) == {1, 4, 5, 6, 7, 8}
    assert len(seeds.tables[3][0]) == 1


def test_very_long_text(spark):
    words = [WORDS[i * 7 % 2000] for i in range(200_000)]
    item = random.Random(3).sample(WORDS, 30)
    words[150_000:150_000] = item
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    (found,) = dc.matches(docs, bench).collect()
    assert tuple(found) == (1, 5, 1.0, 150_000, 150_029)
