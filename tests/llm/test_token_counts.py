from __future__ import annotations

import random
from fractions import Fraction

import public_tokenizers
import pytest
import tiktoken  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dailymart.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute(text, spans, rule):
    """Tokens of each span of characters, token by token."""
    own = tc.encoder(PATH, public_tokenizers.PATTERN)
    tokens = own.encoding.encode_ordinary(text)
    data, at = text.encode(), 0
    owner = [None] * len(data)
    where, char = 0, 0
    starts = []
    for c in text:
        starts.append(where)
        where += len(c.encode())
    starts.append(len(data))
    for k, (a, b) in enumerate(spans):
        for i in range(starts[a], starts[b]):
            owner[i] = k
    counts, crossing, outside = [Fraction(0)] * len(spans), [0] * len(spans), 0
    for t in tokens:
        size = len(own.encoding.decode_single_token_bytes(t))
        own_bytes = owner[at : at + size]
        at += size
        met = [k for k in dict.fromkeys(own_bytes) if k is not None]
        outside += not met
        for k in met:
            crossing[k] += own_bytes.count(k) < size
        if rule == "shares":
            for k in met:
                counts[k] += Fraction(own_bytes.count(k), size)
        elif rule == "first":
            if own_bytes[0] is not None:
                counts[own_bytes[0]] += 1
        elif met:
            counts[max(met, key=lambda k: (own_bytes.count(k), -k))] += 1
    return [(float(c), x) for c, x in zip(counts, crossing)], outside, len(tokens)


def lines(text):
    spans, at = [], 0
    for part in text.splitlines(keepends=True) if text else []:
        spans.append((at, at + len(part)))
        at += len(part)
    return spans or [(0, 0)]


@pytest.mark.parametrize("rule", tc.RULES)
def test_lines_equal_token_by_token_counts(spark, rule):
    rng = random.Random(4)
    texts = ["", "\n", "a\n", "\n\n\n", "ein Wort", "x\n\n  \n\ty", "é\nü\n\n日本語の\n文", "end.  \n\n    indent\n"]
    texts += ["".join(rng.choices(["the ", "Straße", "\n", "  ", "!?", "日", "\n\n", "🙂"], k=rng.randint(1, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("section", F.lit("x"))
    got = tc.section_tokens(docs, PATH, public_tokenizers.PATTERN, rule).orderBy("doc_id", "section").collect()
    for i, text in enumerate(texts):
        own = [r for r in got if r.doc_id == i]
        want, outside, total = brute(text, lines(text), rule)
        assert [(r.first_char, r.last_char) for r in own] == lines(text)
        assert [(pytest.approx(r.n_tokens), r.n_crossing) for r in own] == want
        assert {(r.document_tokens, r.outside) for r in own} == {(total, outside)}
        assert sum(r.n_tokens for r in own) == pytest.approx(total)


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("ab é日\n.🙂"), max_size=40), st.lists(st.integers(0, 40), max_size=8), st.sampled_from(tc.RULES))
def test_spans_with_gaps(text, cuts, rule):
    import numpy as np

    cuts = sorted({min(c, len(text)) for c in cuts})
    spans = [s for k, s in enumerate(zip(cuts, cuts[1:])) if k % 3 != 1]
    want, outside, _ = brute(text, spans, rule)
    starts = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]).astype(int)
    places = starts[np.array(spans, int).reshape(-1, 2)]
    ends = tc.encoder(PATH, public_tokenizers.PATTERN).token_ends(text)
    counts, crossing = tc.attribute(ends, places, rule)
    assert [(pytest.approx(c), x) for c, x in zip(counts, crossing)] == want
    assert tc._outside(ends, places) == outside


def test_given_spans_nulls_long_texts_and_empty_tables(spark):
    spans = "array<struct<begin:long,end:long>>"
    rows = [(1, "Title here\nbody text", [(0, 5), (11, 99)]), (None, None, [(0, 3)]), (2, "plain\nlines", None), (2, "again", [])]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, spans {spans}")
    got = [(r.doc_id, r.section, r.first_char, r.last_char) for r in tc.section_tokens(docs, PATH, public_tokenizers.PATTERN, spans="spans").collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 0, 5), (1, 1, 11, 20), (None, 0, 0, 0), (2, 0, 0, 6), (2, 1, 6, 11)], key=str)
    long_ = spark.createDataFrame([(7, "x" * 200_000 + "\n" + "word " * 50_000), (8, None)], "doc_id long, text string")
    found = tc.section_tokens(long_, PATH, public_tokenizers.PATTERN).orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.first_char, r.last_char) for r in found] == [(7, 0, 200_001), (7, 200_001, 450_001), (8, 0, 0)]
    assert found[2].n_tokens == 0 and found[0].n_tokens + found[1].n_tokens == found[0].document_tokens
    assert tc.section_tokens(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
    # A column that happens to be called spans is no matter.
    other = docs.withColumn("spans", F.lit("x")).where("doc_id = 1")
    assert tc.section_tokens(other, PATH, public_tokenizers.PATTERN).count() == 2
    with pytest.raises(ValueError):
        tc.section_tokens(docs, PATH, public_tokenizers.PATTERN, "any")
