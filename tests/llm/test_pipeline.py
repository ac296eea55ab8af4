"""The pipeline stage by stage against brute force, the registered queries, and the package's removal."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import pytest
from compare import compare, connect
from conftest import SMALL
from test_hyperminhash import brute as near_groups
from test_suffixes import brute as repeats
from tokenizers import Tokenizer

import __spark_entry__ as entry
from dailymart.llm import quality, queries
from dailymart.llm.store import saved

ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """Name, rows before and rows after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, docs, SMALL), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order_keep_the_columns_of_documents(spark, stages):
    assert [name for name, _, _ in stages] == ["quality", "near_dedup", "repeat_removal", "decontamination", "packing"]
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, _, after in stages[:-1]:
        assert after.dtypes == documents.dtypes
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_is_not_rejected(spark, stages):
    _, before, after = stages[0]
    kept, marks = rows(after), {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert set(kept) == {r.doc_id for r in quality.scores(before, spark.read.parquet(f"{SMALL}/labels.parquet")).collect() if r.predicted}
    good = [i for i, q in marks.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, q in marks.items() if q == 0) <= 0.2 * len(marks)


def test_near_dedup_keeps_the_first_of_each_group(stages):
    _, before, after = stages[1]
    groups = near_groups([(i, r.text) for i, r in rows(before).items()], 5, 80)
    assert set(rows(after)) == {c for _, c in groups.values()}


def test_repeats_are_cut_and_all_documents_stay(stages):
    _, before, after = stages[2]
    old, new = rows(before), rows(after)
    ids = sorted(old)
    assert ids == sorted(new)
    for i, (size, removed, _, _) in zip(ids, repeats([old[i].text for i in ids])):
        # A character whose bytes repeat in part only stays.
        left = len((new[i].text or "").encode())
        assert size - removed <= left <= size - removed + 6 * (removed > 0)
        assert new[i].n_chars == len(new[i].text or "")
        if not removed:
            assert new[i].text == old[i].text


def test_documents_with_test_items_go(spark, stages):
    _, before, after = stages[3]
    plain = lambda text: " ".join(re.findall(r"\w+", (text or "").lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    old, new = rows(before), rows(after)
    leaked = {i for i, r in old.items() if any(f" {t} " in f" {plain(r.text)} " for t in items)}
    assert leaked and not leaked & set(new)
    assert all(new[i] == old[i] for i in new)
    # What goes shares many words in a row with an item.
    seeds = {tuple(t.split()[k : k + 4]) for t in items for k in range(len(t.split()) - 3)}
    for i in set(old) - set(new):
        words = plain(old[i].text).split()
        assert seeds & {tuple(words[k : k + 4]) for k in range(len(words) - 3)}


def test_packing_takes_all_that_is_left(stages):
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in rows(before).items()}
    found, used = {}, {}
    for r in after.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert found == lengths
    assert len(used) <= -(-sum(lengths.values()) // 4096) + 1
    assert all(sum(n for _, n in own) <= 4096 for own in used.values())


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_queries_match_their_sql(spark, name):
    assert compare(spark, connect(SMALL), queries.all_queries()[name], queries.all_sql()[name], SMALL) is None


def test_all_are_registered():
    names = list(queries.all_queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert {*names, "pipeline"} <= set(entry.queries())
    assert set(queries.all_sql()) <= set(entry.oracle_sql())


def test_the_rest_works_without_this_package(tmp_path):
    """What is left when the folders and the pipeline are taken out still imports and registers its queries."""
    for item in ("__spark_entry__.py", "dailymart"):
        (tmp_path / item).symlink_to(ROOT / item)
    code = (
        "import sys; sys.modules['dailymart.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q))"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    count, pipeline, numbered = run.stdout.split()
    assert int(count) > 70 and pipeline == numbered == "False"
