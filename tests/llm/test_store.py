from __future__ import annotations

from pathlib import Path

from dailymart.llm import store


def test_stored_tables_can_be_deleted(spark):
    folder = Path(store.shared_folder(spark))
    store.clear(spark)
    kept = store.saved(spark.range(5), "a")
    store.saved(spark.range(3), "b")
    assert kept.count() == 5 and len(list(folder.glob("llm-[ab]-*"))) == 2
    assert store.clear(spark) == 2 and not list(folder.glob("llm-[ab]-*"))
    assert store.clear(spark) == 0
