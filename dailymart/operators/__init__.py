from dailymart.operators.latest import latest_per_key
from dailymart.operators.references import orphan_keys, orphans
from dailymart.operators.shares import prev_by, share_of_total, top_k
from dailymart.operators.skew import Hot, HotKeys, hot_keys, salted_join

__all__ = [
    "Hot",
    "HotKeys",
    "hot_keys",
    "latest_per_key",
    "orphan_keys",
    "orphans",
    "prev_by",
    "salted_join",
    "share_of_total",
    "top_k",
]
