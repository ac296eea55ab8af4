from dailymart.quality.catalog import CATALOG
from dailymart.quality.checks import Check, QualityError, failing_rows, require_passed, row_measures, run_checks, store_failures
from dailymart.quality.presence import key_presence

__all__ = [
    "CATALOG",
    "Check",
    "QualityError",
    "failing_rows",
    "key_presence",
    "require_passed",
    "row_measures",
    "run_checks",
    "store_failures",
]
