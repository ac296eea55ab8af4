"""Data-quality checks: failing rows per check, and the status of many checks in few passes.

Failures are counted the way test runners for SQL models count them: rows for not_null, expression, range
and reference checks, duplicated values for uniqueness, distinct bad values for accepted values, and
dates for the future-date check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.operators import orphan_keys
from dailymart.quality.presence import Source, key_counts, key_domains, key_type
from dailymart.sinks.lake import Lake

ROW_KINDS = ("not_null", "expression", "range")

#: Failing rows counted while a model was written, by the condition of such a row.
Measured = Callable[[str], Mapping[str, int]]


@dataclass(frozen=True)
class Check:
    """One declared check on one model.

    ``columns`` are the checked column or key; ``where`` limits the rows, ``expression`` must be true (a NULL
    result does not fail), ``values`` are the accepted ones, ``parent`` is (model, key). More than
    ``warn_above`` failures warn; more than ``error_above`` fail, unless it is None.
    """

    model: str
    kind: str
    columns: tuple[str, ...] = ()
    where: str | None = None
    expression: str | None = None
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    warn_above: int = 0
    error_above: int | None = 0
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or "_".join([self.kind, self.model, *self.columns])

    @property
    def severity(self) -> str:
        return "error" if self.error_above == 0 else "warn"


class QualityError(Exception):
    """Raised when a check of error severity fails."""


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _violation(check: Check) -> str:
    """Condition of a failing row, as SQL, for checks that look at one row at a time."""
    if check.kind == "not_null":
        bad = f"`{check.columns[0]}` IS NULL"
    elif check.kind == "accepted_values":
        bad = f"`{check.columns[0]}` NOT IN ({', '.join(map(_text, check.values))})"
    else:
        bad = f"NOT ({check.expression})"
    return bad if check.where is None else f"({check.where}) AND {bad}"


def row_measures(checks: Iterable[Check], model: str) -> dict[str, Column]:
    """Counts of failing rows of a model, by the condition of such a row, to be taken along when the model is written."""
    own = [c for c in checks if c.model == model and c.kind in (*ROW_KINDS, "accepted_values")]
    return {bad: F.expr(f"count_if({bad})") for bad in map(_violation, own)}


def _measured_rows(spark: SparkSession, known: Mapping[str, int]) -> DataFrame:
    """(check_name, n_failures) without a scan: ``known`` are failures by check."""
    rows = (f"struct({_text(name)} AS check_name, bigint({n}) AS n_failures)" for name, n in known.items())
    return spark.range(1).selectExpr(_inline(rows))


def _today(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def failing_rows(check: Check, models: Mapping[str, DataFrame], as_of: date | None = None) -> DataFrame:
    """The rows a check objects to; none when it passes."""
    df = models[check.model]
    if check.kind in ROW_KINDS:
        return df.where(_violation(check))
    if check.kind == "unique":
        keyed = reduce(lambda d, c: d.where(F.col(c).isNotNull()), check.columns, df)
        return keyed.groupBy(*check.columns).agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)
    if check.kind == "accepted_values":
        bad = df.where(_violation(check))
        return bad.groupBy(F.col(check.columns[0]).alias("value_field")).agg(F.count("*").alias("n_records"))
    if check.kind == "relationships":
        parent, key = check.parent
        return orphan_keys(df, check.columns[0], models[parent], key)
    if check.kind == "no_future_dates":
        (column,) = check.columns
        later = df.where(F.col(column) > _today(as_of))
        return later.groupBy(column).agg(F.count("*").alias("record_count")).where(F.col("record_count") > 0)
    raise ValueError(check.kind)


def _inline(structs: Iterable[str]) -> str:
    return f"inline(array({', '.join(structs)}))"


def _counted_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, n_failures) of all row checks of a model, from one aggregate pass."""
    once = df.selectExpr(*[f"count_if({_violation(c)}) AS c{i}" for i, c in enumerate(checks)])
    return once.selectExpr(
        _inline(f"struct({_text(c.name)} AS check_name, c{i} AS n_failures)" for i, c in enumerate(checks))
    )


def _counted_values(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, n_failures) of all accepted-value checks of a model, from one pass.

    Only bad values reach the shuffle, which is none in a healthy table. A clean check has no row here.
    """
    pairs = [
        f"struct({_text(c.name)} AS check_name, CASE WHEN {_violation(c)} THEN `{c.columns[0]}` END AS value)"
        for c in checks
    ]
    bad = df.selectExpr(_inline(pairs)).where("value IS NOT NULL").distinct()
    return bad.groupBy("check_name").agg(F.count("*").alias("n_failures"))


def _counted_failures(check: Check, models: Mapping[str, DataFrame], as_of: date | None) -> DataFrame:
    rows = failing_rows(check, models, as_of)
    failures = F.sum("n_rows") if check.kind == "relationships" else F.count("*")
    counted = rows.agg(F.coalesce(failures, F.lit(0).cast("bigint")).alias("n_failures"))
    return counted.select(F.lit(check.name).alias("check_name"), "n_failures")


def _sources(check: Check) -> list[Source]:
    """The checked column and, for references, the parent's key."""
    child = (check.model, check.columns[0])
    return [child] if check.parent is None else [child, check.parent]


def _counted_keys(models: Mapping[str, DataFrame], checks: list[Check]) -> tuple[list[DataFrame], list[Check]]:
    """(check_name, n_failures) of uniqueness and reference checks on single keys, from one aggregate per type of key.

    Second come the checks this cannot answer: of composite keys and of domains with keys of different types.
    """
    single = [c for c in checks if c.kind == "relationships" or (c.kind == "unique" and len(c.columns) == 1)]
    by_type: dict[str | None, list[list[Source]]] = {}
    for domain in key_domains(map(_sources, single)):
        by_type.setdefault(key_type(models, domain), []).append(domain)
    counted, answered = [], []
    for kind, domains in by_type.items():
        if kind is None:
            continue
        place = {source: (d, i) for d, domain in enumerate(domains) for i, source in enumerate(domain)}
        group = [c for c in single if _sources(c)[0] in place]
        failures = []
        for check in group:
            child, *parent = [place[s] for s in _sources(check)]
            if parent:
                # Of a column that refers to itself every key is present.
                n = f"coalesce(sum(CASE WHEN domain = {child[0]} AND n_{parent[0][1]} = 0 THEN n_{child[1]} END), 0)"
            else:
                n = f"count_if(domain = {child[0]} AND n_{child[1]} > 1)"
            failures.append(n)
        once = key_counts(models, domains, kind).selectExpr(*[f"{n} AS c{i}" for i, n in enumerate(failures)])
        counted.append(
            once.selectExpr(_inline(f"struct({_text(c.name)} AS check_name, c{i} AS n_failures)" for i, c in enumerate(group)))
        )
        answered += group
    return counted, [c for c in checks if c not in answered]


def _status(n: Column) -> Column:
    failed = F.col("error_above").isNotNull() & (n > F.col("error_above"))
    return F.when(failed, "error").when(n > F.col("warn_above"), "warn").otherwise("pass")


def _declared(check: Check) -> str:
    limit = "NULL" if check.error_above is None else str(check.error_above)
    return (
        f"struct({_text(check.name)} AS check_name, {_text(check.model)} AS model, {_text(check.kind)} AS kind, "
        f"{_text(check.severity)} AS severity, bigint({check.warn_above}) AS warn_above, "
        f"bigint({limit}) AS error_above)"
    )


def run_checks(
    models: Mapping[str, DataFrame],
    checks: Iterable[Check],
    as_of: date | None = None,
    measured: Measured | None = None,
) -> DataFrame:
    """One row per check: check_name, model, kind, severity, n_failures, status.

    Row checks of a model share one aggregate, accepted-value checks another; uniqueness and references of
    single keys share one over all models, composite keys take one each. The result is a single lazy DataFrame.

    ``measured(model)`` gives what :func:`row_measures` counted when the model was written: those row checks are
    not counted again, and accepted values are only looked up where a row fails.
    """
    checks = list(checks)
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)

    keyed = [c for c in checks if c.kind not in (*ROW_KINDS, "accepted_values")]
    counted, one_by_one = _counted_keys(models, keyed)
    counted += [_counted_failures(c, models, as_of) for c in one_by_one]
    known: dict[str, int] = {}
    for model, group in by_model.items():
        rows = [c for c in group if c.kind in ROW_KINDS]
        values = [c for c in group if c.kind == "accepted_values"]
        if measured is not None and (rows or values):
            failing = measured(model)
            known |= {c.name: failing[_violation(c)] for c in rows if _violation(c) in failing}
            known |= {c.name: 0 for c in values if failing.get(_violation(c)) == 0}
            rows, values = ([c for c in part if c.name not in known] for part in (rows, values))
        if rows:
            counted.append(_counted_rows(models[model], rows))
        if values:
            counted.append(_counted_values(models[model], values))

    session = models[checks[0].model].sparkSession
    if known:
        counted.append(_measured_rows(session, known))

    declared = session.range(1).selectExpr(_inline(map(_declared, checks)))
    results = reduce(DataFrame.unionByName, counted)
    joined = declared.join(results, "check_name", "left").withColumn(
        "n_failures", F.coalesce("n_failures", F.lit(0).cast("bigint"))
    )
    return joined.select(
        "check_name", "model", "kind", "severity", "n_failures", _status(F.col("n_failures")).alias("status")
    )


def store_failures(
    lake: Lake, models: Mapping[str, DataFrame], checks: Iterable[Check], as_of: date | None = None
) -> dict[str, int]:
    """Write the failing rows of each check to ``test_results/<check>``; rows written per check."""
    return {c.name: lake.replace(failing_rows(c, models, as_of), "test_results", c.name) for c in checks}


def require_passed(results: DataFrame) -> None:
    """Raise when any check of the result has status 'error' (reads one row per failed check)."""
    failed = results.where(F.col("status") == "error").select("check_name", "n_failures").collect()
    if failed:
        raise QualityError("; ".join(f"{r.check_name}: {r.n_failures}" for r in sorted(failed)))
