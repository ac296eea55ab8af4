"""Rows per key and source, from which uniqueness and references of single keys are read together.

Columns that refer to each other hold keys of one domain (all listing ids, say). Each model is scanned once and
gives its keys of all domains; one aggregate counts them per domain, key and source, after a partial count in every
map task, so a key in very many rows sends one row per task and source.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A model and one of its columns.
Source = tuple[str, str]


def key_domains(links: Iterable[Sequence[Source]]) -> list[list[Source]]:
    """Sources by domain: those of one link share one, directly or through others."""
    found: list[list[Source]] = []
    for link in links:
        met = [d for d in found if any(s in d for s in link)]
        merged = list(dict.fromkeys([s for d in met for s in d] + list(link)))
        found = [d for d in found if d not in met] + [merged]
    return found


def key_type(models: Mapping[str, DataFrame], domain: Iterable[Source]) -> str | None:
    """The type that holds all keys of a domain without changing one; None if there is none."""
    kinds = [models[model].schema[column].dataType for model, column in domain]
    for wide in (T.IntegralType, T.StringType):
        if all(isinstance(k, wide) for k in kinds):
            return "bigint" if wide is T.IntegralType else "string"
    return None


def key_counts(models: Mapping[str, DataFrame], domains: Sequence[Sequence[Source]], kind: str = "bigint") -> DataFrame:
    """``domain, key, n_0, n_1, ...``: rows of each key in the domain's first source, second source and so on.

    ``domain`` is the place in ``domains``. NULL keys are left out.
    """
    by_model: dict[str, list[str]] = {}
    for d, domain in enumerate(domains):
        for place, (model, column) in enumerate(domain):
            by_model.setdefault(model, []).append(f"struct({d} AS domain, {place} AS place, CAST(`{column}` AS {kind}) AS key)")
    keys = [models[m].selectExpr(f"inline(array({', '.join(found)}))").where("key IS NOT NULL") for m, found in by_model.items()]
    counts = [F.count_if(F.col("place") == i).alias(f"n_{i}") for i in range(max(map(len, domains)))]
    return reduce(DataFrame.union, keys).groupBy("domain", "key").agg(*counts)


def key_presence(models: Mapping[str, DataFrame], sources: Mapping[str, Source]) -> DataFrame:
    """One row per key with its number of rows in each of the named ``sources``, which share one domain."""
    kind = key_type(models, sources.values())
    if kind is None:
        raise TypeError(f"keys of different types: {sources}")
    counted = key_counts(models, [list(sources.values())], kind)
    return counted.select("key", *[F.col(f"n_{i}").alias(name) for i, name in enumerate(sources)])
