"""URL filters: a weighted vocabulary found by an Aho-Corasick automaton, overruled by host and path rules.

Every URL is read once by the automaton over all terms. A hit counts if the characters around it are neither
ASCII letters nor digits. A term's weight counts once per URL, however often it occurs; a URL whose weights reach
``Vocabulary.reject`` is blocked: one strict term has that weight by itself, soft terms need several different ones.
A rule such as ``example.org/es/`` fits a host and its subdomains where the path starts with the rule's; the
longest fitting rule (of equal length, the one with the longer host) gives the verdict whatever the vocabulary says.

Rows are judged one by one where they are read: no shuffle, and columns other than the two needed are not read.
Vocabulary and rules travel with the tasks, at most ``MOST_ENTRIES`` of each.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is allowed unless its text
holds blocked terms. A null page_id stays null, repeated rows are judged each, a URL of any length is read whole.
An empty path fits no rule, as every rule's path starts with a slash. Other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most terms and most rules: both are held by every task.
MOST_ENTRIES = 100_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HOST_END = re.compile("[/?#]")
_PATH_END = re.compile("[?#]")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case with their weights, and the sum at which a URL is rejected."""

    weights: Mapping[str, int]
    reject: int = 2

    @staticmethod
    def of(strict: Sequence[str], soft: Sequence[str], several: int = 2) -> Vocabulary:
        """One strict term rejects, and so do ``several`` different soft ones."""
        return Vocabulary({**dict.fromkeys(soft, 1), **dict.fromkeys(strict, several)}, several)


#: Terms of unwanted sites.
COMMON = Vocabulary.of(
    strict="adult casino escort hentai phishing porn porno viagra warez xxx".split(),
    soft="ads bet bets betting cheap click crack deals farm free jackpot loan loans pills pharmacy poker"
    " replica seo sex spam track tracker tracking win winner".split(),
)


@dataclass(frozen=True)
class Rule:
    """``text`` is ``host/path``; a rule without a path fits every path that starts with a slash."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: str | None) -> tuple[str, str]:
    """What stands between ``://`` and the path, A-Z in lower case, and the path up to ``?`` or ``#``."""
    rest = (url or "").partition("://")[2]
    end = _HOST_END.search(rest)
    if end is None:
        return rest.translate(_LOWER), ""
    path = rest[end.start() :]
    stop = _PATH_END.search(path)
    return rest[: end.start()].translate(_LOWER), path[: stop.start()] if stop else path


class Filter:
    """Vocabulary and rules in the form in which tasks use them."""

    def __init__(self, vocabulary: Vocabulary, rules: Sequence[Rule]):
        if max(len(vocabulary.weights), len(rules)) > MOST_ENTRIES:
            raise ValueError(f"at most {MOST_ENTRIES} terms and rules")
        if "" in vocabulary.weights or any("/" not in r.text for r in rules):
            raise ValueError("terms must not be empty, and rules need a slash behind the host")
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for term in vocabulary.weights:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()
        self.by_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.path), r.path)):
            self.by_host.setdefault(rule.host, []).append(rule)

    def terms(self, url: str) -> dict[str, int]:
        """Terms with how often they stand between boundaries."""
        text = url.translate(_LOWER)
        found: dict[str, int] = {}
        if not self.vocabulary.weights:
            return found
        for last, term in self.automaton.iter(text):
            first = last - len(term)
            if (first < 0 or text[first] not in _WORD) and (last + 1 == len(text) or text[last + 1] not in _WORD):
                found[term] = found.get(term, 0) + 1
        return found

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; walks the host's endings at label borders, the whole host first."""
        best, ending = None, host
        while True:
            # The first that fits has the longest path of those for this ending.
            fits = next((r for r in self.by_host.get(ending, ()) if path.startswith(r.path)), None)
            if fits and (best is None or len(fits.text) > len(best.text)):
                best = fits
            if "." not in ending:
                return best
            ending = ending.partition(".")[2]


FIELDS = "page_id long, host string, path string, rule string, verdict string, weight int, n_terms int, n_hits int"


def _judged(judge: Filter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
    names = ["host", "path", "rule", "verdict", "weight", "n_terms", "n_hits"]
    for batch in batches:
        rows = []
        for url in batch.column("url").to_pylist():
            host, path = host_and_path(url)
            terms = judge.terms(url or "")
            weight = sum(judge.vocabulary.weights[t] for t in terms)
            rule = judge.rule(host, path)
            verdict = rule.verdict if rule else "block" if weight >= judge.vocabulary.reject else "allow"
            rows.append((host, path, rule and rule.text, verdict, weight, len(terms), sum(terms.values())))
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.record_batch(
            [batch.column("page_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], ["page_id", *names]
        )


def verdicts(pages: DataFrame, rules: Sequence[Rule] = (), vocabulary: Vocabulary = COMMON) -> DataFrame:
    """``page_id, host, path, rule, verdict, weight, n_terms, n_hits`` for every row; see the module's text.

    ``weight`` adds up the different terms found, ``n_terms`` counts them and ``n_hits`` their occurrences.
    """
    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return wanted.mapInArrow(partial(_judged, Filter(vocabulary, rules)), FIELDS)


def sql(rules: Sequence[Rule], vocabulary: Vocabulary = COMMON) -> str:
    """The same for DuckDB, over ``pages`` (at least one rule and one term)."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rule_rows = ", ".join(f"({quoted(r.text)}, {quoted(r.host)}, {quoted(r.path)}, {quoted(r.verdict)})" for r in rules)
    # Boundaries are doubled, so that two hits may share one.
    term_rows = ", ".join(
        f"({quoted(t)}, {quoted('[^a-z0-9]' + re.sub('([^a-z0-9])', lambda m: re.escape(m[1]) * 2, t) + '[^a-z0-9]')}, {w})"
        for t, w in vocabulary.weights.items()
    )
    return f"""
WITH given AS (SELECT row_number() OVER () AS row_id, page_id, coalesce(url, '') AS url FROM pages),
rests AS (
  SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM given
),
parts AS (
  SELECT row_id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
    regexp_extract(regexp_extract(rest, '[/?#](.|\\n)*'), '^[^?#]*') AS path,
    ' ' || regexp_replace(translate(url, '{upper}', '{lower}'), '([^a-z0-9])', '\\1\\1', 'g') || ' ' AS spaced
  FROM rests
),
rules(text, host, path, verdict) AS (VALUES {rule_rows}),
terms(term, pattern, weight) AS (VALUES {term_rows}),
ruled AS (
  SELECT p.row_id, max_by(struct_pack(t := r.text, v := r.verdict), (length(r.text), length(r.host))) AS best
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.row_id
),
hits AS (
  SELECT p.row_id, t.weight, len(regexp_extract_all(p.spaced, t.pattern)) AS n
  FROM parts p JOIN terms t ON regexp_matches(p.spaced, t.pattern)
),
counted AS (SELECT row_id, sum(weight) AS weight, count(*) AS n_terms, sum(n) AS n_hits FROM hits GROUP BY row_id)
SELECT page_id, host, path, best.t AS rule,
  coalesce(best.v, CASE WHEN weight >= {vocabulary.reject} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(coalesce(weight, 0) AS INTEGER) AS weight, CAST(coalesce(n_terms, 0) AS INTEGER) AS n_terms,
  CAST(coalesce(n_hits, 0) AS INTEGER) AS n_hits
FROM parts LEFT JOIN ruled USING (row_id) LEFT JOIN counted USING (row_id)
"""
