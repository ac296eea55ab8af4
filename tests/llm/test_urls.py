from __future__ import annotations

import re

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dailymart.llm import queries, urls

RULES = queries.URL_RULES


def plain(url, rules=RULES, vocabulary=urls.COMMON):
    """One regular expression per term, every rule tried."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split("[/?#]", rest, maxsplit=1)[0])
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    fits = [r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
    hits = {t: len(re.findall(f"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", text)) for t in vocabulary.weights}
    weight = sum(w for t, w in vocabulary.weights.items() if hits[t])
    verdict = rule.verdict if rule else "block" if weight >= vocabulary.reject else "allow"
    return host, path, rule and rule.text, verdict, weight, sum(n > 0 for n in hits.values()), sum(hits.values())


CASES = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "http://Example.ORG/es/x?q#f", "http://example.org/es",
    "http://a.example.org/en/12", "http://notexample.org/en/1", "http://x.com/fr/", "http://x.com/DE/", "http://x.com/de/",
    "https://casino.net/", "https://casinos.net/", "http://free-bets.net", "http://free.net/free", "http://xn.net/ads?track",
    "http://org:80/", "http://u@org/", "http://a.b/c://d", "http://é.net/xxxé", "http://xxx0.net/", "HTTP://XXX.NET", "a://b?c/d",
    "a://b#c/d?", "x" * 100_000 + "/porn", "http://.org/", "http://a..org/", "http://org./",
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")


def test_cases_equal_the_plain_form(spark):
    rows = [(i, u, "other", 7) for i, u in enumerate(CASES)] + [(None, "http://org/", None, None)] * 2
    got = urls.verdicts(frame(spark, rows).repartition(3), RULES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *plain(u)) for i, u, _, _ in rows), key=str)
    assert urls.verdicts(frame(spark, []), RULES).collect() == []


def test_verdicts_by_name():
    by = {u: plain(u)[2:4] for u in CASES}
    judge = urls.Filter(urls.COMMON, RULES)
    assert by["http://a.example.org/en/12"] == ("example.org/en/1", "block")
    assert by["http://notexample.org/en/1"] == ("org/", "allow")
    assert by["http://org"] == (None, "allow")
    assert judge.rule("example.org", "/es").text == "org/"
    assert by["https://casino.net/"] == (None, "block") and by["https://casinos.net/"] == (None, "allow")
    assert by["http://free-bets.net"] == (None, "block") and by["http://free.net/free"] == (None, "allow")


@settings(max_examples=300, deadline=None)
@given(st.text("aA.:/?#-bé \n", max_size=20))
def test_any_url(url):
    rules = [urls.Rule("a/", "allow"), urls.Rule("b.a/", "block"), urls.Rule("a/bb", "block"), urls.Rule("a.b/a", "allow")]
    vocabulary = urls.Vocabulary.of(["ab", "a-a"], ["a", "b", "bb"])
    judge = urls.Filter(vocabulary, rules)
    host, path = urls.host_and_path(url)
    rule, terms = judge.rule(host, path), judge.terms(url)
    weight = sum(vocabulary.weights[t] for t in terms)
    got = host, path, rule and rule.text, rule.verdict if rule else "block" if weight >= 2 else "allow"
    assert (*got, weight, len(terms), sum(terms.values())) == plain(url, rules, vocabulary)


def test_sql_gives_the_same():
    rows = [(i, u) for i, u in enumerate(CASES)]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url"]))
    got = con.execute(urls.sql(RULES)).fetchall()
    assert sorted(got) == sorted((i, *plain(u)) for i, u in rows)


def test_limits_and_mistakes():
    with pytest.raises(ValueError):
        urls.Filter(urls.Vocabulary({str(i): 1 for i in range(urls.MOST_ENTRIES + 1)}), [])
    with pytest.raises(ValueError):
        urls.Filter(urls.COMMON, [urls.Rule("org", "allow")])
    assert urls.Filter(urls.Vocabulary({}), []).terms("xxx") == {}


def test_every_row_is_judged_where_it_is_read(spark, plan_of):
    text = plan_of(queries.op11_urls(spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in text and "html" not in text.split("ReadSchema")[1].splitlines()[0]
