from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pandas as pd
import pytest

from dailymart.llm import conversations

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def fix(rows):
    """Cheapest (cost, audit, repaired turns) of rows with faults, by trying every edit in every place."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def rest(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def go(cost, letter, j, now, turn, inserts=0):
            if found := rest(j, now, inserts):
                ways.append((cost + found[0], letter + found[1], turn + found[2]))

        following = follow[last][-1]
        if i < len(rows):
            role, text, fault = rows[i]
            go(2, "D", i + 1, last, ())
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role and role[0] in follow[last]:
                    go(more, "K", i + 1, role[0], (f"{role}:{text}",))
                go(1 + more, "R", i + 1, following, (f"{names[following]}:{text}",))
        if inserts < 3:
            go(5, "I", i, following, (f"{names[following]}:",), inserts + 1)
        return min(ways) if ways else None

    return rest(0, "", 0)


def brute(rows):
    """The contract, conversation by conversation, on rows in the order of turns and digests."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damage(rows) if r[0] == conv]
        digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        seen, judged = set(), []
        for _, role, text in own:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        count = [sum(j[2] == f for j in judged) for f in ("blank", "duplicate", "truncated")]
        cost, audit, turns = fix(tuple(judged))
        text = "\n".join(turns)
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), text)
    return out


def made(seed, convs=40, most=7):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Well ?\n", " \t", "", None, "Why!", "and so", "Ünd…", "a:b.", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(most)):
            rows.append((conv, rng.choice([None, turn, turn, turn, turn + 7, turn]), rng.choice(roles), rng.choice(texts)))
        if rng.random() < 0.3 and rows and rows[-1][0] == conv:
            rows += [rows[-1]] * rng.randrange(3)
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, digest int, copies string, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


def result(spark, rows):
    every = frame(spark, rows)
    got = conversations.repaired(every, conversations.damaged(conversations.turns(every))).collect()
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256 repaired".split()
    assert len(got) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r[n] for n in names) for r in got}


@pytest.mark.parametrize("segment", [512, 2, 1])
def test_equals_trying_every_edit(spark, monkeypatch, segment):
    """Segments of one or two rows take the way of the very long conversations."""
    rows = made(segment)
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    assert result(spark, rows) == brute(rows)


def random_rows(rng, n):
    return tuple((rng.randrange(4), rng.choice([0, 0, 0, 1, 2]), rng.choice([0, 0, 0, 1, 3])) for _ in range(n))


def from_the_end(rows, entry, ends, insert_last):
    """Least (cost, audit) by rows from the last to the first, two inserts at most in a place."""
    best = {e: (0, "") for e in ends}
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            ways = {s: [(c + best[t][0], a + best[t][1]) for c, a, t in conversations._edges(rows[i], s) if t in best] for s in range(4)}
            best = {s: min(w) for s, w in ways.items() if w}
        if i < len(rows) or insert_last:
            for _ in range(3):
                more = {s: (5 + best[t][0], "I" + best[t][1]) for s, t in enumerate(conversations.AFTER) if t in best}
                best = {s: min(x for x in (best.get(s), more.get(s)) if x) for s in {*best, *more}}
    return best.get(entry)


def test_two_searches_meet_at_the_least_audit():
    rng = random.Random(1)
    for _ in range(3000):
        rows = random_rows(rng, rng.randrange(1, 9))
        entry, end, last = rng.randrange(4), tuple(rng.sample(range(4), rng.randrange(1, 3))), rng.random() < 0.5
        assert conversations.search(rows, entry, end, last) == from_the_end(rows, entry, end, last)


def test_segments_give_the_whole():
    """States chosen from costs and places alone lead to the audit of one search over all rows."""
    rng = random.Random(2)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(2, 30))
        cuts = sorted({0, len(rows), *(rng.randrange(1, len(rows)) for _ in range(3))})
        parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        names = ["conv_id", "part", "seq", "last_row", "first_initial", "summary"]
        import pyarrow as pa

        listed = [(5, 0, k, p[-1][0], p[0][0], conversations.summary(p).tobytes()) for k, p in enumerate(parts)][::-1]
        batch = pa.record_batch([pa.array(list(c)) for c in zip(*listed)], names)
        (states,) = conversations._states(iter([batch]))
        whole, cost = "", 0
        for part, entry, end, closes in zip(parts, *(states.column(c).to_pylist() for c in ("entry", "end", "closes"))):
            step, audit = conversations.between(part, entry, end)
            more = conversations.FINISH[end] if closes else ""
            whole, cost = whole + audit + more, cost + step + 5 * len(more)
        assert (cost, whole) == conversations.solved(rows)
        breaks = sum(states.column("breaks").to_pylist()) + sum(map(conversations.illegal_pairs, parts))
        assert breaks == conversations.illegal_pairs(rows)


def test_sql_gives_the_same():
    rows = made(9, convs=60)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    got = {r[0]: r[1:] for r in con.execute(conversations.sql()).fetchall()}
    assert got == {conv: found[:-1] for conv, found in brute(rows).items()}


def test_one_very_long_conversation(spark):
    """Many rows, most of them copies, in one conversation; every turn is whole."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(4000)] + [(1, 3, "assistant", "Turn 3.")] * 3000
    every = frame(spark, rows).repartition(6)
    (got,) = conversations.repaired(every).collect()
    assert (got.gaps, got.duplicate, got.illegal, got.cost) == (0, 3000, 3000, 6000)
    assert got.audit == "KKKK" + "D" * 3000 + "K" * 3996
    assert got.repaired == "\n".join(f"{r[2]}:{r[3]}" for r in rows[:4000])


def test_empty_table(spark):
    assert conversations.repaired(frame(spark, [])).collect() == []
