"""Conversation repair: the cheapest edits, by bidirectional Dijkstra over the edit lattice.

A repaired conversation is empty, or an optional system turn before one or more pairs of user and assistant. A node of
the lattice is (rows consumed, what has been written so far); edges keep, rerole or delete the next row, or insert an
empty turn before it. A search from either end advances over a heap of (cost, rows, audit); where they meet, all
crossings of the least cost are finished and the one with the least audit (the edits' initials) is taken.

How it stays bounded, whatever the size of a conversation: texts are not needed for the search, so only a digest, the
turn and a class (initial of the role, fault) of each different row go through it, counted before any shuffle. Those rows
are ranged by conversation, turn and digest; a task cuts its rows into segments of at most ``SEGMENT`` rows. A
conversation within one task and segment is solved at once. Of the segments of others, the least cost and the order of the
audits are found for every pair of states they may start and end in; one pass over these few numbers picks the states, and
the segments are then solved between them, each on its own. Texts are shuffled once, to put the repaired rows of a conversation
in order for its hash, which is taken as a stream.

Why that is exact: inserts come before the row that follows them, so within a segment all audits have as many letters
that are no insert and end in one. None is the beginning of another; comparing segment by segment is comparing whole audits.

Defined cases: null conv_ids are one conversation, null turns come first, a null role or text is one space, an empty role has no
initial and is never kept. Rows with
equal turns go by the SHA-256 of role and text, so equal rows stand together. Repeated rows are duplicates like others.
A conversation whose rows are all dropped has zeros, an empty audit and the hash of the empty string. Long texts are
hashed whole. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import saved

#: Most different rows in one search.
SEGMENT = 512

#: White space, ends of a sentence, costs of edits.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5

#: What has been written: nothing, a system turn, up to a user turn, up to an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state after a user or assistant turn, whichever may come next.
AFTER = (USER, USER, ASSISTANT, USER)
#: States after a kept row by its initial: s, u, a, others.
KEPT = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: Inserts that complete a conversation.
FINISH = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: Faults of a row, kept in its class beside the initial.
FINE, CUT_OFF, MUST_GO = range(3)

Row = tuple[int, int, int]  # initial, fault, copies that must go


def _edges(row: Row, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, state after) of each way past ``row``."""
    initial, fault, more = row
    gone = DELETE * more
    yield DELETE + gone, "D", state
    if fault != MUST_GO:
        left = gone + (UNFINISHED if fault == CUT_OFF else 0)
        if state in KEPT[initial]:
            yield left, "K", KEPT[initial][state]
        yield REROLE + left, "R", AFTER[state]


def search(rows: tuple[Row, ...], entry: int, ends: tuple[int, ...], insert_last: bool) -> tuple[int, str] | None:
    """Least cost and, of that cost, least audit from ``entry`` to one of ``ends``; None if none is reached.

    ``insert_last``: turns may be inserted behind the last row too.
    """
    n = len(rows)

    def forth(i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        if i < n:
            for cost, letter, to in _edges(rows[i], state):
                yield cost, letter, i + 1, to
        if i < n or insert_last:
            yield INSERT, "I", i, AFTER[state]

    def back(i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        for before in range(STATES):
            if i:
                for cost, letter, to in _edges(rows[i - 1], before):
                    if to == state:
                        yield cost, letter, i - 1, before
            if (i < n or insert_last) and AFTER[before] == state:
                yield INSERT, "I", i, before

    # By cost, then by rows passed: a row kept costs nothing, so of equal costs the nearer node is ready first.
    heaps: list[list] = [[(0, 0, "", 0, entry)], [(0, 0, "", n, e) for e in sorted(ends)]]
    least: list[dict] = [{(0, entry): 0}, {(n, e): 0 for e in ends}]
    ready: list[dict] = [{}, {}]
    best = min((0 for e in ends if (n, e) == (0, entry)), default=math.inf)

    def advance(side: int) -> None:
        nonlocal best
        cost, passed, audit, i, state = heappop(heaps[side])
        if (i, state) in ready[side]:
            return
        ready[side][i, state] = audit
        for step, letter, j, to in (back if side else forth)(i, state):
            total = cost + step
            if (j, to) in ready[side] or total > least[side].get((j, to), math.inf):
                continue
            least[side][j, to] = total
            best = min(best, total + least[1 - side].get((j, to), math.inf))
            text = letter + audit if side else audit + letter
            heappush(heaps[side], (total, n - j if side else j, text, j, to))

    advance(0)
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else math.inf for h in heaps]
        if sum(tops) > best:
            break
        advance(int(tops[1] <= tops[0]))
    if best == math.inf:
        return None
    # Any cheapest way leaves the nodes of the first search by one edge, or ends in them, at a node of the other.
    found = []
    for (i, state), audit in ready[0].items():
        cost = least[0][i, state]
        if (i, state) in ready[1] and cost + least[1][i, state] == best:
            found.append(audit + ready[1][i, state])
        for step, letter, j, to in forth(i, state):
            if (j, to) in ready[1] and cost + step + least[1][j, to] == best:
                found.append(audit + letter + ready[1][j, to])
    return int(best), min(found)


@lru_cache(4096)
def solved(rows: tuple[Row, ...]) -> tuple[int, str]:
    """The repair of a whole conversation."""
    return search(rows, NOTHING, (NOTHING, ASSISTANT), True)


@lru_cache(256)
def between(rows: tuple[Row, ...], entry: int, end: int) -> tuple[int, str] | None:
    return search(rows, entry, (end,), False)


def summary(rows: tuple[Row, ...]) -> np.ndarray:
    """For each state a segment starts in and ends in: cost (-1: no way) and the place of its audit among those of the start."""
    out = np.full((2, STATES, STATES), -1, "<i8")
    for entry in range(STATES):
        ways = {end: way for end in range(STATES) if (way := between(rows, entry, end))}
        for place, end in enumerate(sorted(ways, key=lambda e: ways[e][1])):
            out[:, entry, end] = ways[end][0], place
    return out


def illegal_pairs(rows: tuple[Row, ...], before: int | None = None) -> int:
    """Neighbours whose initials are not su, ua or au; copies of a row are neighbours with equal ones."""
    legal = {(0, 1), (1, 2), (2, 1)}
    initials = [*([] if before is None else [before]), *(r[0] for r in rows)]
    return sum(pair not in legal for pair in zip(initials, initials[1:])) + sum(r[2] for r in rows)


KEY = ["conv_id", "turn", "digest"]
SEGMENTS = """conv_id long, turn long, digest binary, part int, seq int, last_row int, first_initial int, rows binary,
 summary binary, audit string, cost long, illegal long"""


def _packed(rows: list[Row]) -> bytes:
    return np.array(rows, "<i8").tobytes()


def _rows(packed: bytes) -> tuple[Row, ...]:
    return tuple(map(tuple, np.frombuffer(packed, "<i8").reshape(-1, 3).tolist()))


def _segments(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows of a task, cut; conversations that lie within it and one segment are solved."""
    part, seq = TaskContext.get().partitionId(), 0
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("digest", pa.binary()), ("part", pa.int32()), ("seq", pa.int32())]
        + [("last_row", pa.int32()), ("first_initial", pa.int32()), ("rows", pa.binary()), ("summary", pa.binary())]
        + [("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())]
    )
    out: list[tuple] = []

    def close(head: tuple, rows: list[Row], whole: bool) -> None:
        nonlocal seq
        fixed = tuple(rows)
        cost, audit = solved(fixed) if whole else (None, None)
        packed = None if whole else summary(fixed).tobytes()
        out.append((*head, part, seq, rows[-1][0], rows[0][0], _packed(rows), packed, audit, cost, illegal_pairs(fixed)))
        seq += 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(schema)
        made = pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
        out.clear()
        return made

    head, rows, cut, first = None, [], False, True  # cut: it began in an earlier segment, or may have
    for got in batches:
        for conv, turn, digest, initial, fault, more in zip(*(got.column(c).to_pylist() for c in [*KEY, "initial", "fault", "more"])):
            if head is None or conv != head[0] or len(rows) == most:
                same = head is not None and conv == head[0]
                if head is not None:
                    close(head, rows, not (cut or same or first))
                    first = first and same
                cut = same
                head, rows = (conv, turn, digest), []
            rows.append((initial, fault, more))
        if len(out) >= 1024:
            yield batch()
    if head is not None:
        close(head, rows, False)  # it may go on in the next task
    yield batch()


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment of a conversation starts and ends; segments come last to first.

    Holds nine bytes for each segment of one conversation, that is for each ``SEGMENT`` of its rows.
    """
    finish = [INSERT * len(FINISH[s]) for s in range(STATES)]
    parts, seqs, choices = array("i"), array("i"), bytearray()
    firsts, lasts = bytearray(), bytearray()
    rest: list[float] = []
    conv: int | None = None

    def chosen() -> pa.RecordBatch:
        """Along the choices from the first segment."""
        n = len(parts)
        entry, states, state = [], [], NOTHING
        for k in range(n - 1, -1, -1):
            entry.append(state)
            state = choices[4 * k + state]
            states.append(state)
        breaks = [0, *(int((lasts[k + 1], firsts[k]) not in {(0, 1), (1, 2), (2, 1)}) for k in range(n - 2, -1, -1))]
        columns = [
            pa.array([conv] * n, pa.int64()),
            pa.array(parts[::-1], pa.int32()),
            pa.array(seqs[::-1], pa.int32()),
            pa.array(entry, pa.int32()),
            pa.array(states, pa.int32()),
            pa.array([False] * (n - 1) + [True] * (n > 0), pa.bool_()),
            pa.array(breaks if n else [], pa.int64()),
        ]
        return pa.record_batch(columns, ["conv_id", "part", "seq", "entry", "end", "closes", "breaks"])

    for batch in batches:
        names = ["conv_id", "part", "seq", "last_row", "first_initial", "summary"]
        for at, part, seq, last, first, packed in zip(*(batch.column(c).to_pylist() for c in names)):
            if len(parts) and at != conv:
                yield chosen()
                del parts[:], seqs[:], choices[:], firsts[:], lasts[:]
            if not len(parts):
                conv, rest = at, list(finish)
            costs, places = np.frombuffer(packed, "<i8").reshape(2, STATES, STATES).tolist()
            ahead = []
            for entry in range(STATES):
                ways = [(costs[entry][e] + rest[e], places[entry][e], e) for e in range(STATES) if costs[entry][e] >= 0]
                cost, _, end = min(ways)
                ahead.append(cost)
                choices.append(end)
            rest = ahead
            parts.append(part)
            seqs.append(seq)
            firsts.append(first)
            lasts.append(last)
    if len(parts):
        yield chosen()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and cost of each segment between its states."""
    for batch in batches:
        made = []
        for packed, entry, end, closes in zip(*(batch.column(c).to_pylist() for c in ("rows", "entry", "end", "closes"))):
            cost, audit = between(_rows(packed), entry, end)
            more = FINISH[end] if closes else ""
            made.append((audit + more, cost + INSERT * len(more)))
        audits, costs = zip(*made) if made else ((), ())
        columns = [*(batch.column(c) for c in [*KEY, "rows"]), pa.array(audits, pa.string()), pa.array(costs, pa.int64())]
        yield pa.record_batch([*columns, batch.column("illegal")], [*KEY, "rows", "audit", "cost", "illegal"])


REPAIRED = "conv_id long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"


class _Repair:
    """One conversation while its edits and rows come by."""

    def __init__(self, conv: int | None, texts: bool):
        self.conv, self.illegal, self.cost = conv, 0, 0
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.texts: list[str] | None = [] if texts else None
        self.state, self.empty = NOTHING, True
        self.edits: Iterator[tuple[str, int]] = iter(())
        self.key: tuple | None = None

    def write(self, role: str, text: str) -> None:
        turn = f"{role}:{text}"
        self.hash.update((turn if self.empty else "\n" + turn).encode())
        if self.texts is not None:
            self.texts.append(turn)
        self.empty = False

    def insert(self) -> None:
        self.state = AFTER[self.state]
        self.write("user" if self.state == USER else "assistant", "")

    def begin(self, rows: tuple[Row, ...], audit: str, cost: int, illegal: int) -> None:
        """The edits of the segment whose rows come next."""
        copies = iter(rows)
        edits = [(letter, 0 if letter == "I" else next(copies)[2]) for letter in audit]
        self.audit.append("".join(letter + "D" * more for letter, more in edits))
        self.cost += cost
        self.illegal += illegal
        self.edits = iter(edits)

    def row(self, key: tuple, role: str, text: str) -> None:
        if key == self.key:
            return  # a copy, gone with the edit of the first
        self.key = key
        for letter, _ in self.edits:
            if letter != "I":
                break
            self.insert()
        if letter == "K":
            self.state = KEPT["sua".index(role[:1])][self.state]
            self.write(role, text)
        elif letter == "R":
            self.state = AFTER[self.state]
            self.write("user" if self.state == USER else "assistant", text)

    def rest(self) -> None:
        """Inserts behind the last row of a segment."""
        for _ in self.edits:
            self.insert()

    def done(self) -> tuple:
        self.rest()
        texts = None if self.texts is None else "\n".join(self.texts)
        return self.conv, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest(), texts


def _written(texts: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and rows in order: a segment's edits, then its rows, then the next segment's."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
        + [("repaired_sha256", pa.string()), ("repaired", pa.string())]
    )
    now: _Repair | None = None
    names = [*KEY, "rows", "audit", "cost", "illegal", "role", "text"]
    for batch in batches:
        out = []
        for conv, turn, digest, rows, audit, cost, illegal, role, text in zip(*(batch.column(c).to_pylist() for c in names)):
            if now is None or conv != now.conv:
                if now is not None:
                    out.append(now.done())
                now = _Repair(conv, texts)
            if rows is not None:
                now.rest()
                now.begin(_rows(rows), audit, cost, illegal)
            else:
                now.row((turn, digest), role, text)
        columns = list(zip(*out)) or [()] * len(schema)
        yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
    if now is not None:
        yield pa.record_batch([pa.array([v], f.type) for v, f in zip(now.done(), schema)], schema=schema)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows as they are, with the nulls of role and text as one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`turns` damaged by the crc32 of ``conv_id:turn``: dropped, emptied, cut off, repeated, wrong role."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.encode(F.concat(conv, F.lit(":"), turn), "UTF-8")) % 20
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies"),
    )


def _digest() -> Column:
    size = F.octet_length("role").cast("string")
    return F.unhex(F.sha2(F.encode(F.concat(size, F.lit(":"), F.col("role"), F.col("text")), "UTF-8"), 256))


def _same(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on columns that may be null; the left side's are kept."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in on})
    both = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    condition = both[0]
    for more in both[1:]:
        condition = condition & more
    return left.join(renamed, condition, how).drop(*[f"_{c}" for c in on])


def classes(rows: DataFrame) -> DataFrame:
    """One row per different row: key, initial of the role, fault, blank, later (its text was seen before), copies."""
    text = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = rows.select(
        "conv_id",
        "turn",
        _digest().alias("digest"),
        (F.position(F.substring("role", 1, 1), F.lit("sua")) - 1).alias("place"),
        (F.col("role") == "").alias("nameless"),
        (text == "").alias("blank"),
        (~F.substring(text, -1, 1).isin(*ENDS)).alias("cut_off"),
        "copies",
    )
    initial = F.when(F.col("nameless") | (F.col("place") < 0), F.lit(3)).otherwise(F.col("place"))
    counted = (
        slim.groupBy(*KEY)
        .agg(F.sum("copies").alias("copies"), *[F.min(c).alias(c) for c in ("place", "nameless", "blank", "cut_off")])
        .select(*KEY, initial.cast("int").alias("initial"), "blank", "cut_off", "copies")
    )
    counted = saved(counted, "turns")
    when = F.struct(F.col("turn").isNotNull(), "turn")
    repeats = (
        counted.groupBy("conv_id", "digest")
        .agg(F.min(when).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("conv_id", "digest", F.col("first.turn").alias("first_turn"), F.lit(True).alias("repeated"))
    )
    later = F.coalesce(F.col("repeated") & ~F.col("turn").eqNullSafe(F.col("first_turn")), F.lit(False))
    return _same(counted, repeats, ["conv_id", "digest"], "left").select(
        *KEY, "initial", "blank", "cut_off", later.alias("later"), "copies"
    )


def faults(rows: DataFrame) -> DataFrame:
    """``gaps, blank, duplicate, truncated`` per conversation, from :func:`classes`."""
    fresh = ~F.col("blank") & ~F.col("later")
    span = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1) - F.count_distinct("turn"))
    zero = F.lit(0).cast("long")
    return rows.groupBy("conv_id").agg(
        F.coalesce(span, zero).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(zero)).alias("blank"),
        F.sum(F.when(F.col("blank"), zero).otherwise(F.col("copies") - F.when(fresh, 1).otherwise(0))).alias("duplicate"),
        F.count_if(fresh & F.col("cut_off")).alias("truncated"),
    )


def edits(rows: DataFrame) -> DataFrame:
    """``rows, audit, cost, illegal`` of every segment, with the key of its first row; from :func:`classes`."""
    lost = F.col("blank") | F.col("later")
    fault = F.when(lost, F.lit(MUST_GO)).when(F.col("cut_off"), F.lit(CUT_OFF)).otherwise(F.lit(FINE))
    coded = rows.select(*KEY, "initial", fault.alias("fault"), (F.col("copies") - 1).alias("more"))
    ordered = coded.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    segments = saved(ordered.mapInArrow(partial(_segments, SEGMENT), SEGMENTS), "segments")
    whole = segments.where("audit IS NOT NULL")
    open_ = segments.where("audit IS NULL")
    backwards = open_.select("conv_id", "part", "seq", "last_row", "first_initial", "summary").repartition("conv_id")
    backwards = backwards.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    states = backwards.mapInArrow(_states, "conv_id long, part int, seq int, entry int, end int, closes boolean, breaks long")
    told = open_.drop("audit", "cost").join(states.drop("conv_id"), ["part", "seq"]).withColumn("illegal", F.col("illegal") + F.col("breaks"))
    kept = [*KEY, "rows", "audit", "cost", "illegal"]
    made = told.mapInArrow(_edited, "conv_id long, turn long, digest binary, rows binary, audit string, cost long, illegal long")
    return whole.select(*kept).unionByName(made)


def repaired(conversations: DataFrame, rows: DataFrame | None = None, texts: bool = True) -> DataFrame:
    """One row per conv_id: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` and the text.

    ``rows`` are the conversations' rows to repair (``conv_id, turn, role, text, copies``, no nulls in the last
    three), by default :func:`turns`. ``repaired`` holds ``role:text`` lines unless ``texts`` is off.
    """
    rows = turns(conversations) if rows is None else rows
    known = saved(classes(rows), "classes")
    lines = rows.select("conv_id", "turn", _digest().alias("digest"), F.lit(1).alias("kind"), "role", "text")
    both = edits(known).withColumn("kind", F.lit(0)).unionByName(lines, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions(*KEY, "kind")
    written = ordered.mapInArrow(partial(_written, texts), REPAIRED)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = _same(_same(every, faults(known), ["conv_id"], "left"), written, ["conv_id"], "left")
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    out = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")]
    return joined.select("conv_id", *counts, *out, *([F.coalesce("repaired", F.lit("")).alias("repaired")] if texts else []))


def sql() -> str:
    """:func:`repaired` of the damaged ``conversations`` for DuckDB, without the text."""

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def way(state: int, cost: str, letter: str, text: str = "''") -> str:
        old = f"s[{state + 1}]"
        return f"{{'c': {old}.c + {cost}, 'a': {old}.a || '{letter}', 't': {old}.t || {text}}}"

    far = "CAST(1000000000 AS BIGINT)"
    role = {USER: "user", ASSISTANT: "assistant"}
    line = "chr(10) || {} || ':' || x.text"
    inserted, passed = [], []
    for state in range(STATES):
        before = [b for b in range(STATES) if AFTER[b] == state]
        inserted.append(least(f"s[{state + 1}]", *[way(b, str(INSERT), "I", f"chr(10) || '{role[state]}:'") for b in before]))
        ways = [way(state, str(DELETE), "D")]
        ways += [way(b, f"({REROLE} + x.left_)", "R", line.format(f"'{role[state]}'")) for b in before]
        for initial, moves in zip("sua", KEPT):
            kept = f"(x.left_ + CASE WHEN x.role[1] = '{initial}' THEN 0 ELSE {far} END)"
            ways += [way(b, kept, "K", line.format("x.role")) for b, to in moves.items() if to == state]
        passed.append(least(*ways))
    begin = ", ".join(f"{{'c': {'CAST(0 AS BIGINT)' if s == NOTHING else far}, 'a': '', 't': ''}}" for s in range(STATES))
    letters = "'[^\\x20\\x09-\\x0D]'"
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
),
kinds AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, k: xor(r >> 1, (r & 1) * 3988292384))
    ), 4294967295) % 20 AS kind
  FROM given
),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS place
  FROM rows_
),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, {letters}) THEN 'blank'
      WHEN min(place) OVER (PARTITION BY conv_id, role, text) < place THEN 'duplicate'
      WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) NOT IN ('.', '!', '?') THEN 'truncated'
      ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1] AS pair
  FROM placed
),
steps AS (
  SELECT conv_id, flatten(list([
      {{'kind': 0, 'role': '', 'text': '', 'left_': CAST(0 AS BIGINT)}}, {{'kind': 0, 'role': '', 'text': '', 'left_': CAST(0 AS BIGINT)}},
      {{'kind': 1, 'role': role, 'text': text,
        'left_': CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN {UNFINISHED} ELSE {far} END}}
    ] ORDER BY place)) AS xs,
    CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
),
ends AS (
  SELECT * EXCLUDE (xs), list_reduce(
      list_concat(xs, [{{'kind': 0, 'role': '', 'text': '', 'left_': CAST(0 AS BIGINT)}}, {{'kind': 0, 'role': '', 'text': '', 'left_': CAST(0 AS BIGINT)}}]),
      lambda s, x: CASE WHEN x.kind = 0 THEN [{", ".join(inserted)}] ELSE [{", ".join(passed)}] END,
      [{begin}]) AS s
  FROM steps
),
best AS (SELECT * EXCLUDE (s), {least(f"s[{NOTHING + 1}]", f"s[{ASSISTANT + 1}]")} AS b FROM ends)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(b.c AS BIGINT), 0) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(b.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
"""
