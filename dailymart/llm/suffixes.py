"""Repeated byte strings across a corpus: a partitioned suffix order by deep-shallow sorting.

Every whole text counts as its UTF-8 bytes. A byte is removed if a string of ``LENGTH`` (200) bytes that
covers it also starts anywhere else, in the same text or another one; strings never cross texts and are
judged on the input.

Suffixes that share 200 bytes must meet in one task, without shuffling a suffix for each byte:

1. Each start belongs to an anchor: the smallest hash among the ``GRAM``-byte strings inside its 200
   bytes. Equal strings have anchors of equal hash, so only anchors seen at least twice go on.
2. The starts of an anchor are consecutive; together they cover a *segment*. Equal segments of an anchor
   collapse to one with a count: all starts of a segment seen twice are repeated.
3. The suffixes of the remaining segments are ordered anchor by anchor: multikey quicksort (words of
   8 bytes as keys, only ties go on) to a shallow depth, then blind tries order the groups that still
   have a common prefix. Starts whose neighbour in that order shares 200 bytes are repeated.
4. An anchor with more than ``SORTED_SEGMENTS`` different segments (a passage in very many contexts) would
   fill one task. Its starts are counted by a 128-bit fingerprint of their 200 bytes instead, with
   partial aggregation.

Defined cases: null and empty texts have no bytes and keep the hash of nothing. Rows are told apart by
their text, so equal texts under any ids are copies of each other and are removed in full if they have 200
bytes; null or repeated ids make no difference. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import BROADCAST_ROWS, matching, saved
from dailymart.llm.texts import U64, byte_texts, chunks, mixed

LENGTH = 200
GRAM = 50
SPAN = LENGTH - GRAM + 1  # grams that begin inside a string of LENGTH bytes, whole
SHALLOW = 32
#: Different segments of one anchor that a single sort takes at most.
SORTED_SEGMENTS = 4096
#: Bytes of a piece whose grams are hashed at once; positions inside it take 16 bits.
POSITION_BITS = 16
PIECE = (1 << POSITION_BITS) - LENGTH
#: Bytes of segments that are sorted together.
SORT_BYTES = 1 << 20

_LOW_BITS = U64(POSITION_BITS + 3)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64, for all positions of a piece."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full((1 << POSITION_BITS) + 1, U64(b))
        p[0] = U64(1)
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_POWERS = [_powers(b) for b in _BASES]
#: Values for the bytes: sums of small multiples would collide more.
_BYTE = mixed(np.arange(1, 257, dtype=U64))


def prefix_sums(data: np.ndarray, base: int = 0) -> np.ndarray:
    """Polynomial hashes of the prefixes of ``data``, the empty one included."""
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * _POWERS[base][0][: len(data)], out=total[1:])
    return total


def window_hashes(total: np.ndarray, starts: np.ndarray | slice, width: int, base: int = 0) -> np.ndarray:
    """Hashes of the ``width`` bytes from each of ``starts``."""
    ends = slice(starts.start + width, starts.stop + width) if isinstance(starts, slice) else starts + width
    return mixed((total[ends] - total[starts]) * _POWERS[base][1][starts])


def _tails() -> np.ndarray:
    """The low bits by which equal grams compete: few trailing zero bits of the position, then the position."""
    at = np.arange(1 << POSITION_BITS, dtype=U64)
    zeros = np.zeros(len(at), U64)
    for bit in range(1, 8):
        zeros[:: 1 << bit] = bit
    return (U64(7) - zeros) << U64(POSITION_BITS) | at


_TAILS = _tails()


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values: block-wise minima from both ends."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, ~U64(0))
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def anchors_of(total: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, last start, repeats) of the anchors of texts lying one after the other.

    ``total``: prefix sums of their bytes; ``ends``: end of each text. The hash is the part of the gram's
    that decides which gram is smallest (45 bits), so equal strings have equal anchors even where two grams
    tie. Ties go to positions with many trailing zero bits, which leaves runs of one pattern few anchors.
    ``repeats``: the anchor's gram occurs again within its reach, so its own starts may be equal.
    """
    size = len(total) - 1
    grams = window_hashes(total, slice(0, size - GRAM + 1), GRAM)
    packed = (grams >> _LOW_BITS) << _LOW_BITS | _TAILS[: len(grams)]
    chosen = sliding_min(packed, SPAN)
    whole = np.ones(len(chosen), bool)
    for end in ends:
        whole[max(0, end - LENGTH + 1) : end] = False
    starts = np.flatnonzero(whole)
    chosen = chosen[starts]
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))[: len(chosen)]
    last = np.concatenate([first[1:], [len(chosen)]])[: len(first)] - 1
    position = (chosen[first] & U64((1 << POSITION_BITS) - 1)).astype(np.int64)
    short = np.concatenate([grams >> _LOW_BITS, np.full(SPAN, ~U64(0))])
    hashes = short[position]
    repeats = np.zeros(len(first), bool)
    reach = np.arange(1, SPAN)
    for low in range(0, len(first), 2048):
        near = short[position[low : low + 2048, None] + reach]
        repeats[low : low + 2048] = (near == hashes[low : low + 2048, None]).any(axis=1)
    return hashes, starts[first], starts[last], repeats


def text_key(text: Column) -> tuple[Column, Column]:
    """120 bits of SHA-256 as two longs: equal texts have equal keys."""
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    halves = [F.conv(F.substring(digest, i, 15), 16, 10).cast("long") for i in (1, 16)]
    return halves[0].alias("k1"), halves[1].alias("k2")


ANCHORS = "k1 long, k2 long, anchor long, segment long, start long, starts int, repeats boolean"


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, ends, rows and offsets of texts laid one after the other; a long text comes in overlapping pieces."""
    own: list[int] = []
    size = 0

    def joined():
        return b"".join(texts[i] for i in own), np.cumsum([len(texts[i]) for i in own]), np.array(own), np.zeros(len(own), np.int64)

    for row, text in enumerate(texts):
        if len(text) > PIECE:
            for at in range(0, len(text) - LENGTH + 1, PIECE):
                piece = text[at : at + PIECE + LENGTH - 1]
                yield piece, np.array([len(piece)]), np.array([row]), np.array([at])
        elif len(text) >= LENGTH:
            if size + len(text) > PIECE:
                yield joined()
                own, size = [], 0
            own.append(row)
            size += len(text)
    if own:
        yield joined()


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        k1, k2 = (batch.column(k).to_numpy() for k in ("k1", "k2"))
        found = []
        for data, ends, rows, offsets in _pieces(byte_texts(batch)):
            total = prefix_sums(np.frombuffer(data, np.uint8))
            anchor, first, last, repeats = anchors_of(total, ends)
            text = np.searchsorted(ends, first, side="right")
            # Two strings of LENGTH bytes cover the segment, as no more than SPAN starts share an anchor.
            edges = window_hashes(total, first, LENGTH) ^ mixed(window_hashes(total, last, LENGTH) + (last - first).astype(U64))
            start = first - np.concatenate([[0], ends[:-1]])[text] + offsets[text]
            row = rows[text]
            found.append((k1[row], k2[row], anchor.view(np.int64), mixed(edges).view(np.int64), start, (last - first + 1).astype(np.int32), repeats))
        if found:
            yield pa.record_batch([np.concatenate(c) for c in zip(*found)], [f.split()[0] for f in ANCHORS.split(", ")])


# ---- deep-shallow sorting -------------------------------------------------------------------------------


class _Node:
    """Inner node of a blind trie: the depth at which its children differ, and they by that byte."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth, self.children = depth, {}


def _common(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a)
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes]) -> Iterator[list[int]]:
    """Positions of strings of one length in ascending order, equal ones together.

    Insertion goes down blindly, looking at branching bytes only, to some leaf; one comparison with that
    leaf gives the depth at which the string leaves the trie.
    """
    root: _Node | list[int] = [0]
    for i in range(1, len(strings)):
        text, node = strings[i], root
        while isinstance(node, _Node):
            node = node.children.get(text[node.depth]) or next(iter(node.children.values()))
        other = strings[node[0]]
        depth = _common(text, other)
        if depth == len(text):
            node.append(i)
            continue
        parent, node = None, root
        while isinstance(node, _Node) and node.depth < depth:
            parent, node = node, node.children[text[node.depth]]
        if isinstance(node, _Node) and node.depth == depth:
            node.children[text[depth]] = [i]
            continue
        fresh = _Node(depth)
        fresh.children = {other[depth]: node, text[depth]: [i]}
        if parent is None:
            root = fresh
        else:
            parent.children[text[parent.depth]] = fresh
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack += [node.children[b] for b in sorted(node.children, reverse=True)]
        else:
            yield node


def big_endian_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number that compares like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), U64)
    for i in range(8):
        out = out << U64(8) | padded[i : len(data) + i]
    return out


def deep_shallow_order(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by (group, first LENGTH bytes), and whether each equals the one before.

    Shallow: multikey quicksort on words of 8 bytes; only ties are refined. Deep: blind tries.
    """
    words = big_endian_words(data)
    order = np.argsort(group, kind="stable")
    g = group[order]
    rank = np.concatenate([[0], np.cumsum(g[1:] != g[:-1])])
    open_ = np.arange(len(order))
    for depth in range(0, SHALLOW, 8):
        if not len(open_):
            break
        key = words[starts[order[open_]] + depth]
        by = np.lexsort((key, rank[open_]))
        order[open_], key = order[open_][by], key[by]
        old = rank[open_]
        differs = np.concatenate([[True], (old[1:] != old[:-1]) | (key[1:] != key[:-1])])
        rank[open_] = open_[np.maximum.accumulate(np.where(differs, np.arange(len(open_)), 0))]
        tied = ~differs
        tied[:-1] |= ~differs[1:]
        open_ = open_[tied]
    same = np.zeros(len(order), bool)
    if len(open_):
        blob = data.tobytes()
        r = rank[open_]
        cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1), len(r)]
        for low, high in zip(cuts, cuts[1:]):
            at = open_[low:high]
            own = order[at]
            strings = [blob[s + SHALLOW : s + LENGTH] for s in starts[own]]
            if high - low == 2:
                if strings[0] == strings[1]:
                    same[at[1]] = True
                elif strings[0] > strings[1]:
                    order[at] = own[::-1]
                continue
            place = 0
            for leaf in blind_trie_order(strings):
                order[at[place : place + len(leaf)]] = own[leaf]
                same[at[place + 1 : place + len(leaf)]] = True
                place += len(leaf)
    return order, same


SEGMENTS = "anchor long, k1 long, k2 long, start long, many boolean, content binary"
RANGES = "k1 long, k2 long, begin long, end long"


def _ranges(owner: np.ndarray, start: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, begin, end) of the runs of consecutive hit starts, as covered bytes."""
    owner, start = owner[hit], start[hit]
    if not len(owner):
        return owner, start, start
    cut = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(cut)
    last = np.concatenate([first[1:], [len(owner)]]) - 1
    return owner[first], start[first], start[last] + LENGTH


def _repeated(rows: pa.Table) -> pa.RecordBatch:
    """Covered ranges of the segments in ``rows`` (whole groups of an anchor)."""
    content = rows.column("content").to_pylist()
    sizes = np.array([len(c) for c in content])
    data = np.frombuffer(b"".join(content), np.uint8)
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(content)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = inside + np.repeat(np.cumsum(sizes) - sizes, counts)
    order, same = deep_shallow_order(data, starts, rows.column("anchor").to_numpy()[owner])
    hit = np.zeros(len(owner), bool)
    hit[order] = same | np.concatenate([same[1:], [False]])
    whose, begin, end = _ranges(owner, inside, hit)
    base = rows.column("start").to_numpy()[whose]
    k1, k2 = (rows.column(k).to_numpy()[whose] for k in ("k1", "k2"))
    return pa.record_batch([k1, k2, base + begin, base + end], ["k1", "k2", "begin", "end"])


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts the suffixes of anchor after anchor, many small ones at a time."""
    waiting: pa.Table | None = None
    for batch in batches:
        waiting = pa.concat_tables([waiting, pa.Table.from_batches([batch])]) if waiting else pa.Table.from_batches([batch])
        if waiting.nbytes < SORT_BYTES:
            continue
        anchor = waiting.column("anchor").to_numpy()
        cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        low = 0
        for high in cuts:
            if high == cuts[-1] or waiting.slice(low, high - low).nbytes >= SORT_BYTES:
                yield _repeated(waiting.slice(low, high - low))
                low = high
        waiting = waiting.slice(low)
    if waiting:
        yield _repeated(waiting)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments listed beside each text."""
    for batch in chunks(batches):
        wanted = batch.column("wanted")
        counts = np.diff(wanted.offsets.to_numpy())
        owner = np.repeat(np.arange(batch.num_rows), counts)
        fields = dict(zip([f.name for f in wanted.type.value_type], wanted.flatten().flatten()))
        texts = byte_texts(batch)
        begin = fields["start"].to_numpy()
        end = begin + fields["starts"].to_numpy() + LENGTH - 1
        content = [texts[o][b:e] for o, b, e in zip(owner.tolist(), begin.tolist(), end.tolist())]
        k1, k2 = (batch.column(k).to_numpy()[owner] for k in ("k1", "k2"))
        yield pa.record_batch(
            [fields["anchor"], k1, k2, fields["start"], fields["many"], pa.array(content, pa.binary())],
            [f.split()[0] for f in SEGMENTS.split(", ")],
        )


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each start of the segments, with two hashes of its LENGTH bytes."""
    for batch in batches:
        k1, k2, start = (batch.column(k).to_numpy() for k in ("k1", "k2", "start"))
        rows = []
        for i, content in enumerate(batch.column("content").to_pylist()):
            data = np.frombuffer(content, np.uint8)
            at = slice(0, len(data) - LENGTH + 1)
            hashes = [window_hashes(prefix_sums(data, b), at, LENGTH, b).view(np.int64) for b in (0, 1)]
            rows.append((*hashes, np.full(at.stop, k1[i]), np.full(at.stop, k2[i]), start[i] + np.arange(at.stop)))
        if rows:
            yield pa.record_batch([np.concatenate(c) for c in zip(*rows)], ["h1", "h2", "k1", "k2", "begin"])


KEYS = ["k1", "k2"]


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``RANGES``: covered bytes of each different text of ``texts(k1, k2, text)``, possibly overlapping.

    Copies of a whole text do not count against each other; see ``covered``.
    """
    texts = texts.where(F.octet_length("text") >= LENGTH)
    anchors = texts.mapInArrow(_anchors, ANCHORS).distinct()
    seen = anchors.groupBy("anchor").agg(F.count("*").alias("times"), F.bool_or("repeats").alias("repeats"))
    seen = seen.where("times > 1 OR repeats").select("anchor")
    found = saved(anchors.join(seen, "anchor", "left_semi"), "anchors")

    place = F.struct(*KEYS, "start", "starts").alias("place")
    segments = found.groupBy("anchor", "segment").agg(
        F.count("*").alias("n"), F.bool_or("repeats").alias("repeats"), F.min(place).alias("place")
    )
    segments = saved(segments, "segments")
    twice = segments.where("n > 1").select("anchor", "segment")
    whole = found.join(twice, ["anchor", "segment"], "left_semi").select(
        *KEYS, F.col("start").alias("begin"), (F.col("start") + F.col("starts") + LENGTH - 1).alias("end")
    )

    several = segments.groupBy("anchor").agg(
        F.count("*").alias("different"), F.bool_or(F.col("repeats") & (F.col("n") == 1)).alias("inside")
    )
    wanted = (
        segments.join(several.where("different > 1 OR inside"), "anchor")
        .withColumn("many", F.col("different") > SORTED_SEGMENTS)
        .select("anchor", "many", "place.*")
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("anchor", "start", "starts", "many")).alias("wanted"))
    )
    wanted = saved(wanted, "wanted")
    needed = matching(texts, wanted.select(*KEYS), KEYS).dropDuplicates(KEYS)
    contents = saved(needed.join(wanted, KEYS).select(*KEYS, "text", "wanted").mapInArrow(_contents, SEGMENTS), "contents")

    few = contents.where("NOT many").repartition("anchor").sortWithinPartitions("anchor")
    ordered = few.mapInArrow(_sorted, RANGES)
    prints = contents.where("many").mapInArrow(_prints, "h1 long, h2 long, k1 long, k2 long, begin long")
    again = prints.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1").select("h1", "h2")
    counted = prints.join(again, ["h1", "h2"], "left_semi").select(*KEYS, "begin", (F.col("begin") + LENGTH).alias("end"))
    return whole.unionByName(ordered).unionByName(counted)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by ``spans`` (begin, end)."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def covered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its text's key, and per key ``spans``; a null ``spans`` means the whole text."""
    keyed = docs.select("*", *text_key(F.col("text")))
    long_ = keyed.where(F.octet_length("text") >= LENGTH).select(*KEYS, "text")
    copies = long_.groupBy(*KEYS).agg(F.count("*").alias("times")).where("times > 1").select(*KEYS)
    copies = saved(copies, "copies")
    spans = repeated_ranges(long_).join(copies, KEYS, "left_anti").groupBy(*KEYS)
    spans = spans.agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    kind = "array<struct<begin:bigint,end:bigint>>"
    return keyed, saved(spans.unionByName(copies.withColumn("spans", F.lit(None).cast(kind))), "spans")


def _marked(keyed: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without spans (``whole``: the text repeats as a whole), not shuffled if few have any, and rows with ``spans``."""
    marks = spans.select(*KEYS, F.col("spans").isNull().alias("whole"))
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    plain = keyed.join(marks, KEYS, "left").where("whole IS NULL OR whole")
    some = spans.where("spans IS NOT NULL")
    return plain, matching(keyed, some.select(*KEYS), KEYS).join(some, KEYS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = []
        for text, spans in zip(byte_texts(batch), batch.column("spans").to_pylist()):
            runs = merged(spans)
            digest = hashlib.sha256()
            at = 0
            for begin, end in runs:
                digest.update(text[at:begin])
                at = end
            digest.update(text[at:])
            rows.append((len(text), sum(e - b for b, e in runs), len(runs), digest.hexdigest()))
        yield pa.record_batch(
            [batch.column("doc_id"), *(pa.array(c) for c in zip(*rows))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removals(docs: DataFrame) -> DataFrame:
    """``DIGESTS`` of every row: bytes, removed bytes, maximal removed runs, SHA-256 of the rest."""
    keyed, spans = covered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    plain, some = _marked(keyed, spans)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    gone = F.coalesce("whole", F.lit(False))
    left = F.when(gone, F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    plain = plain.select(
        "doc_id",
        size.alias("n_bytes"),
        F.when(gone, size).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        gone.cast("long").alias("n_spans"),
        F.sha2(left, 256).alias("kept_sha256"),
    )
    return plain.unionByName(some.select("doc_id", "text", "spans").mapInArrow(_digests, DIGESTS))


def without(text: bytes, runs: list[tuple[int, int]]) -> str:
    """The text less the whole characters inside ``runs``."""
    out, at = [], 0
    for begin, end in runs:
        while begin < len(text) and text[begin] & 0xC0 == 0x80:
            begin += 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        out.append(text[at:begin])
        at = max(at, begin, end)
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "llm text"):
        texts = [
            without(t, merged(s)) for t, s in zip(byte_texts(batch, "llm text"), batch.column("llm spans").to_pylist())
        ]
        yield pa.record_batch([batch.column("llm row"), pa.array(texts, pa.string())], ["row", "text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes cut from ``text`` and ``n_chars`` counted anew; rows and columns stay.

    Characters are cut whole: one whose bytes are removed in part only stays. A text that repeats as a
    whole becomes empty; null stays null.
    """
    keyed, spans = covered(docs.select("text"))
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "text", *text_key(F.col("text")))
    plain, some = _marked(keyed, spans)
    empty = F.when(F.coalesce("whole", F.lit(False)), F.lit("")).otherwise(F.col("text"))
    plain = plain.select("row", empty.alias("text"))
    row = keyed.schema["row"].dataType.simpleString()
    some = some.select(F.col("row").alias("llm row"), F.col("text").alias("llm text"), F.col("spans").alias("llm spans"))
    both = plain.unionByName(some.mapInArrow(_cut, f"row {row}, text string"))
    changed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return both.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in names])
