"""Token counts of sections: whole documents are encoded once, tokens are attributed by their offsets.

A document's tokens are those of its whole text under a byte-level vocabulary (ranks of byte strings), whose
tokens are consecutive stretches of its UTF-8 bytes; byte offsets become character offsets, a character
belonging to the byte it starts at. Sections are spans of characters, here the lines of a text or any spans
given with it. Both lists are in order of position, so they are joined as intervals in one merge per
document, which leaves no other task than the document's own.

A token that crosses a border is given away by one of these rules:

* ``most``: whole, to the section that holds most of its bytes, the earlier one at a tie (the default);
* ``first``: whole, to the section that holds its first byte;
* ``shares``: in parts, by each section's share of its bytes.

Every token lies in sections entirely, as sections cover the text; where given spans leave gaps, bytes in
gaps belong to no section and tokens wholly in gaps are counted as ``outside``.

Defined cases: null and empty texts have one section without tokens. A line keeps the line feed that ends
it, so lines cover the text; a text that ends with one has no further line. Rows count by themselves
whatever their ids. Other columns play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.texts import byte_texts, chunks

RULES = ("most", "first", "shares")

_encoders: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """Ids of a text and the bytes each id stands for."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def token_ends(self, text: str) -> np.ndarray:
        """The byte offset behind each token of ``text``."""
        return np.cumsum(self.sizes[self.encoding.encode_ordinary(text)])


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def character_offsets(text: bytes, at: np.ndarray) -> np.ndarray:
    """For byte offsets the number of characters that start before them."""
    starts = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(starts)])[at]


def line_spans(text: bytes) -> np.ndarray:
    """Byte offsets (begin, end) of the lines, line feeds included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if not len(ends) or ends[-1] != len(text):
        ends = np.append(ends, len(text))
    return np.stack([np.concatenate([[0], ends[:-1]]), ends], axis=1)


def attribute(ends: np.ndarray, spans: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each span (ordered, disjoint) and how many of them cross one of its borders.

    An interval join: for each token the first and the last span it meets are found by position, then the
    overlaps in between are listed.
    """
    begins = np.concatenate([[0], ends])[:-1]
    low, high = spans[:, 0], spans[:, 1]
    first = np.searchsorted(high, begins, "right")
    last = np.searchsorted(low, ends, "left") - 1
    many = np.maximum(last - first + 1, 0)
    token = np.repeat(np.arange(len(ends)), many)
    span = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    overlap = np.minimum(ends[token], high[span]) - np.maximum(begins[token], low[span])
    token, span, overlap = token[overlap > 0], span[overlap > 0], overlap[overlap > 0]
    size = ends - begins
    crossing = np.bincount(span[overlap < size[token]], minlength=len(spans))
    if rule == "shares":
        return np.bincount(span, overlap / size[token], minlength=len(spans)), crossing
    if rule == "most":
        order = np.lexsort((span, -overlap, token))
        token, span = token[order], span[order]
        chosen = np.concatenate([[True], token[1:] != token[:-1]])[: len(token)]
    else:
        chosen = (low[span] <= begins[token]) & (begins[token] < high[span])
    return np.bincount(span[chosen], minlength=len(spans)).astype(float), crossing


SECTIONS = "doc_id long, section int, first_char long, last_char long, n_tokens double, n_crossing long, document_tokens long, outside long"


def _counted(path: str, pattern: str, rule: str, spans: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = encoder(path, pattern)
    for batch in chunks(batches):
        given = batch.column("spans").to_pylist() if spans else [None] * batch.num_rows
        columns: list[list[np.ndarray]] = []
        docs = []
        for doc, text, chars in zip(batch.column("doc_id").to_pylist(), byte_texts(batch), given):
            ends = own.token_ends(text.decode())
            if chars is None:
                places = line_spans(text)
                edges = character_offsets(text, places)
            else:
                starts = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
                edges = np.clip(np.array([(s["begin"], s["end"]) for s in chars], np.int64).reshape(-1, 2), 0, len(starts) - 1)
                places = starts[edges]
            tokens, crossing = attribute(ends, places, rule)
            n = len(places)
            docs += [doc] * n
            outside = _outside(ends, places)
            columns.append([np.arange(n), edges[:, 0], edges[:, 1], tokens, crossing, np.full(n, len(ends)), np.full(n, outside)])
        if docs:
            merged = [np.concatenate(c) for c in zip(*columns)]
            merged[0] = merged[0].astype(np.int32)
            names = [f.split()[0] for f in SECTIONS.split(", ")]
            yield pa.record_batch([pa.array(docs, pa.int64()), *map(pa.array, merged)], names)


def _outside(ends: np.ndarray, spans: np.ndarray) -> int:
    """Tokens that meet no span."""
    begins = np.concatenate([[0], ends])[:-1]
    filled = spans[spans[:, 1] > spans[:, 0]]
    return int((np.searchsorted(filled[:, 1], begins, "right") >= np.searchsorted(filled[:, 0], ends, "left")).sum())


def section_tokens(docs: DataFrame, path: str, pattern: str, rule: str = "most", spans: str | None = None) -> DataFrame:
    """``SECTIONS``: one row for each section of each row of ``docs``.

    Sections are the lines of ``text``, or the disjoint, ordered spans of characters in the column
    ``spans`` names (``array<struct<begin, end>>``). ``path`` holds a vocabulary as base64 byte
    strings and ranks, ``pattern`` splits texts into words.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = [] if spans is None else [F.col(spans).alias("spans")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *given)
    return rows.mapInArrow(partial(_counted, path, pattern, rule, spans is not None), SECTIONS)
