"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut where no piece can reach across (before every run of spaces,
around characters that occur in no piece of several characters), and the parts
are merged one by one: the adjacent pair of lowest rank, leftmost first, is
popped from a heap and its two list nodes become one.  The count is the number
of initial symbols minus the number of merges; a character that is no piece
counts as its UTF-8 bytes.  No identifiers are made.

The model file's path is a parameter; the file is read on the driver and its
pieces (a fixed vocabulary) go to the tasks.

Defined results: null and empty texts have 0 tokens and 0 bytes; a text of any
length is counted whole; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import map_text

SPACE = "▁"  # stands for a blank inside pieces
MEMO = 1_000_000  # parts whose counts a task remembers
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in the public model format


def _fields(raw: bytes):
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


def read_pieces(path: str) -> dict[str, int]:
    """Rank of every mergeable piece of a sentencepiece model; 0 merges first.

    Only models like the given one are accepted: byte pairs, byte fallback, no
    user-defined or unused pieces, text unchanged but for blanks, one blank put
    before the text.
    """
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    trainer = dict(_fields(next(v for n, v in fields if n == 2)))
    normal = dict(_fields(next((v for n, v in fields if n == 3), b"")))
    if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
        raise ValueError("not a byte-pair model with byte fallback and blanks before words")
    if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
        raise ValueError("the model normalises texts in a way that is not supported")
    scores = {}
    for number, value in fields:
        if number == 1:
            piece = dict(_fields(value))
            kind = piece.get(3, NORMAL)
            if kind in (USER, UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            if kind == NORMAL:
                scores[piece[1].decode()] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
    if any(SPACE in piece.lstrip(SPACE) for piece in scores):
        raise ValueError("pieces that reach across blanks are not supported")
    rank = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
    return {piece: rank[score] for piece, score in scores.items()}


def merged_count(part: str, ranks: dict[str, int]) -> int:
    """Number of tokens of a part."""
    rank_of = ranks.get
    symbols: list[str | None] = list(part)
    size = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = [
        (rank, i, i + 1, pair)
        for i, pair in enumerate(map(str.__add__, part, part[1:]))
        if (rank := rank_of(pair)) is not None
    ]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, left, right, pair = heapq.heappop(heap)
        grown = symbols[left]
        if grown is None or after[left] != right or grown + symbols[right] != pair:
            continue  # offered before one of the two grew or went
        symbols[left], symbols[right] = pair, None
        beyond = after[left] = after[right]
        if beyond < size:
            before[beyond] = left
            longer = pair + symbols[beyond]
            if (rank := rank_of(longer)) is not None:
                heapq.heappush(heap, (rank, left, beyond, longer))
        prior = before[left]
        if prior >= 0:
            longer = symbols[prior] + pair
            if (rank := rank_of(longer)) is not None:
                heapq.heappush(heap, (rank, prior, left, longer))
        merges += 1
    fallback = sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in ranks)
    return size - merges + fallback


class Counts(dict):
    """Counts of the parts seen; a missing part is merged and remembered if it is short."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, part: str) -> int:
        count = merged_count(part, self.ranks)
        if len(part) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[part] = count
        return count


class TokenCounter:
    """Counts the tokens of texts."""

    def __init__(self, ranks: dict[str, int]):
        inner = {c for piece in ranks if len(piece) > 1 for c in piece}
        alone = re.escape("".join(c for c in map(chr, range(32)) if c not in inner))  # line ends stand alone
        self.parts = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self.counts = Counts(ranks)

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.counts.__getitem__, self.parts.findall(SPACE + text.replace(" ", SPACE))))


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document of docs (doc_id, text)."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_pieces(model))  # a vocabulary of fixed size
    counter = []

    def step(batch: pa.RecordBatch) -> dict:
        if not counter:
            counter.append(TokenCounter(ranks.value))
        texts = batch.column("text")
        count = counter[0].count
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": pc.fill_null(pc.binary_length(texts).cast(pa.int64()), 0),
            "n_tokens": np.fromiter((count(t.as_py() or "") for t in texts), np.int64, len(texts)),
        }

    counted = map_text(docs, ["doc_id", "text"], "doc_id long, n_bytes long, n_tokens long", step)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
