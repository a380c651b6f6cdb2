"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

Both tokenizers cut the same bytes, a blank and the text.  Byte offsets at which
tokens of both end cut them into groups; a link is a pair of tokens whose byte
ranges overlap.  ``count`` of a pair of ids is the number of documents that hold
it linked.

1. Texts are cut before every single blank between two characters that are no
   white space: neither tokenizer can reach across (checked when the files are
   read, else nothing is cut), so both end there, and a text is the row of its
   parts.  A task encodes and aligns a part once while it remembers it.  A pair
   whose B id is the one that the identity map (A id to the B id of the same
   bytes, made from the vocabularies) gives is kept as its A id alone; all other
   pairs come from irregular groups, or are the rare overlap of equal bytes at
   different places, and are kept as pairs.
2. Identity pairs are counted in vectors of the length of A's vocabulary, one
   per task.  Only irregular pairs are shuffled, by pair, after each task has
   added up its own.
3. Every document adds the counts of its links.  The vectors and the most
   frequent irregular pairs (``max_frequent`` at most, by a threshold on the
   count) go to all tasks: both sizes are bounded.  The others, which few
   documents hold each, are joined by pair and added up by row.

Defined results: texts that are null, empty, or whose joined token bytes differ
from blank + text have no tokens (zeros, '' as digest); rows count as documents,
also repeated ones and those without id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import map_text, saved

SPACE = "▁"  # stands for a blank inside pieces
MEMO = 600_000  # parts that a task remembers
MAX_FREQUENT = 1 << 19  # irregular pairs that go to all tasks
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_of_symbol() -> dict[str, int]:
    """Byte that each symbol of a byte-level vocabulary stands for: printable bytes for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the identity map; made from the contents of the two files."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        of_symbol = byte_of_symbol()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(of_symbol[s] for s in entry) if all(s in of_symbol for s in entry) else b""
        count = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(count)]
        unused = [self.b.is_control(i) or self.b.is_unknown(i) for i in range(count)]
        self.bytes_b = [
            b"" if no else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, (p, no) in enumerate(zip(pieces, unused, strict=True))
        ]
        by_bytes = {self.bytes_b[i]: i for byte in (True, False) for i in range(count) if self.b.is_byte(i) == byte and not unused[i]}
        self.same = np.array([by_bytes.get(b, -1) if b else -1 for b in self.bytes_a], np.int32)
        self.size_a = np.array([len(b) for b in self.bytes_a])
        self.size_b = np.array([len(b) for b in self.bytes_b])
        setting = json.loads(first)
        cutter = setting.get("pre_tokenizer") or {}
        self.cuts = (
            cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not setting.get("normalizer")
            and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        )
        # texts of ids with the mark that follows them: inside a side, at the end of a side
        self.written = [f"{i}{mark}" for size, end in ((len(self.bytes_a), "|"), (count, ";")) for mark in (",", end) for i in range(size)]
        self.forget()

    def forget(self) -> None:
        """Empties the memory of parts: number by text, groups as text, counts, and flat lists of identity ids and other pairs."""
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []  # None: the bytes are not those of the part
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.same_of, self.pair_of = Ragged(), Ragged()

    def learn(self, parts: list[str]) -> None:
        """Encodes and aligns new parts, each with the blank before it, and remembers them.

        All parts lie on one axis of bytes: their ends are ends of both.
        """
        first = [e.ids for e in self.a.encode_batch([" " + p for p in parts], add_special_tokens=False)]
        second = self.b.encode(parts, num_threads=1)
        wanted = [b" " + p.encode() for p in parts]
        fits = [True] * len(parts)
        for ids, table, sizes in ((first, self.bytes_a, self.size_a), (second, self.bytes_b, self.size_b)):
            whole = list(chain.from_iterable(ids))
            ends = np.concatenate([[0], np.cumsum(sizes[whole])])[np.cumsum(list(map(len, ids)))]
            same_ends = np.array_equal(ends, np.cumsum(list(map(len, wanted))))
            if not same_ends or b"".join(map(table.__getitem__, whole)) != b"".join(wanted):
                fits = [ok and b"".join(map(table.__getitem__, i)) == w for ok, i, w in zip(fits, ids, wanted, strict=True)]
        if not all(fits):
            first = [ids if ok else [] for ids, ok in zip(first, fits, strict=True)]
            second = [ids if ok else [] for ids, ok in zip(second, fits, strict=True)]
        n_a, n_b = np.fromiter(map(len, first), np.int64, len(parts)), np.fromiter(map(len, second), np.int64, len(parts))
        a = np.fromiter(chain.from_iterable(first), np.int64, n_a.sum())
        b = np.fromiter(chain.from_iterable(second), np.int64, n_b.sum())
        first_a, first_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        bounds = np.concatenate([[0], end_a])[first_a]  # byte ends of the parts
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        segments = np.union1d(end_a, end_b)  # every link is one stretch between neighbouring ends
        link_a, link_b = a[np.searchsorted(end_a, segments)], b[np.searchsorted(end_b, segments)]
        owner = np.searchsorted(bounds[1:], segments)
        n_groups = np.diff(np.searchsorted(common, bounds, side="right"))
        n_links = np.diff(np.searchsorted(segments, bounds, side="right"))
        same = self.same[link_a] == link_b
        # groups as text
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        last_a, last_b = common[group_a] == end_a, common[group_b] == end_b
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        codes = np.concatenate([a + last_a * size_a, 2 * size_a + b + last_b * size_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = list(map(self.written.__getitem__, codes[order].tolist()))
        ends = (first_a + first_b).tolist()
        self.groups += ["".join(written[x:y]) if ok else None for x, y, ok in zip(ends, ends[1:], fits, strict=False)]
        self.counts = np.concatenate([self.counts, np.column_stack([n_a, n_b, n_groups, n_links])])
        self.same_of.extend(np.bincount(owner[same], minlength=len(parts)), link_a[same])
        self.pair_of.extend(np.bincount(owner[~same], minlength=len(parts)), link_a[~same] * size_b + link_b[~same])

    def align(self, texts: list[str | None]) -> dict:
        """Per text the counts, the digest of its groups, its identity links and its other links, each with a count of places."""
        if len(self.number) > MEMO:
            self.forget()
        number, fresh, rows = self.number, [], []
        for text in texts:
            parts = () if not text else CUT.split(text) if self.cuts else (text,)
            own = list(map(number.get, parts))
            if None in own:
                for k, i in enumerate(own):
                    if i is None:
                        if parts[k] not in number:
                            number[parts[k]] = len(number)
                            fresh.append(parts[k])
                        own[k] = number[parts[k]]
            rows.append(own)
        if fresh:
            self.learn(fresh)
        groups, digests = self.groups, []
        for i, own in enumerate(rows):
            written = [groups[k] for k in own]
            if None in written:
                rows[i] = written = []
            digests.append(hashlib.sha256("".join(written)[:-1].encode()).hexdigest() if written else "")
        n, sizes = len(texts), np.fromiter(map(len, rows), np.int64, len(texts))
        doc = np.repeat(np.arange(n), sizes)
        parts = np.fromiter(chain.from_iterable(rows), np.int64, len(doc))
        ends = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.counts[parts], axis=0)])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        totals = ends[bounds[1:]] - ends[bounds[:-1]]
        made = dict(zip(("n_a", "n_b", "n_groups", "n_links"), totals.T.copy(), strict=True))
        made["groups_sha256"] = pa.array(digests, pa.string())
        for name, held, span, kind in (
            ("same", self.same_of, len(self.bytes_a), np.int32),
            ("pair", self.pair_of, len(self.bytes_a) * len(self.bytes_b), np.int64),
        ):
            count, values = held.take(parts)
            keys, times = np.unique(np.repeat(doc, count) * span + values, return_counts=True)
            made |= {name: lists(keys // span, keys % span, n, kind), f"{name}_times": lists(keys // span, times, n)}
        return made


class Ragged:
    """Lists of numbers, one after another."""

    def __init__(self):
        self.ends, self.values = array("q", [0]), array("q")

    def extend(self, counts: np.ndarray, values: np.ndarray) -> None:
        self.ends.frombytes((self.ends[-1] + np.cumsum(counts)).astype(np.int64).tobytes())
        self.values.frombytes(values.astype(np.int64).tobytes())

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and values of the chosen lists, in order."""
        ends, values = np.frombuffer(self.ends, np.int64), np.frombuffer(self.values, np.int64)
        start, count = ends[which], ends[which + 1] - ends[which]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        return count, values[at]


def lists(owner: np.ndarray, values: np.ndarray, n: int, kind: type = np.int32) -> pa.Array:
    """Arrow lists of the values of each of ``n`` owners; owners are sorted."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all values of an Arrow list column without nulls."""
    sizes = np.diff(np.asarray(column.offsets))
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy()


def encoded(docs: DataFrame, first: bytes, second: bytes) -> DataFrame:
    """One row per document: its counts and its links, added up per document."""
    files = docs.sparkSession.sparkContext.broadcast((first, second))  # vocabulary files of fixed size
    made: list[Aligner] = []

    def step(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(Aligner(*files.value))
        return {"doc_id": batch.column("doc_id").cast(pa.int64())} | made[0].align(batch.column("text").to_pylist())

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "same array<int>, same_times array<int>, pair array<long>, pair_times array<int>"
    )
    return map_text(docs, ["doc_id", "text"], schema, step)


def identity_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each identity pair, by A id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(flat(batch.column("same"))[1], minlength=size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["a", "n"])

    summed = rows.select("same").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)  # as many rows as ids at most
    counts[summed.column("a").to_numpy()] = summed.column("n").to_numpy()
    return counts


def frequent_from(pairs: DataFrame, bound: int) -> int:
    """Smallest power of two such that at most ``bound`` pairs have that count or more."""
    steps = F.floor(F.log2(F.col("n").cast("double")) + 1e-9).cast("int")
    held, power = 0, 62  # no count is that high
    for row in pairs.groupBy(steps.alias("power")).count().orderBy(F.desc("power")).collect():  # 63 rows at most
        held += row["count"]
        if held > bound:
            break
        power = row["power"]
    return 1 << power


def align_tokens(docs: DataFrame, first: str, second: str, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of docs (doc_id, text).

    ``first`` is the path of a byte-level BPE file, ``second`` of a piece model
    with byte fallback.  ``n_best`` counts the links whose pair has the highest
    count of all pairs with their A id, ``count_sum`` adds the counts up.
    """
    with open(first, "rb") as one, open(second, "rb") as two:
        files = one.read(), two.read()
    known = Aligner(*files)
    size_a, size_b = len(known.bytes_a), len(known.bytes_b)
    rows = saved(encoded(docs, *files).withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    pairs = saved(rows.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "alignment-pairs")
    counts = identity_counts(rows, size_a)
    best = counts.copy()
    highest = pairs.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("n")).toArrow()  # one row per A id at most
    np.maximum.at(best, highest.column("a").to_numpy(), highest.column("n").to_numpy())
    least = frequent_from(pairs, max_frequent)
    table = pairs.where(F.col("n") >= least).toArrow().sort_by("pair")  # max_frequent rows at most
    shared = docs.sparkSession.sparkContext.broadcast(
        (counts, best, table.column("pair").to_numpy(), table.column("n").to_numpy())
    )
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best, keys, held = shared.value
        for batch in batches:
            n = batch.num_rows
            owner, a = flat(batch.column("same"))
            times = flat(batch.column("same_times"))[1].astype(np.int64)
            total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, owner, times * counts[a])
            np.add.at(top, owner, times * (counts[a] == best[a]))
            owner, pair = flat(batch.column("pair"))
            times = flat(batch.column("pair_times"))[1].astype(np.int64)
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            found = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            count = held[at[found]]
            np.add.at(total, owner[found], times[found] * count)
            np.add.at(top, owner[found], times[found] * (count == best[pair[found] // size_b]))
            rest = lists(owner[~found], pair[~found], n, np.int64), lists(owner[~found], times[~found], n)
            columns = [*(batch.column(c) for c in plain), pa.array(top), pa.array(total), *rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*plain, "n_best", "count_sum", "pair", "pair_times"])

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long, "
        "n_best long, count_sum long, pair array<long>, pair_times array<int>"
    )
    scored = saved(rows.mapInArrow(score, schema), "alignment-scores")
    tops = docs.sparkSession.createDataFrame(pa.table({"a": np.arange(size_a), "best": best}))  # one row per A id
    rare = pairs.where(F.col("n") < least).withColumn("a", F.expr(f"pair div {size_b}")).join(F.broadcast(tops), "a")
    rest = (
        scored.select("row", F.explode(F.arrays_zip("pair", "pair_times")).alias("p"))
        .select("row", "p.pair", "p.pair_times")
        .join(rare, "pair")
        .groupBy(F.col("row").alias("_row"))
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("pair_times")).otherwise(0)).alias("_top"),
            F.sum(F.col("n") * F.col("pair_times")).alias("_sum"),
        )
    )
    whole = scored.drop("pair", "pair_times").join(rest, F.col("row") == F.col("_row"), "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_top", F.lit(0))).cast("long").alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).cast("long").alias("count_sum"), "groups_sha256",
    )
