"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

The statistics are computed once per document and written to the shared
folder.  Trees are fitted on the driver from a sample of labelled rows (about
``max_rows``, chosen by the hash of the id) outside the held-out fold, then
flattened into arrays; tasks walk all trees of a batch at once with numpy.

Defined results: null and empty texts have statistics 0 and are scored like any
other; several labels of one document count as the largest, null labels as
none; without any label every score is 0.5; repeated rows are scored each;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import hash_sample, held_out, map_text, saved
from tripweave.llm.words import words_of

MAX_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAF, SHRINK = 120, 4, 64, 0.1, 10, 1.0

# kinds of bytes: their shares are statistics
LETTER, UPPER, DIGIT, SPACE, LINE_END, OTHER, HIGH, FREE = range(8)
MARKS = "!#$%&'()*+,-./:;<=>?@[]_{|}"


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, OTHER)
    kinds[0x61:0x7B], kinds[0x41:0x5B], kinds[0x30:0x3A] = LETTER, UPPER, DIGIT
    kinds[0x20] = kinds[0x09] = SPACE
    kinds[0x0A], kinds[0x80:0xC0], kinds[0xC0:] = LINE_END, FREE, HIGH
    for i, mark in enumerate(MARKS):
        kinds[ord(mark)] = FREE + 1 + i
    return kinds


KINDS = byte_kinds()
KIND_COUNT = FREE + 1 + len(MARKS)
OTHERS = (
    "log_bytes", "log_words", "log_lines", "word_mean", "word_sd", "long_words", "distinct_words", "top_words",
    "distinct_lines", "repeated_line_bytes", "line_mean", "marked_words", "upper_words", "short_text",
)
WIDTH = KIND_COUNT + len(OTHERS)


def _distinct(owner: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: number of distinct hashes, largest count of one; and whether each occurrence is the first of its kind."""
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    begins = np.flatnonzero(new)
    runs = np.diff(np.append(begins, len(order)))
    most = np.zeros(texts)
    np.maximum.at(most, owner[order][begins], runs)
    first = np.zeros(len(order), bool)
    first[order[begins]] = True
    return np.bincount(owner[order][begins], minlength=texts), most, first


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` statistics per text."""
    n = len(texts)
    words = words_of(texts)
    size = np.diff(words.bounds).astype(float)
    owner = np.repeat(np.arange(n), np.diff(words.bounds))
    kinds = np.bincount(owner * KIND_COUNT + KINDS[words.data], minlength=n * KIND_COUNT).reshape(n, KIND_COUNT)
    count, word_owner = words.counts.astype(float), words.owner()
    length = (words.end - words.start).astype(float)
    one = np.maximum(count, 1)
    mean = np.bincount(word_owner, length, n) / one
    spread = np.sqrt(np.maximum(np.bincount(word_owner, length**2, n) / one - mean**2, 0))
    distinct, most, _ = _distinct(word_owner, words.hashes(), n)
    kind = KINDS[words.data]
    last = kind[words.end - 1] if len(words.end) else np.zeros(0, int)
    marked = np.bincount(word_owner, (last > FREE) | (last == OTHER), n) / one
    is_upper = np.concatenate([[0], np.cumsum(kind == UPPER)])
    upper = np.bincount(word_owner, (is_upper[words.end] - is_upper[words.start]) >= np.maximum(length - 2, 2), n) / one
    lines = words_of(texts, "lines")
    line_count, line_owner, line_size = lines.counts.astype(float), lines.owner(), lines.end - lines.start
    line_distinct, _, first = _distinct(line_owner, lines.hashes(), n)
    repeated = np.bincount(line_owner, line_size * ~first, n) / np.maximum(size, 1)
    line_one = np.maximum(line_count, 1)
    others = (
        np.log1p(size), np.log1p(count), np.log1p(line_count), mean, spread, np.bincount(word_owner, length > 20, n) / one,
        distinct / one, most / one, line_distinct / line_one, repeated, count / line_one, marked, upper, count < 5,
    )
    return np.column_stack([kinds / np.maximum(size, 1)[:, None], *others]).astype(np.float32)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of float) of every row of docs (doc_id, text)."""

    def step(batch: pa.RecordBatch) -> dict:
        stats = text_statistics(batch.column("text"))
        flat = pa.array(stats.reshape(-1), pa.float32())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1, dtype=np.int32) * WIDTH), flat)
        return {"doc_id": batch.column("doc_id").cast(pa.int64()), "stats": lists}

    return map_text(docs, ["doc_id", "text"], "doc_id long, stats array<float>", step)


@dataclass
class Trees:
    """All trees in flat arrays; node i of a tree has its children at left and left + 1, a leaf at itself."""

    roots: np.ndarray
    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        if not len(self.roots):
            return np.full(len(rows), 1 / (1 + np.exp(-self.base)))
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            left = self.left[node]
            node = np.where(left < 0, node, left + (rows[at, self.feature[node]] > self.bound[node]))
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE
) -> Trees:
    """Boosts trees on the logistic loss; splits are found in histograms of quantile bins."""
    n, width = rows.shape
    share = np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    if n < 2 * LEAF or labels.min() == labels.max():
        return Trees(*[np.zeros(0)] * 5, base, 0)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for c in rows.T]
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T, strict=True)])
    cell = binned + np.arange(width) * bins
    margin = np.full(n, base)
    roots, feature, bound, left, value = [], [], [], [], []

    def leaf(amount: float) -> int:
        for column, entry in ((feature, 0), (bound, 0.0), (left, -1), (value, amount)):
            column.append(entry)
        return len(value) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = labels - p, p * (1 - p)
        roots.append(leaf(0.0))
        level = [(roots[-1], np.arange(n))]
        for step in range(depth + 1):
            following = []
            for node, members in level:
                g, h = slope[members].sum(), curve[members].sum()
                split = None
                if step < depth and len(members) >= 2 * LEAF:
                    flat = cell[members].reshape(-1)
                    sums = [
                        np.bincount(flat, np.repeat(w, width), width * bins).reshape(width, bins).cumsum(axis=1)
                        for w in (slope[members], curve[members], np.ones(len(members)))
                    ]
                    gl, hl, nl = sums
                    gain = gl**2 / (hl + SHRINK) + (g - gl) ** 2 / (h - hl + SHRINK) - g**2 / (h + SHRINK)
                    gain[(nl < LEAF) | (len(members) - nl < LEAF)] = 0
                    where = int(gain.argmax())
                    if gain.flat[where] > 1e-6:
                        split = divmod(where, bins)
                if split is None:
                    amount = rate * g / (h + SHRINK)
                    value[node] = amount
                    margin[members] += amount
                    continue
                column, cut = split
                right = binned[members, column] > cut
                feature[node], bound[node] = column, float(cuts[column][min(cut, len(cuts[column]) - 1)])
                left[node] = leaf(0.0)
                other = leaf(0.0)
                following += [(left[node], members[~right]), (other, members[right])]
            level = following
    arrays = [np.array(x) for x in (roots, feature, bound, left, value)]
    return Trees(*arrays, base, depth)


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    """Trees from stats (doc_id, stats) and labels (doc_id, label) outside the held-out fold."""
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    rows = stats.join(hash_sample(marked, "doc_id", max_rows), "doc_id")
    found = rows.orderBy("doc_id").select("stats", "label").toArrow()  # about max_rows rows
    if not found.num_rows:
        return Trees(*[np.zeros(0)] * 5, 0.0, 0)
    flat = pc.list_flatten(found.column("stats")).to_numpy()
    return fit_trees(flat.reshape(-1, WIDTH).astype(np.float32), found.column("label").to_numpy())


def score(stats: DataFrame, trees: Trees, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every row of stats (doc_id, stats)."""
    shared = stats.sparkSession.sparkContext.broadcast(trees)  # TREES * 2 ** (DEPTH + 1) nodes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            made = shared.value.score(flat.reshape(-1, WIDTH))
            columns = [batch.column("doc_id"), pa.array(made), pa.array((made >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text)."""
    stats = saved(statistics(docs), "quality-statistics")
    made = score(stats, train(stats, labels, max_rows=max_rows), threshold)
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
