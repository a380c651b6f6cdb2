"""Benchmark decontamination with suffix arrays over the training texts.

Every slice of documents is a shard: its words become numbers of the benchmark
vocabulary, and a suffix array sorts the positions at which a benchmark suffix
can begin.  Every benchmark suffix is binary-searched in every shard; the
interval found holds all places of its window, and neighbouring places on one
diagonal join into the longest verbatim matches.  Only places where no suffix
can match (no two adjacent benchmark words) are left out of the arrays.

A benchmark of up to ``small`` bytes goes to all tasks as suffixes.  A larger one
stays on the cluster: its windows are a table of hashes, a bitmap of fixed size
tells which places of the documents can match, and these places, few of all, are
joined to the windows by hash; neighbours join into the same longest matches.
Both ways give equal results, and the words hit and the items of a document are
those of its longest matches.

Defined results: null and empty texts have no words and no hits; an item
without words has no window, an item shorter than a window is one window;
repeated items and items without id hit words, an id is listed once, a null id
not at all; repeated rows of documents are judged each; an empty benchmark hits
nothing; other columns are ignored, and ``decontaminate`` judges each row by its
own text and carries all its columns.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import bitmap, map_text, marked, saved, settled, text_steps
from tripweave.llm.words import run_hashes, words_of

WINDOW = 13
SMALL = 1 << 20  # bytes of benchmark text that go to all tasks; about 170 times as much memory of the driver
FILTER_BITS = 1 << 27


@dataclass
class Suffixes:
    """All benchmark windows: rows of word numbers, one row per distinct window, and the items they occur in."""

    vocabulary: np.ndarray  # sorted word hashes; word number is the index + 1
    pairs: np.ndarray  # sorted codes of adjacent words inside windows
    singles: np.ndarray  # words that are an item of their own
    windows: dict[int, np.ndarray]  # by length
    items: dict[int, list[list[str]]]  # ids as text, by length and window
    starts: dict[int, list[list[tuple[str, int]]]]  # (item, word) at which a window begins
    window: int


def read_benchmark(benchmark: DataFrame, window: int = WINDOW) -> Suffixes:
    """Windows of a small benchmark (item_id, text)."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text").toArrow()
    words = words_of(rows.column("text"), "alnum", lower=True)
    hashes = words.hashes()
    vocabulary = np.unique(hashes)
    number = np.searchsorted(vocabulary, hashes) + 1
    found: dict[int, dict[tuple, list]] = {}
    for i, item in enumerate(rows.column("item_id").to_pylist()):
        own = number[words.first[i] : words.first[i + 1]]
        length = min(window, len(own))
        for at in range(len(own) - length + 1 if length else 0):
            found.setdefault(length, {}).setdefault(tuple(own[at : at + length]), []).append((item, at))
    windows = {n: np.array(sorted(f), np.int64).reshape(-1, n) for n, f in found.items()}
    starts = {n: [list(dict.fromkeys(found[n][tuple(w)])) for w in windows[n]] for n in found}
    items = {n: [sorted({i for i, _ in s if i is not None}) for s in starts[n]] for n in found}
    base = len(vocabulary) + 2
    pairs = [w[:, 0] * base + w[:, 1] for n, w in windows.items() if n > 1]
    singles = windows[1][:, 0] if 1 in windows else np.zeros(0, np.int64)
    return Suffixes(vocabulary, np.unique(np.concatenate(pairs)) if pairs else singles[:0], singles, windows, items, starts, window)


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(wanted), bool)
    return values[np.minimum(np.searchsorted(values, wanted), len(values) - 1)] == wanted


def _packed(rows: np.ndarray, base: int) -> np.ndarray:
    """Rows of word numbers as few 63-bit numbers that sort alike."""
    per = max(1, int(63 // np.log2(base)))
    columns = []
    for start in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for column in rows[:, start : start + per].T:
            key = key * base + column
        columns.append(key)
    return np.column_stack(columns)


def _bounds(array: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of each key (row) in the sorted rows: first place not below it, first place above it."""
    found = []
    for above in (False, True):
        low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(array))
        while (low < high).any():
            mid = (low + high) // 2
            probe = array[np.minimum(mid, len(array) - 1)]
            less, open_ = np.zeros(len(keys), bool), np.ones(len(keys), bool)
            for a, b in zip(probe.T, keys.T, strict=True):
                less |= open_ & (a < b)
                open_ &= a == b
            go = (less | open_ if above else less) & (low < high)
            low, high = np.where(go, mid + 1, low), np.where(go | (low >= high), high, mid)
        found.append(low)
    return found[0], found[1]


def shard_matches(known: Suffixes, number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, window length, window) of every occurrence of a window in a shard of word numbers.

    ``first`` holds the index of the first word of each document.
    """
    none = np.zeros(0, np.int64)
    if not known.windows or not len(number):
        return none, none, none
    base = len(known.vocabulary) + 2
    ends = np.append(number, 0)
    following = ends[1:].copy()
    last = first[1:][np.diff(first) > 0] - 1
    following[last] = 0
    begins = (number > 0) & (_among(known.pairs, number * base + following) | _among(np.sort(known.singles), number))
    places = np.flatnonzero(begins)
    if not len(places):
        return none, none, none
    # suffixes, as far as a window reaches; 0 beyond the end of the document
    width = max(known.windows)
    limit = np.repeat(first[1:], np.diff(first))[places]
    index = places[:, None] + np.arange(width)
    suffixes = np.where(index < limit[:, None], ends[np.minimum(index, len(number))], 0)
    out = []
    for length, windows in known.windows.items():
        keys = _packed(suffixes[:, :length], base)
        array = np.lexsort(keys.T[::-1])
        low, high = _bounds(keys[array], _packed(windows, base))
        counts = high - low
        which = np.repeat(np.arange(len(windows)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        out.append((places[array[at]], np.full(len(which), length), which))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _numbers(known: Suffixes, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts, "alnum", lower=True)
    hashes = words.hashes()
    at = np.minimum(np.searchsorted(known.vocabulary, hashes), max(len(known.vocabulary) - 1, 0))
    inside = known.vocabulary[at] == hashes if len(known.vocabulary) else np.zeros(len(hashes), bool)
    return np.where(inside, at + 1, 0), words.first


def shard_runs(known: Suffixes, texts: pa.Array) -> tuple[np.ndarray, list[tuple]]:
    """First word of each text (and the end), and the longest matches in a shard: (text, item, place, word of the item, words)."""
    number, first = _numbers(known, texts)
    open_: dict[tuple, list] = {}
    made = []
    for place, length, which in sorted(zip(*(x.tolist() for x in shard_matches(known, number, first)), strict=True)):
        doc = int(np.searchsorted(first, place, side="right")) - 1
        for item, at in known.starts[length][which]:
            run = open_.get((doc, item, place - at, length))
            if run and run[0] + run[2] - length == place - 1:
                run[2] += 1
            else:
                run = open_[doc, item, place - at, length] = [place, at, length]
                made.append((doc, item, run))
    return first, [(doc, item, *run) for doc, item, run in made]


def shard_report(known: Suffixes, texts: pa.Array, share: int) -> dict:
    """Per text: number of words, words hit, items, contaminated."""
    first, runs = shard_runs(known, texts)
    change = np.zeros(first[-1] + 1, np.int64)
    items: dict[int, set[str]] = {}
    for doc, item, place, _, size in runs:
        change[place] += 1
        change[place + size] -= 1
        if item is not None:
            items.setdefault(doc, set()).add(item)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    n_words, n_hit = np.diff(first).astype(np.int64), (hit[first[1:]] - hit[first[:-1]]).astype(np.int64)
    lists = [sorted(items.get(i, ())) for i in range(len(n_words))]
    return {"n_words": n_words, "n_hit": n_hit, "items": lists, "contaminated": (n_hit > 0) & (share * n_hit >= n_words)}


def is_small(benchmark: DataFrame, small: int) -> bool:
    return (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= small


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, length, key, at: the hash of every window of every item and the word at which it begins."""

    def step(batch: pa.RecordBatch) -> dict:
        words = words_of(batch.column("text"), "alnum", lower=True)
        size = np.minimum(words.counts, window)
        count = np.where(size > 0, words.counts - size + 1, 0)
        owner = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = words.first[owner] + at
        keys = run_hashes(words.hashes(), start, start + size[owner])
        return {
            "item_id": batch.column("item_id").take(pa.array(owner)), "length": size[owner].astype(np.int32),
            "key": keys.view(np.int64), "at": at.astype(np.int64),
        }

    read = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return saved(map_text(read, ["item_id", "text"], "item_id string, length int, key long, at long", step), "benchmark-windows")


def joined_runs(rows: DataFrame, benchmark: DataFrame, window: int, bits: int = FILTER_BITS) -> DataFrame:
    """number, item_id, doc_word, item_word, n_words: the longest matches in rows (number, text) of a benchmark of any size.

    One more row per document, of length 0, has its number of words as ``n_words``.
    """
    windows = benchmark_windows(benchmark, window)
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # as many as a window has words
    known = rows.sparkSession.sparkContext.broadcast(bitmap(windows.select("key").distinct(), bits))  # of fixed size

    def step(batch: pa.RecordBatch) -> dict:
        words = words_of(batch.column("text"), "alnum", lower=True)
        hashes, counts, numbers = words.hashes(), words.counts, batch.column("number").to_numpy()
        made = [(numbers, np.full(len(numbers), -1), np.zeros(len(numbers), np.int64), counts)]
        for length in lengths:
            count = np.maximum(counts - length + 1, 0)
            owner = np.repeat(np.arange(len(count)), count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = words.first[owner] + place
            keys = run_hashes(hashes, start, start + length)
            some = marked(known.value, keys)
            made.append((numbers[owner[some]], place[some], np.full(some.sum(), length), keys[some].view(np.int64)))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*made, strict=True)]
        return dict(zip(("number", "place", "length", "key"), columns, strict=True))

    places = saved(map_text(rows, ["number", "text"], "number long, place long, length long, key long", step), "benchmark-places")
    met = places.where("length > 0").join(windows.withColumn("length", F.col("length").cast("long")), ["length", "key"])
    met = met.select("number", "item_id", "place", "at", "length", (F.col("place") - F.col("at")).alias("_line")).distinct()
    order = W.partitionBy("number", "item_id", "_line", "length").orderBy("place")
    runs = met.withColumn("_run", F.col("place") - F.row_number().over(order)).groupBy(
        "number", "item_id", "_line", "length", "_run"
    ).agg(
        F.min("place").alias("doc_word"), F.min("at").alias("item_word"), (F.max("place") + F.col("length") - F.min("place")).alias("n_words")
    )
    sizes = places.where("length = 0").select(
        "number", F.lit(None).cast("string").alias("item_id"), F.lit(-1).cast("long").alias("doc_word"),
        F.lit(-1).cast("long").alias("item_word"), F.col("key").alias("n_words"),
    )
    return runs.select("number", "item_id", "doc_word", "item_word", "n_words").union(sizes)


def joined_report(rows: DataFrame, benchmark: DataFrame, window: int, share: int) -> DataFrame:
    """number, n_words, n_hit, items, contaminated of rows (number, text)."""
    found = F.col("doc_word") >= 0
    report = joined_runs(rows, benchmark, window).groupBy("number").agg(
        F.max(F.when(~found, F.col("n_words"))).alias("n_words"),
        F.sort_array(F.collect_set(F.when(found, F.struct(F.col("doc_word").alias("at"), (F.col("doc_word") + F.col("n_words")).alias("end"))))).alias("runs"),
        F.sort_array(F.collect_set(F.when(found, F.col("item_id")))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))

    def add(state: Column, run: Column) -> Column:
        fresh = F.greatest(run["end"] - F.greatest(run["at"], state["end"]), F.lit(0).cast("long"))
        return F.struct((state["hit"] + fresh).alias("hit"), F.greatest(state["end"], run["end"]).alias("end"))

    hit = F.aggregate("runs", start, add, lambda state: state["hit"])
    told = report.select("number", "n_words", hit.alias("n_hit"), "items")
    return told.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def _numbered(docs: DataFrame) -> DataFrame:
    """doc (a struct of all columns), text, number of every row."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return saved(docs.select(doc, F.monotonically_increasing_id().alias("number")), "benchmark-documents").select(
        "doc", F.col("doc.text").alias("text"), "number"
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, small: int = SMALL
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of docs (doc_id, text).

    A document is contaminated if at least one ``share``-th of its words is hit.
    """
    if not is_small(benchmark, small):
        rows = _numbered(docs.select("doc_id", "text"))
        report = rows.select("doc", "number").join(joined_report(rows, benchmark, window, share), "number")
        return report.select(
            F.col("doc.doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        )
    known = docs.sparkSession.sparkContext.broadcast(read_benchmark(benchmark, window))  # size checked

    def step(batch: pa.RecordBatch) -> dict:
        made = shard_report(known.value, batch.column("text"), share)
        lists = made.pop("items")
        return made | {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "n_items": np.array([len(x) for x in lists], np.int64),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string()),
        }

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return map_text(docs, ["doc_id", "text"], schema, step)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, small: int = SMALL) -> DataFrame:
    """doc_id, item_id, doc_word, item_word, n_words: the maximal verbatim matches of at least a window.

    Occurrences of neighbouring windows at neighbouring places are one match;
    items that share an id are one item, but for windows of different lengths.
    """
    if not is_small(benchmark, small):
        rows = _numbered(docs.select("doc_id", "text"))
        runs = joined_runs(rows, benchmark, window).where("doc_word >= 0")
        ids = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "number")
        return ids.join(runs, "number").drop("number")
    known = docs.sparkSession.sparkContext.broadcast(read_benchmark(benchmark, window))  # size checked

    def step(batch: pa.RecordBatch) -> dict | None:
        first, runs = shard_runs(known.value, batch.column("text"))
        if not runs:
            return None
        doc, item, place, at, size = zip(*runs, strict=True)
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)), "item_id": pa.array(item, pa.string()),
            "doc_word": np.array(place) - first[np.array(doc)], "item_word": np.array(at, np.int64), "n_words": np.array(size, np.int64),
        }

    schema = "doc_id long, item_id string, doc_word long, item_word long, n_words long"
    return map_text(docs, ["doc_id", "text"], schema, step)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, small: int = SMALL
) -> DataFrame:
    """Rows of docs (doc_id, text, ...) that are not contaminated, each judged by its own text."""
    if not is_small(benchmark, small):
        rows = _numbered(docs)
        bad = settled(
            docs.sparkSession, "contaminated",
            lambda: joined_report(rows, benchmark, window, share).where("contaminated").select("number"),
        )
        return rows.select("doc", "number").join(bad, "number", "left_anti").select("doc.*")
    known = docs.sparkSession.sparkContext.broadcast(read_benchmark(benchmark, window))  # size checked

    @F.arrow_udf("boolean")
    def contaminated(texts: pa.Array) -> pa.Array:
        parts = text_steps(pa.RecordBatch.from_arrays([texts], names=["text"]))
        made = [shard_report(known.value, part.column("text"), share)["contaminated"] for part in parts]
        return pa.array(np.concatenate(made) if made else np.zeros(0, bool))

    return docs.where(~contaminated(F.col("text")))


SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n,
    unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, t.item_id FROM places p JOIN windows t ON t.n = p.n AND t.key = p.key),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
  coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.ids, '')) AS items_sha256,
  (coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(w.w)) AS contaminated
FROM words w LEFT JOIN covered c USING (doc_id) LEFT JOIN listed l USING (doc_id)"""
