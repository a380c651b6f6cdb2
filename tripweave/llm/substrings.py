"""Substring dedup with automata of recurring phrases.

A window is a run of consecutive words of one document; a window goes if the
same words also start in a document with a smaller id.

1. Of each window one run of a few words, its anchor (the one of smallest hash),
   is picked; equal windows have equal anchors, and neighbouring windows mostly
   share one, so there is about one anchor for five words.
2. Anchors that occur in one document only are settled at once.  The others are
   marked in a bitmap of fixed size (``FILTER_BITS``); its false hits cost time
   only.  Anchors that occur more than ``HOT`` times are marked in a second one:
   their windows go on one by one, each under its own hash, so that no anchor
   brings an unbounded number of passages to one task.
3. Documents are streamed passage by passage: all windows around one remaining
   anchor.  Distinct passages, with the smallest and largest id they occur in,
   meet by anchor; a task sends the words of a passage once.  A task takes a
   shard of anchors at a time: it confirms the windows that recur, compiles the
   runs of them into an Aho-Corasick automaton over word numbers, and streams the
   passages through it to locate every occurrence.  Words outside the passages
   cannot recur, so they meet no automaton; each passage meets the one automaton
   that can hold its phrases, not all of them.
4. The runs found are joined to the places of their passages.  Only documents in
   which a place was found (a third bitmap) meet their places; all others are
   finished where they are read.

Defined results: null and empty texts have no words; texts shorter than a window
lose nothing; rows without id lose nothing and make no other row lose anything;
rows that share an id are judged each, against smaller ids; an empty table
gives no rows; other columns are carried in a struct and keep their names and
values.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.llm.common import bitmap, map_text, marked, mix, saved, settled
from tripweave.llm.words import gram_hashes, run_hashes, words_of

WINDOW, ANCHOR = 13, 5
FILTER_BITS = 1 << 27
HOT_BITS = 1 << 23
HOT = 8192  # places of an anchor above which its windows go on one by one
REMEMBERED = 1 << 20  # passages that a task remembers to have sent
SHARD_WORDS = 400_000  # words of passages in one automaton's shard


def text_marks(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number per text that tells texts of one id apart."""
    return (run_hashes(words, first[:-1], first[1:]) >> np.uint64(33)).astype(np.int32)


def anchors_of(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, text, first window, number of windows) of every run of windows that share an anchor.

    Windows are known by the index of their first word.
    """
    counts = np.diff(first)
    windows = np.maximum(counts - window + 1, 0)
    starts = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(first[:-1], windows)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    owner = np.repeat(np.arange(len(counts)), windows)
    grams = gram_hashes(hashes, anchor)
    spans = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
    place = spans[starts].argmin(axis=1) + starts
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    return grams[place[begins]], owner[begins], starts[begins], np.diff(np.append(begins, len(starts)))


def recurring_filters(docs: DataFrame, window: int, anchor: int, bits: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the anchors that occur in documents of different ids, and of those that occur more than ``hot`` times."""

    def step(batch: pa.RecordBatch) -> dict:
        words = words_of(batch.column("text"))
        keys, owner, _, _ = anchors_of(words.hashes(), words.first, window, anchor)
        ids = batch.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
        return {"anchor": keys.view(np.int64), "doc_id": ids[owner]}

    seen = map_text(docs, ["doc_id", "text"], "anchor long, doc_id long", step)
    again = seen.groupBy(F.col("anchor").alias("key")).agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")
    )
    again = saved(again.where("a < b").select("key", (F.col("n") > hot).alias("hot")), "substring-anchors")
    return bitmap(again.select("key"), bits), bitmap(again.where("hot").select("key"), min(bits, HOT_BITS))


def passage_keys(anchor: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """One number per passage, for bitmaps."""
    return mix(anchor.view(np.uint64) ^ mix(piece.view(np.uint64)))


def passages(
    docs: DataFrame, maps: tuple[np.ndarray, np.ndarray], window: int, anchor: int, known: np.ndarray | None = None
) -> DataFrame:
    """Passages of the anchors in the first bitmap: the windows that share an anchor, or single windows of hot anchors.

    Without ``known``: (anchor, piece, least, most, words), rows to be combined;
    ``piece`` is the hash of the words, which a task sends once, ``least`` and
    ``most`` bound the ids of documents that hold the passage.  With a bitmap
    ``known`` of passages: (anchor, piece, doc_id, mark, start) of their places.
    """
    shared = docs.sparkSession.sparkContext.broadcast((*maps, known))  # of fixed size
    sent = [np.zeros(0, np.uint64)]  # passages whose words this task has sent, sorted

    def some_of(batch: pa.RecordBatch) -> tuple:
        words = words_of(batch.column("text"))
        hashes = words.hashes()
        keys, owner, start, count = anchors_of(hashes, words.first, window, anchor)
        some = marked(shared.value[0], keys)
        keys, owner, start, count = keys[some], owner[some], start[some], count[some]
        hot = marked(shared.value[1], keys)
        each = np.where(hot, count, 1)  # passages of the anchor
        hot = np.repeat(hot, each)
        step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        keys, owner, start, count = np.repeat(keys, each), np.repeat(owner, each), np.repeat(start, each) + step, np.repeat(count, each)
        end = start + np.where(hot, 1, count) + window - 1
        if hot.any():
            keys = np.where(hot, gram_hashes(hashes, window)[np.where(hot, start, 0)], keys)
        ids = batch.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
        numbers = hashes >> np.uint64(32)
        columns = {
            "anchor": keys.view(np.int64),
            "piece": run_hashes(numbers, start, end).view(np.int64),
            "doc_id": ids[owner],
        }
        return columns, words.first, hashes, numbers.astype(np.uint32), owner, start, end

    def with_words(batch: pa.RecordBatch) -> dict:
        columns, _, _, numbers, _, start, end = some_of(batch)
        key, ids = (columns["anchor"], columns["piece"]), columns["doc_id"]
        order = np.lexsort((ids, *key[::-1]))
        first, last = _groups(*(k[order] for k in key))
        one = order[first]  # copies in one slice are one row
        own = passage_keys(key[0][one], key[1][one])
        at = np.minimum(np.searchsorted(sent[0], own), max(len(sent[0]) - 1, 0))
        fresh = sent[0][at] != own if len(sent[0]) else np.ones(len(own), bool)
        sent[0] = np.union1d(sent[0], own) if len(sent[0]) < REMEMBERED else np.unique(own)
        start, size = start[one], np.where(fresh, end[one] - start[one], 0)
        offsets = np.concatenate([[0], np.cumsum(size)])
        index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, size)
        buffers = [pa.array(fresh).buffers()[1], pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(numbers[index])]
        return {
            "anchor": key[0][one],
            "piece": key[1][one],
            "least": ids[one],
            "most": ids[order[last]],
            "words": pa.Array.from_buffers(pa.binary(), len(one), buffers),
        }

    def with_place(batch: pa.RecordBatch) -> dict:
        columns, first, hashes, _, owner, start, _ = some_of(batch)
        some = marked(shared.value[2], passage_keys(columns["anchor"], columns["piece"]))
        made = columns | {"mark": text_marks(hashes, first)[owner], "start": (start - first[owner]).astype(np.int32)}
        return {name: values[some] for name, values in made.items()}

    key = "anchor long, piece long"
    if known is None:
        return map_text(docs, ["doc_id", "text"], f"{key}, least long, most long, words binary", with_words)
    return map_text(docs, ["doc_id", "text"], f"{key}, doc_id long, mark int, start int", with_place)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first and of the last row of each group in sorted keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(new))[: len(first)] - 1


def locate(least: np.ndarray, most: np.ndarray, pieces: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(passage, first word, last word + 1, smallest document id) of all runs of recurring windows in a shard.

    ``pieces`` holds the words of distinct passages, ``least`` and ``most`` the
    smallest and largest id of the documents they occur in; all passages of an
    anchor are here.  Windows of a run occur in the same passages.
    """
    texts = [np.frombuffer(p, np.uint32) for p in pieces]
    sizes = np.array([len(t) for t in texts])
    flat = np.concatenate(texts)
    offsets = np.cumsum(sizes) - sizes
    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows - offsets, windows)
    keys = gram_hashes(mix(flat.astype(np.uint64) + np.uint64(1)), window)[at]
    # confirm: windows that occur in documents of different ids
    _, which = np.unique(keys, return_inverse=True)
    which = which.reshape(-1)
    low = np.full(which.max() + 1, np.iinfo(np.int64).max)
    high = np.full(len(low), np.iinfo(np.int64).min)
    np.minimum.at(low, which, least[owner])
    np.maximum.at(high, which, most[owner])
    again = (low < high)[which]
    together = np.zeros(len(low), np.uint64)
    np.add.at(together, which, mix(owner.astype(np.uint64) + np.uint64(1)))
    # runs of confirmed windows that occur in the same passages
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | ~again[:-1] | (together[which[1:]] != together[which[:-1]])
    begins = np.flatnonzero(new & again)
    if not len(begins):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    bounds = np.append(np.flatnonzero(new | ~again), len(owner))
    length = bounds[np.searchsorted(bounds, begins, side="right")] - begins
    _, one = np.unique(which[begins], return_index=True)
    # compile
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, begin, end in zip(
        one.tolist(), at[begins[one]].tolist(), (at[begins[one]] + length[one] + window - 1).tolist(), strict=True
    ):
        automaton.add_word(tuple(flat[begin:end].tolist()), number)
    automaton.make_automaton()
    # stream every passage that can hold one
    passage, ends, hits = [], [], []
    for i in np.unique(owner[begins]).tolist():
        for end, number in automaton.iter(tuple(texts[i].tolist())):
            passage.append(i)
            ends.append(end)
            hits.append(number)
    end, hit = np.array(ends, np.int64) + 1, np.array(hits, np.int64)
    return np.array(passage, np.int64), end - length[hit] - window + 1, end, low[which[begins[hit]]]


def find_repeats(pieces: DataFrame, window: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """anchor, piece, begin, end, first: runs of windows of a passage and the smallest id they occur in.

    ``pieces`` is (anchor, piece, least, most, words), any number of rows per
    passage, of which one at least has the words.
    """

    def shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        anchor, piece, least, most = (rows.column(c).to_numpy() for c in ("anchor", "piece", "least", "most"))
        bare = rows.column("words").is_null().to_numpy()
        order = np.lexsort((bare, piece, anchor))  # rows with words first
        starts, _ = _groups(anchor[order], piece[order])
        one = order[starts]
        bounds = np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts)
        passage, begin, end, low = locate(*bounds, rows.column("words").take(pa.array(one)).to_pylist(), window)
        own = [anchor[one][passage], piece[one][passage], begin.astype(np.int32), end.astype(np.int32), low]
        columns = [pa.array(c) for c in own]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "piece", "begin", "end", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            if size >= shard_words:  # go on to the end of the last anchor, then hand the shard over
                other = np.flatnonzero(anchor != held[-1].column("anchor")[-1].as_py())
                cut = int(other[0]) if len(other) else batch.num_rows
                held.append(batch.slice(0, cut))
                batch = batch.slice(cut)
                if batch.num_rows:
                    yield shard([h for h in held if h.num_rows])
                    held, size = [], 0
            if batch.num_rows:
                held.append(batch)
                size += batch.column("words").nbytes // 4
        if held:
            yield shard([h for h in held if h.num_rows])

    schema = "anchor long, piece long, begin int, end int, first long"
    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, schema)


def repeat_spans(docs: DataFrame, window: int, anchor: int, bits: int, hot: int) -> DataFrame:
    """doc_id, mark, start, end: runs of words of docs (doc_id, text) whose windows also start in a document of smaller id.

    ``mark`` tells the texts of one id apart.
    """
    maps = recurring_filters(docs, window, anchor, bits, hot)
    runs = saved(find_repeats(passages(docs, maps, window, anchor), window), "substring-runs")

    @F.arrow_udf("long")
    def key_of(anchors: pa.Array, pieces: pa.Array) -> pa.Array:
        return pa.array(passage_keys(anchors.to_numpy(), pieces.to_numpy()).view(np.int64))

    known = bitmap(runs.select("anchor", "piece").distinct().select(key_of("anchor", "piece").alias("key")), bits)
    return (
        passages(docs, maps, window, anchor, known)
        .join(runs, ["anchor", "piece"])
        .where("first < doc_id")
        .select("doc_id", "mark", (F.col("start") + F.col("begin")).alias("start"), (F.col("start") + F.col("end")).alias("end"))
    )


def judge_repeats(
    docs: DataFrame, whole: bool, window: int = WINDOW, anchor: int = ANCHOR, bits: int = FILTER_BITS, hot: int = HOT
) -> DataFrame:
    """row (a struct of all columns of a row of docs but its text), n_words, n_removed, kept.

    ``kept`` holds the words that stay, joined by a blank; with ``whole``, a text
    that loses nothing is kept as it is, null too.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*rest).alias("row"))
    texts = rows.select("doc_id", "text").where("doc_id IS NOT NULL")
    spans = settled(docs.sparkSession, "substring-spans", lambda: repeat_spans(texts, window, anchor, bits, hot))
    losing = docs.sparkSession.sparkContext.broadcast(  # of fixed size
        bitmap(spans.select(F.col("doc_id").alias("id")).distinct().select(F.xxhash64("id").alias("key")), bits)
    )

    @F.arrow_udf("boolean")
    def may_lose(key: pa.Array) -> pa.Array:
        return pa.array(marked(losing.value, key.to_numpy().view(np.uint64)))

    listed = spans.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("mark", "start", "end")).alias("spans"))
    some = rows.where(may_lose(F.xxhash64("doc_id"))).join(listed, F.col("doc_id") == F.col("_doc"), "left")
    schema = StructType([rows.schema["row"]]).add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def others(batch: pa.RecordBatch) -> dict | None:
        """Documents that lose nothing, finished where they are read."""
        stay = ~marked(losing.value, batch.column("key").to_numpy().view(np.uint64))
        return step(batch.filter(pa.array(stay))) if stay.any() else None

    def step(batch: pa.RecordBatch) -> dict:
        words = words_of(batch.column("text"))
        marks = None
        kept, removed = [], np.zeros(batch.num_rows, np.int64)
        spans = batch.column("spans") if "spans" in batch.schema.names else pa.nulls(batch.num_rows)
        for i, text in enumerate(batch.column("text")):
            text = text.as_py()
            own = stay = None
            if spans[i].is_valid:
                if marks is None:
                    marks = text_marks(words.hashes(), words.first)
                own = (text or "").encode().split()
                stay = np.ones(len(own), bool)
                for span in spans[i].as_py():
                    if span["mark"] == marks[i]:
                        stay[span["start"] : span["end"]] = False
                removed[i] = len(own) - stay.sum()
            if whole and not removed[i]:
                kept.append(text)
                continue
            own = (text or "").encode().split() if own is None else own
            kept.append(b" ".join(compress(own, stay) if removed[i] else own).decode())
        return {"row": batch.column("row"), "n_words": words.counts.astype(np.int64), "n_removed": removed, "kept": pa.array(kept, pa.string())}

    keyed = rows.select("text", "row", F.xxhash64("doc_id").alias("key"))
    return map_text(some, ["text", "row", "spans"], schema, step).union(map_text(keyed, ["text", "row", "key"], schema, others))


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by a blank) per row of docs (doc_id, text)."""
    judged = judge_repeats(docs.select("doc_id", "text"), False, **options)
    return judged.select("row.doc_id", "n_words", "n_removed", "kept")


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs (doc_id, text, ...) without the words that earlier documents hold; texts that lose nothing stay as they are.

    ``n_chars``, where docs has it, is the length of a text that changed.
    """
    judged = judge_repeats(docs, True, **options)
    made = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
        made["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return judged.select(*(made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})),
firsts AS (SELECT key, min(doc_id) AS first FROM places GROUP BY key),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS word
  FROM places JOIN firsts USING (key) WHERE first < doc_id),
each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT e.doc_id, count(*) FILTER (WHERE g.word IS NOT NULL) AS n_removed,
    string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.word IS NULL) AS kept
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.word = e.i GROUP BY e.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)"""
