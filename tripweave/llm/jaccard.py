"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection.

A document is the set of its distinct word shingles; two documents link when
``100 * intersection >= percent * union``.

1. Documents with equal sets form a class; only the smallest id of each goes on.
2. Two linked sets differ in at most ``(100 - percent) / (100 + percent)`` of
   their summed sizes.  Sets are put into bands by size; in a band whose sets
   can differ in k shingles the hash space is cut into k + 1 + s ranges, of which
   two linked sets share 1 + s unchanged at least.  A set gives one signature per
   range that holds something, in its band and, near the edge, in the next one.
   Ranges that are empty tell nothing; only a set with more than s of them, which
   is rare by the choice of s, gives signatures for these too.  If all that two
   linked sets share is empty, both are such sets: no link is lost.
3. Signatures of one set only are settled at once; a bitmap of fixed size marks
   the others, and its false hits cost time only.  Sets that share a signature go
   to the tile of the smallest set hash there.
   In a tile a parity bitmap per set bounds the overlap of each pair from above
   by bit counts; pairs that pass are intersected as sorted arrays.  Pairs that
   are already connected need no test, since only groups are wanted.
4. Large tiles are split.  Where the parts do not all end up connected, the
   sets outside the largest group of the tile are tested against all others,
   block by block, so the split loses nothing.

Defined results: null and empty texts have an empty set, size 0, and are linked
with nothing; fewer words than a shingle are one shingle; equal texts are
linked; repeated ids are one node; a null id belongs to the group of its equal
texts, if one of these has an id, and links nothing itself; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import bitmap, components, map_text, marked, mix, saved, settled
from tripweave.llm.words import gram_hashes, words_of

SHINGLE, PERCENT = 3, 90
BAND_RATIO = 1.25  # width of a size band
TILE = 1_000  # sets that are compared with each other in one step
TILE_SHINGLES = 1_000_000  # and shingles that they hold
FILTER_BITS = 1 << 27


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = words_of(texts, "plain", lower=True)
    hashes = words.hashes()
    grams = gram_hashes(hashes, size)
    sets = []
    for first, count in zip(words.first[:-1].tolist(), words.counts.tolist(), strict=True):
        if count >= size:
            sets.append(np.unique(grams[first : first + count - size + 1]))
        else:
            sets.append(gram_hashes(hashes[first : first + count], count) if count else grams[:0])
    return sets


def set_hash(values: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set."""
    mixed = mix(values)
    return int(mixed.sum().view(np.int64)), int(mix(mixed).sum().view(np.int64))


@cache
def bands(percent: int, longest: int = 1 << 40) -> np.ndarray:
    """Largest set size of each band."""
    tops = [1]
    while tops[-1] < longest:  # a linked set is at most one band away
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_RATIO), tops[-1] * 100 // percent))
    return np.array(tops)


def most_different(total: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return total * (100 - percent) // (100 + percent)


def signatures(values: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of which any two linked sets that are not equal share at least one."""
    size = len(values)
    tops = bands(percent)
    own = int(np.searchsorted(tops, size))
    made = [np.zeros(0, np.uint64)]
    for band in (own, own + 1):
        if band > own and 100 * size < percent * (tops[own] + 1):
            break  # too small for any set of the next band
        differ = most_different(2 * int(tops[band]), percent)
        spare = 2 + differ // 50 if differ else 0  # linked sets of the lowest bands are equal
        parts = differ + 1 + spare
        cuts = (np.arange(1, parts, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts)
        edges = np.concatenate([[0], np.searchsorted(values >> np.uint64(32), cuts), [size]])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values))])
        held = mix(np.diff(sums[edges]) + mix(np.arange(parts, dtype=np.uint64) + (np.uint64(band + 1) << np.uint64(40))))
        filled = np.diff(edges) > 0
        made.append(held if parts - filled.sum() > spare else held[filled])
    return np.concatenate(made)


def parity_bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of bits per set: whether an odd number of its hashes falls on each.

    Two bitmaps differ in no more bits than the sets differ in hashes.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    spot = (mix(np.concatenate(sets)) & np.uint64(bits - 1)).astype(np.int64) if len(owner) else owner
    odd = np.bincount(owner * bits + spot, minlength=len(sets) * bits).reshape(len(sets), bits) & 1
    return np.packbits(odd.astype(bool), axis=1).view(np.uint64)


class Groups:
    """Connected groups of numbers."""

    def __init__(self, size: int):
        self.of = np.arange(size)

    def join(self, a: int, b: int) -> None:
        x, y = self.of[a], self.of[b]
        self.of[self.of == max(x, y)] = min(x, y)


def tile_links(
    sets: list[np.ndarray], percent: int, rest: int | None = None, owners: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect the sets of a tile as all links between them would, each to the first of its group.

    With ``rest``, only pairs of one of the first ``rest`` sets and one of the
    others are tested; sets of one owner count as connected.
    """
    if not sets:
        return []
    sizes = np.array([len(s) for s in sets])
    order = np.arange(len(sets)) if rest else np.argsort(sizes, kind="stable")
    least = 4 * most_different(2 * int(sizes.max()), percent)
    bits = max(256, 1 << int(least).bit_length())
    maps = np.concatenate([parity_bitmaps(sets[i : i + 64], bits) for i in range(0, len(sets), 64)])
    groups, links = Groups(len(sets)), []
    if owners is not None:
        groups.of = np.unique(owners, return_inverse=True)[1].reshape(-1)
    for n, i in enumerate(order[: rest or len(order)]):
        others = order[rest:] if rest else order[n + 1 :]
        others = others[(100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))]
        others = others[groups.of[others] != groups.of[i]]
        if not len(others):
            continue
        differ = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1)
        total = sizes[others] + sizes[i]
        overlap = (total - differ) // 2  # at most
        for j in others[100 * overlap >= percent * (total - overlap)]:
            if groups.of[i] == groups.of[j]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                groups.join(i, j)
                links.append((int(i), int(j)))
    if owners is None:
        return [(i, int(g)) for i, g in enumerate(groups.of) if i != g]
    return links


def _sets_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in column]


def _links(ids: np.ndarray, links: list[tuple[int, int]]) -> pa.Table:
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})


def jaccard_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) per row of docs (doc_id, text)."""

    def summary(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"), size)
        keys = np.array([set_hash(s) for s in sets], np.int64).reshape(-1, 2)
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "n": np.array([len(s) for s in sets], np.int64),
            "h": keys[:, 0],
            "h2": keys[:, 1],
        }

    def signed(batch: pa.RecordBatch, found: np.ndarray | None = None) -> dict:
        known, out, own = set(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for values in shingle_sets(batch.column("text"), size):
            key = set_hash(values)[0]
            if len(values) and key not in known:  # copies in one slice sign once
                known.add(key)
                made = signatures(values, percent)
                out.append(made if found is None else made[marked(found, made)])
                own.append(np.full(len(out[-1]), key))
        return {"sig": np.concatenate(out).view(np.int64), "h": np.concatenate(own)}

    def with_set(batch: pa.RecordBatch) -> dict | None:
        """Sets of the documents that a tile holds, and of a few others that no tile asks for."""
        some = marked(asked.value, batch.column("key").to_numpy().view(np.uint64)) & batch.column("doc_id").is_valid().to_numpy(False)
        if not some.any():
            return None
        batch = batch.filter(pa.array(some))
        sets = shingle_sets(batch.column("text"), size)
        return {
            "id": batch.column("doc_id").cast(pa.int64()),
            "values": pa.array([s.tobytes() for s in sets], pa.binary()),
        }

    rows = saved(map_text(docs, ["doc_id", "text"], "doc_id long, n long, h long, h2 long", summary), "jaccard-rows")
    classes = rows.where("n > 0").groupBy("h", "h2", "n").agg(F.min("doc_id").alias("rep"))
    # tiles: all sets of a signature meet at the smallest of them
    sigs = map_text(docs, ["doc_id", "text"], "sig long, h long", signed)
    shared = sigs.groupBy("sig").agg(F.min("h").alias("tile"), F.max("h").alias("most")).where("tile <> most")
    shared = saved(shared.select("sig", "tile"), "jaccard-shared")
    found = docs.sparkSession.sparkContext.broadcast(bitmap(shared.select(F.col("sig").alias("key")), FILTER_BITS))  # of fixed size
    some = map_text(docs, ["doc_id", "text"], "sig long, h long", lambda batch: signed(batch, found.value))
    met = some.join(shared, "sig").select("tile", "h").distinct()
    met = saved(met.union(met.select("tile", F.col("tile").alias("h"))).distinct(), "jaccard-tiles")
    members = met.join(classes.select("h", "n", F.col("rep").alias("id")), "h").where("id IS NOT NULL")
    members = members.groupBy("tile", "id").agg(F.max("n").alias("n"))
    parts = F.ceil(F.greatest(F.count("*") / tile, F.sum("n") / TILE_SHINGLES)).alias("parts")
    counts = members.groupBy("tile").agg(F.count("*").alias("sets"), parts).where("sets > 1").drop("sets")
    members = members.join(counts, "tile").select(
        "tile", "id", "n", F.expr("pmod(xxhash64(id), parts)").alias("part"), (F.col("parts") > 1).alias("split")
    )
    members = saved(members, "jaccard-members")
    wanted = members.select(F.xxhash64("id").alias("key")).distinct()
    asked = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, FILTER_BITS))  # of fixed size
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id"))
    sets = saved(map_text(keyed, ["doc_id", "text", "key"], "id long, values binary", with_set), "jaccard-sets")

    def within(group: pa.Table) -> pa.Table:
        return _links(group.column("id").to_numpy(), tile_links(_sets_of(group.column("values")), percent))

    near = members.join(sets, "id").groupBy("tile", "part").applyInArrow(within, "a long, b long")
    links = saved(near, "jaccard-links")
    large = members.where("split")
    if not large.isEmpty():
        known = components(links, "jaccard-first")
        links = links.union(_across(large, known, sets, percent, tile))
    labels = components(links, "jaccard-groups")
    grouped = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("h").alias("_h"), F.col("h2").alias("_h2"), F.col("n").alias("_n"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    same = (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2")) & (F.col("n") == F.col("_n"))
    return rows.join(grouped, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows of docs (doc_id, text, ...): one row of every group of linked texts, the one of smallest id.

    Rows are judged by their own texts: of rows that share an id, those whose
    texts are not linked all stay, and of repeated rows one.  A row without id
    stays unless it is linked with a row that has one; of equal texts without id one
    stays.  Rows without words all stay.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    numbered = saved(docs.select(doc, F.monotonically_increasing_id().alias("number")), "jaccard-documents")
    rows = numbered.select(F.col("number").alias("doc_id"), F.col("doc.text").alias("text"))
    ids = numbered.select(F.col("number").alias("node"), F.col("doc.doc_id").cast("long").alias("id"))

    def gone() -> DataFrame:
        """Rows are the nodes; all but the first row of a group by (no id, id, number) go."""
        groups = jaccard_groups(rows, size, percent).select(F.col("doc_id").alias("node"), "component_id")
        ranked = groups.join(ids, "node").withColumn("rank", F.struct(F.col("id").isNull().alias("bare"), "id", "node"))
        firsts = ranked.groupBy("component_id").agg(F.min_by("node", "rank").alias("node"))
        return groups.select("node").join(firsts.select("node"), "node", "left_anti")

    gone = settled(docs.sparkSession, "jaccard-gone", gone)
    found = docs.sparkSession.sparkContext.broadcast(bitmap(gone.select(F.xxhash64("node").alias("key")), FILTER_BITS))  # of fixed size

    @F.arrow_udf("boolean")
    def may_go(key: pa.Array) -> pa.Array:
        return pa.array(marked(found.value, key.to_numpy().view(np.uint64)))

    # only rows that the bitmap marks are moved to be looked up; the others stay where they are
    told = numbered.withColumn("may_go", may_go(F.xxhash64("number")))
    looked_up = told.where("may_go").join(gone, F.col("number") == F.col("node"), "left_anti")
    return told.where("NOT may_go").select("doc.*").union(looked_up.select("doc.*"))


def _across(large: DataFrame, known: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links between the parts of split tiles, as far as these are not connected yet."""
    owned = large.join(known, F.col("id") == F.col("node"), "left").select(
        "tile", "id", "n", F.coalesce("component", "id").alias("group")
    )
    weighed = owned.groupBy("tile", "group").agg(F.count("*").alias("sets"), F.sum("n").alias("n"))
    main = weighed.groupBy("tile").agg(
        F.max(F.struct("sets", "group", "n")).alias("top"), F.sum("sets").alias("sets"), F.sum("n").alias("n")
    )
    pieces = lambda sets, n: F.expr(f"ceil(greatest(({sets}) / {tile}, ({n}) / {TILE_SHINGLES}))")
    main = main.where("sets > top.sets").select(
        "tile", F.col("top.group").alias("main"), pieces("sets", "n").alias("blocks"),
        pieces("sets - top.sets", "n - top.n").alias("rests"),
    )
    open_ = owned.join(main, "tile")
    block = F.expr("pmod(xxhash64(id), blocks)")
    all_ = open_.select("tile", "id", "group", block.alias("block"), F.explode(F.expr("sequence(0, rests - 1)")).alias("rest"))
    outside = open_.where("group <> main").select(
        "tile", "id", "group", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.expr("pmod(xxhash64(id, 1), rests)").alias("rest"),
    )
    both = all_.withColumn("first", F.lit(False)).unionByName(outside.withColumn("first", F.lit(True)))

    def test(group: pa.Table) -> pa.Table:
        first = group.column("first").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
        ids, owners = group.column("id").to_numpy()[order], group.column("group").to_numpy()[order]
        values = _sets_of(group.column("values"))
        if first.all() or not first.any():
            return _links(ids, [])
        return _links(ids, tile_links([values[i] for i in order], percent, int(first.sum()), owners))

    return saved(both.join(sets, "id").groupBy("tile", "block", "rest").applyInArrow(test, "a long, b long"), "jaccard-across")


SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= {PERCENT} * (a.n + b.n - common)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
  least(w.doc_id, (SELECT min(y) FROM reach r WHERE r.x = w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id)"""
