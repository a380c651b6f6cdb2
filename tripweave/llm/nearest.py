"""Approximate nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is put into the leaf that it
reaches from the root.  A query walks the tree best bin first: a priority queue
holds the nodes by the inner product of query and centre, and the best one is
opened until enough leaves were visited.  How many are enough is calibrated:
for some queries the exact neighbours are found in blocks over all rows, and
visits are widened until the wanted share of these neighbours lies in visited
leaves.

Rows and queries meet by bucket, a run of neighbouring leaves of about ``block``
rows, so that a query brings back its ``k`` best of a bucket, not of every leaf.
A leaf beyond that is a bucket of its own, split by row; much-visited buckets
are split by query: no task holds more than about ``block`` rows and ``block``
queries.  Of equal vectors only the ``k + 1`` smallest ids can be among the
nearest, so no more take part; equal query vectors are searched for once.

Defined results: rows with null id, and vectors that are null, zero or hold a
null or non-finite component take no part, nor do vectors of another length
than most; a row repeated with id and vector counts once; with fewer than ``k``
candidates all are returned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import hash_sample, saved

SAMPLE_ROWS = 65_536  # size of the sample that the tree is fitted on, but for chance
LEAF_ROWS, MAX_LEAVES, BRANCHES = 256, 4_096, 8
CALIBRATION_QUERIES, WANTED_RECALL = 100, 0.95
BLOCK = 8_192


@dataclass
class Tree:
    """Nodes in flat arrays; node 0 is the root."""

    centres: np.ndarray
    children: list[np.ndarray]  # empty for a leaf
    leaf: np.ndarray  # number of the leaf, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest centre at every level."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            open_ = np.flatnonzero(self.leaf[node] < 0)
            if not len(open_):
                return self.leaf[node]
            for parent in np.unique(node[open_]):
                rows = open_[node[open_] == parent]
                node[rows] = self.children[parent][_closest(vectors[rows], self.centres[self.children[parent]])]

    def best_bins(self, query_dots: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a priority queue opens them; dots of the query with all centres are given."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
            for child in self.children[node]:
                heapq.heappush(heap, (-query_dots[child], int(child)))


def _closest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def _k_means(vectors: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = vectors[random.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        near = _closest(vectors, centres)
        for i in range(k):
            if (near == i).any():
                centres[i] = vectors[near == i].mean(axis=0)
    return centres


def fit_tree(sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Splits the largest leaf by k-means until there are enough leaves."""
    random = np.random.default_rng(seed)
    centres, children = [sample.mean(axis=0)], [np.zeros(0, np.int64)]
    heap = [(-len(sample), 0, np.arange(len(sample)))]
    made = 1
    while heap and made < leaves:
        _, node, members = heapq.heappop(heap)
        k = min(branches, len(members) // 2, leaves - made + 1)
        if k < 2:
            continue
        found = _k_means(sample[members], k, random)
        near = _closest(sample[members], found)
        used = np.unique(near)
        if len(used) < 2:
            continue
        children[node] = np.arange(len(centres), len(centres) + len(used))
        for i in used:
            centres.append(found[i])
            children.append(np.zeros(0, np.int64))
            heapq.heappush(heap, (-int((near == i).sum()), len(centres) - 1, members[near == i]))
        made += len(used) - 1
    is_leaf = np.array([len(c) == 0 for c in children])
    return Tree(np.array(centres), children, np.where(is_leaf, np.cumsum(is_leaf) - 1, -1))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct (id, vector) that take part in a search."""
    value = F.col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(F.col(key).cast("long").alias("id"), value.alias("vector")).where(
        F.col(key).isNotNull() & value.isNotNull() & ~bad & F.exists(value, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0)).distinct()


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _top(
    ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, k: int, allowed: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: its number, the ids of the k nearest (allowed) rows and their scores, ties to smaller ids."""
    products = queries @ vectors.T
    for q, row in enumerate(products):
        some = np.arange(len(row)) if allowed is None else np.flatnonzero(allowed[q])
        if len(some) > k:  # rounding must not decide between rows that score the same
            least = np.partition(row[some], -k)[-k]
            some = some[row[some] >= least - 1e-9 * (1 + abs(least))]
        exact = (vectors[some] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[some], -exact))[:k]
        yield q, ids[some][best], exact[best]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = W.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)


def exact_nearest(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """query, id, score, place: the true nearest of a few queries, in blocks over all rows (id, vector)."""
    numbers, matrix = np.array([q for q, _ in queries]), np.array([v for _, v in queries], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), batch.num_rows)
            for q, ids, scores in _top(batch.column("id").to_numpy(), vectors, matrix, k + 1) if batch.num_rows else ():
                other = ids != numbers[q]
                columns = [np.full(other.sum(), numbers[q]), ids[other], scores[other]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "id", "score"])

    return _ranked(rows.mapInArrow(run, "query long, id long, score double"), k)


def _with_leaf(rows: DataFrame, tree) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.place(_matrix(batch.column("vector"), batch.num_rows)) if batch.num_rows else np.zeros(0)
            yield batch.append_column("leaf", pa.array(leaf.astype(np.int32)))

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.select("id", "vector").mapInArrow(run, f"id long, vector {kind}, leaf int")


def leaf_buckets(sizes: np.ndarray, block: int) -> np.ndarray:
    """Bucket of each leaf: neighbouring leaves together as long as they hold at most ``block`` rows."""
    buckets, held, bucket = np.zeros(len(sizes), np.int64), 0, 0
    for leaf, size in enumerate(sizes):
        if held and held + size > block:
            held, bucket = 0, bucket + 1
        buckets[leaf] = bucket
        held += size
    return buckets


def _with_visits(
    queries: DataFrame, tree, sizes: np.ndarray, buckets: np.ndarray, visits: int, least: int
) -> DataFrame:
    """query, vector, bucket, leaves: what a query visits, by bucket; visits go on until ``least`` rows were seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                dots = _matrix(part.column("vector"), part.num_rows) @ tree.value.centres.T
                which, of, leaves = [], [], []
                for q in range(part.num_rows):
                    seen, visited = 0, {}
                    for n, leaf in enumerate(tree.value.best_bins(dots[q])):
                        if n >= visits and seen >= least:
                            break
                        if sizes[leaf]:
                            seen += sizes[leaf]
                            visited.setdefault(int(buckets[leaf]), []).append(leaf)
                    which += [q] * len(visited)
                    of += visited.keys()
                    leaves += visited.values()
                taken = part.take(pa.array(which, pa.int64()))
                taken = taken.append_column("bucket", pa.array(of, pa.int32()))
                yield taken.append_column("leaves", pa.array(leaves, pa.list_(pa.int32())))

    kind = queries.schema["vector"].dataType.simpleString()
    return queries.select("query", "vector").mapInArrow(run, f"query long, vector {kind}, bucket int, leaves array<int>")


def calibrate(tree: Tree, leaf_of: DataFrame, queries: list[tuple[int, list[float]]], k: int, wanted: float) -> int:
    """Smallest number of visited leaves that holds the wanted share of the exact neighbours of the queries."""
    exact = exact_nearest(leaf_of.select("id", "vector"), queries, k).select("query", "id")
    true = exact.join(leaf_of.select("id", "leaf"), "id").select("query", "leaf").toArrow()  # k rows per query
    order = {}
    for number, vector in queries:
        bins = tree.best_bins(np.array(vector, np.float64) @ tree.centres.T)
        order[number] = {leaf: n for n, leaf in enumerate(bins)}
    needed = sorted(order[q][leaf] + 1 for q, leaf in zip(*true.to_pydict().values(), strict=True))
    return needed[min(len(needed) - 1, int(np.ceil(wanted * len(needed))))] if needed else 1


def nearest(
    rows: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    wanted: float = WANTED_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest other rows of every row for which ``is_query`` (a condition on id)."""
    spark = rows.sparkSession
    all_rows = saved(usable(rows, key, vector), "nearest-rows")
    same = W.partitionBy("vector").orderBy("id")
    candidates = all_rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    candidates = saved(candidates, "nearest-candidates")
    asked = all_rows.where(is_query)
    reps = asked.groupBy("vector").agg(F.min("id").alias("query"))
    n = candidates.count()
    result = "query_id long, rank int, vec_id long, score double"
    if not n or asked.isEmpty():
        return spark.createDataFrame([], result)
    sample = hash_sample(candidates, "id", sample_rows).orderBy("id").select("vector").toArrow()
    points = _matrix(sample.column("vector"), sample.num_rows)
    tree = fit_tree(points, int(np.clip(n // LEAF_ROWS, 1, min(MAX_LEAVES, len(points) // 4 + 1))))
    shared = spark.sparkContext.broadcast(tree)  # MAX_LEAVES leaves at most
    placed = saved(_with_leaf(candidates, shared), "nearest-leaves")
    sizes = np.zeros(tree.leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # one row per leaf
        sizes[row["leaf"]] = row["count"]
    few = hash_sample(asked, "id", CALIBRATION_QUERIES).collect()
    visits = calibrate(tree, placed, [(r["id"], r["vector"]) for r in few], k, wanted) if few else 1
    buckets = leaf_buckets(sizes, block)
    visiting = saved(_with_visits(reps, shared, sizes, buckets, visits, k + 1), "nearest-visits")
    asked_of = {r["bucket"]: r["count"] for r in visiting.groupBy("bucket").count().collect()}  # one row per bucket
    rows_of = np.bincount(buckets, sizes)
    parts = [
        (leaf, int(b), int(-(-rows_of[b] // (2 * block))), int(-(-asked_of[b] // block)))
        for leaf, b in enumerate(buckets.tolist()) if b in asked_of
    ]
    plan = F.broadcast(spark.createDataFrame(parts, "leaf int, bucket int, row_parts int, query_parts int"))  # MAX_LEAVES rows at most
    left = placed.join(plan, "leaf").select(
        "bucket", F.expr("cast(pmod(xxhash64(id), row_parts) AS int)").alias("rp"),
        F.explode(F.expr("sequence(0, query_parts - 1)")).alias("qp"), "id", "vector", "leaf",
    )
    right = visiting.join(plan.select("bucket", "row_parts", "query_parts").distinct(), "bucket").select(
        "bucket", F.explode(F.expr("sequence(0, row_parts - 1)")).alias("rp"),
        F.expr("cast(pmod(xxhash64(query), query_parts) AS int)").alias("qp"), "query", "vector", "leaves",
    )

    def search(own: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if own.num_rows and queries.num_rows:
            vectors = _matrix(own.column("vector"), own.num_rows)
            numbers, ids = queries.column("query").to_numpy(), own.column("id").to_numpy()
            names, leaf = np.unique(own.column("leaf").to_numpy(), return_inverse=True)
            for start in range(0, len(numbers), 256):
                part = queries.slice(start, 256).combine_chunks()
                visited = np.array([np.isin(names, x) for x in part.column("leaves").to_pylist()])
                wanted_ = _matrix(part.column("vector"), part.num_rows)
                for q, found, scores in _top(ids, vectors, wanted_, k + 1, visited[:, leaf.reshape(-1)]):
                    values_of = (np.full(len(found), numbers[start + q]), found, scores)
                    for column, values in zip(out, values_of, strict=True):
                        column.append(values)
        arrays = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, float), strict=True)]
        return pa.table(dict(zip(("query", "id", "score"), arrays, strict=True)))

    keys = ["bucket", "rp", "qp"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query long, id long, score double")
    # one more than k, for the query itself is among the rows
    found = _ranked(found, k + 1).drop("place")
    members = asked.join(reps, "vector").select(F.col("id").alias("member"), F.col("query").alias("rep"))
    each = members.join(found, F.col("rep") == F.col("query")).where("member <> id")
    each = _ranked(each.select(F.col("member").alias("query"), "id", "score"), k)
    return each.select(
        F.col("query").alias("query_id"), F.col("place").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"
    )
