"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, passed through up
to ``max_repeats`` times.  A document's virtual finish time is the running
number of words of its source, itself included, over the target of the source.
All queues are merged by finish time and the mix ends where the total budget
(all words of the input) is reached: the cut takes a document if at least half
of it lies before the end of the budget.

Running totals never pass one key through one task: rows are ranged over
slices, slices are summed, and only the sums (one row per slice) are
accumulated by a window.

Defined results: null texts have size 0; documents of size 0 are taken 0 words;
the null source is a source of its own, last in order; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored
by ``mix_sources`` and carried along by ``mix_documents``, where a result whose
name a document's column has is called ``mix_`` and its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import plain_words, saved, settled

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SLICE_BITS = 12  # slices per source and of the merged queue; a slice is one task's share of a running total


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target of every source, over (source, size).

    Targets are ``level * weight``, stopped at ``max_repeats`` times the size;
    the level is the one at which all targets add up to the total size.  One
    row per source is all that meets in the windows here.
    """
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = (F.row_number().over(ordered) - 1) % len(weights)
    weighed = sources.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * max_repeats).alias("most"),
    )
    full = (F.col("most").cast("double") / F.col("weight")).alias("full_at")
    filling = W.orderBy(F.col("full_at"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    after = filling.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(0))
    levels = weighed.withColumn("full_at", full).select(
        "*",
        (
            (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
            / F.sum("weight").over(after)
        ).alias("level"),
    )
    # the first source in filling order that its level does not fill sets the level of all
    found = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(whole)["level"]
    return levels.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("most").cast("double"), found * F.col("weight")), F.lit(0.0)).alias("target"),
    )


def running_total(rows: DataFrame, keys: list[str], part: str, order: list, amount: str, name: str) -> DataFrame:
    """Adds the total of ``amount`` up to and including each row, per key, in the order of ``part`` then ``order``."""
    own = W.partitionBy(*keys, part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.groupBy(*keys, part).agg(F.sum(amount).alias("_sum"))
    earlier = W.partitionBy(*(keys or [F.lit(0)])).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select(
        *[F.col(k).alias(f"_{k}") for k in [*keys, part]],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, part]]
    condition = same[0]
    for c in same[1:]:
        condition &= c
    return (
        rows.withColumn("_own", F.sum(amount).over(own))
        .join(carry, condition)
        .withColumn(name, F.col("_own") + F.col("_carry"))
        .drop("_own", "_carry", *[f"_{k}" for k in [*keys, part]])
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = ""
) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken per document of docs (doc_id, text, source).

    The order of a queue is that of md5(seed, doc_id), so reruns agree.
    """
    sizes = docs.select("doc_id", "source", plain_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row"))
    return _mixed(saved(sizes, "mix-sizes"), weights, max_repeats, seed).drop("row")


def mix_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = ""
) -> DataFrame:
    """Rows of docs (doc_id, text, source, ...) that the mix takes, with size, source_size, target, copies, taken."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    numbered = docs.select(doc, plain_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row"))
    numbered = saved(numbered, "mix-documents")
    sizes = numbered.select("doc.doc_id", "doc.source", "size", "row")
    mixed = settled(docs.sparkSession, "mix-taken", lambda: _mixed(sizes, weights, max_repeats, seed).where("copies > 0"))
    taken, used = [], {c.lower() for c in docs.columns}
    for name in ("size", "source_size", "target", "copies", "taken"):
        free = name
        while free.lower() in used:
            free = f"mix_{free}"
        used.add(free.lower())
        taken.append(F.col(name).alias(free))
    return numbered.select("doc", "row").join(mixed, "row").select("doc.*", *taken)


def _mixed(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int, seed: str) -> DataFrame:
    """row and the columns of ``mix_sources`` per row of sizes (doc_id, source, size, row); ``row`` tells repeated rows apart."""
    targets = source_targets(sizes, weights, max_repeats)
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    queued = (
        sizes.withColumn("shuffle", key)
        .withColumn("slice", F.conv(F.substring("shuffle", 1, SLICE_BITS // 4), 16, 10).cast("int"))
        .join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
    )
    order = [F.col("shuffle"), F.col("size"), F.col("row")]
    queued = saved(running_total(queued, ["source"], "slice", order, "size", "so_far"), "mix-queues")
    finish = (F.col("pass") * F.col("source_size") + F.col("so_far")) / F.col("target")
    merged = (
        queued.where("size > 0 AND target > 0")
        .select("row", "shuffle", "size", "source_size", "so_far", "target",
                F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("pass"))
        .withColumn("finish", finish)
        .withColumn("slice", F.floor(F.col("finish") * (1 << SLICE_BITS)))
    )
    merged = running_total(merged, [], "slice", [F.col("finish"), *order], "size", "mixed")
    budget = sizes.agg(F.sum("size")).first()[0] or 0  # one number
    copies = (
        merged.where(F.col("mixed") * 2 - F.col("size") <= 2 * budget)
        .groupBy(F.col("row").alias("_row"))
        .agg(F.count("*").alias("copies"))
    )
    copied = F.coalesce("copies", F.lit(0)).cast("long")
    return queued.join(copies, F.col("row") == F.col("_row"), "left").select(
        "row", "doc_id", "size", "source", "source_size", "target",
        copied.alias("copies"), (copied * F.col("size")).alias("taken"),
    )


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS shuffle FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, source_size * {MAX_REPEATS} AS most,
    ([{", ".join(map(str, WEIGHTS))}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM sources),
levels AS (
  SELECT *, most::DOUBLE / weight AS full_at,
    (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(most::DOUBLE, weight * (
    SELECT level FROM levels WHERE level <= full_at ORDER BY full_at, level LIMIT 1)) AS target FROM levels),
queued AS (
  SELECT s.*, t.source_size, t.target, sum(size) OVER (PARTITION BY s.source ORDER BY shuffle, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
merged AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY (pass * source_size + so_far)::DOUBLE / target, shuffle, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mixed
  FROM queued, (SELECT unnest(range({MAX_REPEATS})) AS pass) WHERE size > 0 AND target > 0),
taken AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM merged
  WHERE mixed * 2 - size <= 2 * (SELECT sum(size) FROM sizes) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id"""
