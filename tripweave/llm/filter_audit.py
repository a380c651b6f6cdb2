"""Filter interaction audit: what five filters remove in every order, and their Shapley values.

Every document is one row of five failure bits.  Counts of the 32 patterns per
part hold all that is asked: ``v(S)``, the documents that the coalition S of
filters removes, are those whose pattern meets S.

* The step of an order that applies filter i after the filters S removes
  ``v(S + i) - v(S)``; the other counts are differences of the same tables,
  over all documents, the good ones and the toxic ones.
* Shapley values come from the weighted least squares problem over coalitions:
  the kernel weights a coalition of s out of n filters with
  ``(n - 1) / (C(n, s) * s * (n - s))``, the values must add up to ``v(all)``,
  and the normal equations with that constraint are solved in rationals.

Filters: A too few words, B too few distinct words, C too many capitals, D a
symbol, E the text of a document with a smaller id.

E needs no group of copies in one place: the smallest id per digest of the text
is combined before the shuffle, and rows meet it by digest and id together, so
copies of one text spread over all tasks.

Defined results: a null text is empty; a null source is the part ''; rows
without id fail E never, make no other row fail it, and have no label; rows that
share id and text pass E if no smaller id has the text; repeated labels count
once, a document is good (toxic) if any of its labels says so; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import saved

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#$%&*|]"


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails A, B, C and D."""
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def judged(docs: DataFrame) -> DataFrame:
    """part, doc_id, mask (bit i: the document fails filter i) of every row of docs (doc_id, text, source)."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source")
    tests = failures(F.col("text"))
    bits = sum(F.when(tests[f], 1 << i).otherwise(0) for i, f in enumerate("ABCD"))
    rows = saved(
        read.select(
            F.coalesce("source", F.lit("")).alias("part"), "doc_id", bits.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")
        ),
        "audit-rows",
    )
    with_id = rows.where("doc_id IS NOT NULL")
    firsts = with_id.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    twin = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    told = with_id.join(firsts, ["digest", "doc_id"], "left").select("part", "doc_id", (F.col("mask") + twin).alias("mask"))
    return told.union(rows.where("doc_id IS NULL").select("part", "doc_id", "mask"))


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by pattern of failures."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    rows = judged(docs)
    marked = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    bare = rows.where("doc_id IS NULL").select("*", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    return marked.unionByName(bare).groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"),
    )


def coalitions(counts: list[int]) -> list[int]:
    """v(S) for every set S of filters: documents whose pattern meets S."""
    return [sum(c for mask, c in enumerate(counts) if mask & chosen) for chosen in range(len(counts))]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system of linear equations, exactly."""
    rows = [[*row, value] for row, value in zip(matrix, right, strict=True)]
    for i in range(len(rows)):
        pivot = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [row[-1] for row in rows]


def shapley(values: list[int], n: int = len(FILTERS)) -> list[Fraction]:
    """Values per filter that fit v(S) best in the kernel's weights and add up to v(all)."""
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for chosen in range(1, (1 << n) - 1):
        inside = [i for i in range(n) if chosen >> i & 1]
        weight = Fraction(n - 1, comb(n, len(inside)) * len(inside) * (n - len(inside)))
        for i in inside:
            right[i] += weight * (values[chosen] - values[0])
            for j in inside:
                matrix[i][j] += weight
    for i in range(n):  # the multiplier of the constraint
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n] = Fraction(values[-1] - values[0])
    return solve(matrix, right)[:n]


def audit_part(n: list[int], good: list[int], toxic: list[int]) -> dict[str, list]:
    """All orders and steps of one part, from the counts of its 32 patterns."""
    tables = {"all": coalitions(n), "good": coalitions(good), "toxic": coalitions(toxic)}
    removes, total = tables["all"], sum(n)
    values = [int(v * factorial(len(FILTERS))) for v in shapley(removes)]
    everything = len(n) - 1
    made: dict[str, list] = {c: [] for c, _ in COLUMNS}
    for order in permutations(range(len(FILTERS))):
        before, name = 0, "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = removes[after] - removes[before]
            made["filter_order"].append(name)
            made["step"].append(step)
            made["kept"].append(total - removes[after])
            made["removed"].append(removed)
            made["redundant"].append(removes[1 << i] - removed)
            made["unique_fails"].append(removes[everything] - removes[everything ^ 1 << i])
            made["good_lost"].append(tables["good"][after] - tables["good"][before])
            made["toxic_lost"].append(tables["toxic"][after] - tables["toxic"][before])
            made["shapley"].append(values[i])
            before = after
    return made


COLUMNS = [
    ("filter_order", pa.string()), ("step", pa.int32()), ("kept", pa.int64()), ("removed", pa.int64()), ("redundant", pa.int64()),
    ("unique_fails", pa.int64()), ("good_lost", pa.int64()), ("toxic_lost", pa.int64()), ("shapley", pa.int64()),
]


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the step, for every part of docs (doc_id, text, source) and all 120 orders.

    ``shapley`` is the filter's value times 120: what it removes, added up over all orders.
    """
    counted = patterns(docs, labels)
    wide = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))  # 32 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("found").to_pylist(), strict=True):
                held = np.zeros((3, 1 << len(FILTERS)), object)
                for row in found:
                    held[:, row["mask"]] = row["n"], row["good"], row["toxic"]
                made = audit_part(*held.tolist())
                arrays = [pa.array(made[name], kind) for name, kind in COLUMNS]
                parts = pa.array([part] * len(arrays[0]), pa.string())
                yield pa.RecordBatch.from_arrays([parts, *arrays], names=["part", *(name for name, _ in COLUMNS)])

    schema = (
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long"
    )
    return wide.mapInArrow(run, schema)


SQL = """
WITH RECURSIVE read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM read GROUP BY text),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(w) < 200 AS a,
    100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(f.first < r.doc_id, false) AS e
  FROM read r JOIN firsts f USING (text) LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT letter AS name FROM letters UNION ALL
  SELECT name || letter FROM orders, letters WHERE NOT contains(name, letter)),
steps AS (SELECT name, unnest(range(1, 6)) AS step FROM orders WHERE length(name) = 5),
counted AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
    || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
told AS (
  SELECT c.part, s.name, s.step, s.name[s.step] AS letter, c.failed, c.n, c.good, c.toxic,
    length(translate(c.failed, s.name[1:s.step - 1], '')) < length(c.failed) AS earlier,
    contains(c.failed, s.name[s.step]) AS now
  FROM counted c, steps s),
rows AS (
  SELECT part, name AS filter_order, step, letter, coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT now), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE NOT earlier AND now), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE earlier AND now), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT earlier AND now), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE NOT earlier AND now), 0)::BIGINT AS toxic_lost
  FROM told GROUP BY part, name, step, letter)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM rows"""
