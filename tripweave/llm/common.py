"""Shared helpers: tables, steps saved to the shared folder, Arrow plumbing, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.session import work_folder, work_scope

TEXT_BYTES = 1 << 19  # text that one numpy step works on; a longer document is a step of its own


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written once to the shared work folder and read back: lost executors and later actions repeat nothing."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def settled(spark: SparkSession, purpose: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows that ``make`` returns, written once; all steps that it has saved on the way are deleted."""
    path = work_folder(spark, purpose)
    with work_scope(spark, f"{purpose}-steps"):
        rows = make()
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row belongs to the fold that is never learned from (crc32 of the id as text mod ``folds`` is 0).

    A null id is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of keys (key long, hashed values): about 16 bits a key, 32768 at least and ``bits`` (a power of two) at most."""
    bits = min(bits, max(1 << (16 * keys.count()).bit_length(), 1 << 15))
    spot = F.expr(f"key & {bits - 1}L")
    pages = keys.groupBy(F.shiftright(spot, 15).alias("page")).agg(F.bitmap_construct_agg(spot.bitwiseAND(32767)).alias("bits"))
    made = np.zeros(bits // 8, np.uint8)
    for row in pages.toLocalIterator():  # bits / 32768 rows of 4 KB at most
        made[row["page"] * 4096 : (row["page"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return made


def marked(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key (uint64) is set; also for some keys that were never put in."""
    spot = (keys & np.uint64(len(found) * 8 - 1)).astype(np.int64)
    return (found[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0


def hash_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows, chosen by the hash of a unique key where they are; all rows if there are no more.

    Rows without key are never chosen.
    """
    rows = rows.where(F.col(key).isNotNull())
    share = bound / max(rows.count(), 1)
    return rows if share >= 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))


def plain_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_steps(batch: pa.RecordBatch, column: str = "text", limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each and at least one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += int(size)
    yield batch.slice(first)


def map_text(
    docs: DataFrame, columns: list[str], schema: str | StructType, step: Callable[[pa.RecordBatch], dict | None]
) -> DataFrame:
    """Applies ``step`` to slices of the given columns in tasks; it returns arrays by column name."""
    names = schema.fieldNames() if isinstance(schema, StructType) else [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_steps(batch):
                made = step(part)
                if made is not None and len(made[names[0]]):
                    yield pa.RecordBatch.from_arrays([as_array(made[n]) for n in names], names=names)

    return docs.select(*columns).mapInArrow(run, schema)


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long); a component is named by its smallest node.

    Alternates large stars and small stars; every round is an aggregate and a
    join on a node, written to the shared folder, until no link changes.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = saved(links, f"{purpose}-links")
    # until all nodes hang on roots that hang on nothing
    while not links.select(F.col("b").alias("a")).distinct().join(links, "a", "left_semi").isEmpty() or not _is_forest(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        ).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hang = large.join(small, "a")
        links = saved(
            hang.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(small.select("a", F.col("m").alias("b")))
            .distinct(),
            f"{purpose}-round",
        )
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _is_forest(links: DataFrame) -> bool:
    """Whether no node hangs on two others."""
    return links.groupBy("a").count().where("count > 1").isEmpty()


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
