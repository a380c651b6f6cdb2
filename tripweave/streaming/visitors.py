"""Visitor counters as a stream (an extension of the monthly aggregation).

Every micro-batch adds its sums per city, day and segment to a store keyed by
batch; reading adds the batches up.  No state is kept and nothing is ever too
late: a row counts whenever it arrives, and a batch that is tried again
replaces its own sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators.visitors import EXACT

KEYS = ("city_name_en", "day", "segment")


def daily_counters(visits: DataFrame) -> DataFrame:
    """Sums per city, day and segment of (city_name_en, ts, tou_div_cd, tou_num)."""
    return visits.groupBy(
        "city_name_en",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("tou_div_cd").cast("string").alias("segment"),
    ).agg(F.sum(F.col("tou_num").cast(EXACT)).alias("tou_num"))


def run_counters(visits: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Adds everything that has arrived to the stored counters."""

    def write(arrived: DataFrame, batch: int) -> None:
        daily_counters(arrived).write.mode("overwrite").parquet(f"{store}/batch={batch}")

    return (
        visits.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_daily(spark: SparkSession, store: str) -> DataFrame:
    """Stored counters in the shape of the daily feed, over all batches."""
    partial = spark.read.parquet(store)
    return partial.groupBy(*KEYS).agg(F.sum("tou_num").cast(EXACT).alias("tou_num")).select(
        "city_name_en",
        F.to_date("day").alias("date"),
        F.col("segment").cast("int").alias("tou_div_cd"),
        "tou_num",
    )


def compact_counters(spark: SparkSession, store: str, out: str) -> None:
    """Writes the sums of all batches of a store as batch 0 of a new one."""
    partial = spark.read.parquet(store)
    sums = partial.groupBy(*KEYS).agg(F.sum("tou_num").cast(EXACT).alias("tou_num"))
    sums.write.mode("overwrite").parquet(f"{out}/batch=0")
