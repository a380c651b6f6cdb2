"""Raw city payloads built from the derived content records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_KEYS = 2000


def raw_payloads(inputs) -> DataFrame:
    """(source_key, body): JSON text of city files.

    A file holds the records of one city out of 2,000 consecutive part keys, so
    no file grows with the data.
    """
    c = inputs["content"]
    detail = F.struct(
        F.struct(F.col("overview"), F.col("lcls").alias("lclsSystm3")).alias("common"),
        F.struct(
            F.col("start_ymd").alias("eventstartdate"),
            F.col("end_iso").alias("eventenddate"),
            F.lit("hall").alias("eventplace"),
            F.col("tel").alias("infocenter"),
        ).alias("intro"),
    )
    is_fest = F.col("contenttypeid") == "15"
    record = F.struct(
        "contentid",
        # Festival entries carry no type of their own.
        F.when(~is_fest, F.col("contenttypeid")).alias("contenttypeid"),
        "title", "mapx", "mapy", "cat3", "firstimage", "firstimage2", "addr1",
        F.when(F.col("pos") % 2 == 0, F.col("tel")).alias("tel"),
        detail.alias("detail"),
    )
    file_no = F.floor(F.col("pos") / FILE_KEYS).cast("int")
    files = c.groupBy("city_name_en", "city_id", "province", file_no.alias("file_no")).agg(
        F.array_sort(F.collect_list(F.when(~is_fest, F.struct("pos", record.alias("r"))))).alias("a"),
        F.array_sort(F.collect_list(F.when(is_fest, F.struct("pos", record.alias("r"))))).alias("f"),
    )
    months = F.array(
        F.struct(F.lit("2025-01").alias("month"), F.lit(31).alias("days"), F.col("file_no").cast("double").alias("locals_total")),
        F.struct(F.lit("bad").alias("month"), F.lit(0).alias("days"), F.lit(0.0).alias("locals_total")),
    )
    payload = F.struct(
        F.struct("city_name_en", "city_id", "province").alias("meta"),
        F.transform("a", lambda e: e["r"]).alias("attractions"),
        F.transform("f", lambda e: e["r"]).alias("festivals"),
        F.struct(F.lit(2025).alias("year"), months.alias("monthly_statistics")).alias("visitor_statistics"),
    )
    return files.select(
        F.concat_ws("/", F.lit("raw"), "city_name_en", F.concat("file_no", F.lit(".json"))).alias("source_key"),
        F.to_json(payload).alias("body"),
    )
