"""Writers: bucketed outputs, keyed batches, published versions, ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.text import or_default, raw_detail_key
from tripweave.operators.domain import quality_summary
from tripweave.operators.keyvalue import KEYS, has_key, pick_per_key
from tripweave.sources.raw import text_at

# --- domain outputs ---------------------------------------------------------


def write_domain_output(items: DataFrame, path: str) -> None:
    """All buckets in one job as ``path/items/bucket=…``, then the counts of what was written as ``path/summary``."""
    rows = items.withColumn("bucket", F.explode("buckets")).drop("buckets", "position")
    clustered(rows, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/items")
    written = items.sparkSession.read.parquet(f"{path}/items").withColumn("buckets", F.array("bucket"))
    quality_summary(written).write.mode("overwrite").json(f"{path}/summary")


def clustered(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by the columns of their folders, so that a folder gets few files; large folders spread over several tasks."""
    return rows.hint("rebalance", *columns)


def write_by_status(records: DataFrame, path: str, ingest_date: str) -> None:
    """Records as ``path/ingest_date=…/quality_status=…``; empty statuses
    leave no folder."""
    dated = records.withColumn("ingest_date", F.lit(ingest_date))
    (
        clustered(dated, "quality_status").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "quality_status")
        .parquet(path)
    )


def write_by_city(rows: DataFrame, path: str) -> None:
    """One folder per English city name."""
    clustered(rows, "city_name_en").write.mode("overwrite").partitionBy("city_name_en").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str, stamp: str) -> None:
    """A report under its time stamp and again as ``latest``."""
    for name in (stamp, "latest"):
        report.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def decimal_view(rows: DataFrame, decimal: T.DecimalType = T.DecimalType(38, 18)) -> DataFrame:
    """Every double, also inside lists, maps and structs, as an exact decimal."""
    def exact(data_type: T.DataType) -> T.DataType:
        if isinstance(data_type, (T.DoubleType, T.FloatType)):
            return decimal
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(exact(data_type.elementType), data_type.containsNull)
        if isinstance(data_type, T.MapType):
            return T.MapType(data_type.keyType, exact(data_type.valueType), data_type.valueContainsNull)
        if isinstance(data_type, T.StructType):
            return T.StructType([T.StructField(f.name, exact(f.dataType), f.nullable) for f in data_type])
        return data_type

    # Numbers beyond the decimal's range become null instead of an error.
    return rows.select(*[F.col(f.name).try_cast(exact(f.dataType)).alias(f.name) for f in rows.schema])


# --- keyed item store -------------------------------------------------------


def append_batch(
    items: DataFrame,
    path: str,
    batch: int,
    order: Sequence[str],
    keys: Sequence[str] = KEYS,
    transient: Sequence[str] = (),
) -> None:
    """Stores one batch of upserts as ``path/batch=N``.

    Only the batch is written, the last row in ``order`` per key, without the
    ``transient`` columns.  Writing the same batch again replaces it, so a
    retried batch changes nothing.
    """
    ordered = items.where(has_key(keys)).withColumn("_order", F.struct(*order)).drop(*transient)
    latest = pick_per_key(ordered, keys, F.col("_order")).drop("_order")
    latest.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def current_items(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Latest row of every key over all batches.

    Filters on the key columns reach the file scan through the aggregate.
    """
    batches = spark.read.option("mergeSchema", True).parquet(path)
    return pick_per_key(batches, keys, F.col("batch")).drop("batch")


def publish_version(rows: DataFrame, path: str, version: int, partition_by: Sequence[str] = ()) -> None:
    """Writes a whole dataset as ``path/version=N``.

    The commit marker Spark leaves behind makes the version visible, so
    readers never see a half-written one.
    """
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/version={version}")


def publish_items(items: DataFrame, path: str, version: int) -> None:
    """Published items laid out for the index queries: a folder per entity
    type, rows sorted by key so file statistics prune."""
    # One entity type may own most rows, so rows are ranged over keys first.
    ranged = items.repartitionByRange("entity_type", "PK", "SK")
    publish_version(ranged.sortWithinPartitions("entity_type", "PK", "SK"), path, version, ["entity_type"])


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Newest version with a commit marker, None when there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    found = []
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith("version=") and fs.exists(hadoop.Path(entry.getPath(), "_SUCCESS")):
            found.append(int(name.split("=", 1)[1]))
    return max(found, default=None)


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest published dataset, None before the first publication."""
    version = latest_version(spark, path)
    return None if version is None else spark.read.parquet(f"{path}/version={version}")


# --- checksummed ingest -----------------------------------------------------


def read_file_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(local_path, body, byte_size, sha256, md5) of the JSON files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(
        F.col("path").alias("local_path"),
        F.decode("content", "UTF-8").alias("body"),
        F.col("length").alias("byte_size"),
        F.sha2("content", 256).alias("checksum_sha256"),
        F.md5("content").alias("checksum_md5"),
    )


def raw_manifest(files: DataFrame, ingest_date: Column, keep_body: bool = False) -> DataFrame:
    """Per file: names, list sizes, checksum, size and target key, on request the body.

    A statistics object counts its ``monthly`` list, else its keys.
    """
    doc = F.col("doc")
    file_name = F.regexp_extract("local_path", r"([^/]*)\z", 1)

    def list_size(path: str) -> Column:
        return F.coalesce(F.size(F.try_variant_get(doc, path, "array<variant>")), F.lit(0))

    as_object = F.size(F.try_variant_get(doc, "$.visitor_statistics", "map<string,variant>"))
    statistics = F.coalesce(
        F.size(F.try_variant_get(doc, "$.visitor_statistics", "array<variant>")),
        F.size(F.try_variant_get(doc, "$.visitor_statistics.monthly", "array<variant>")),
        as_object,
        F.lit(0),
    )
    named = files.withColumn("doc", F.try_parse_json("body")).withColumn("file_name", file_name)
    city = or_default(text_at(doc, "$.meta.city_name_en"), "")
    return named.select(
        "local_path",
        "file_name",
        F.when(city != "", city)
        .otherwise(F.regexp_replace("file_name", r"\.[^.]*\z", ""))
        .alias("city_name_en"),
        F.coalesce(text_at(doc, "$.meta.city_name_ko"), F.lit("")).alias("city_name_ko"),
        F.coalesce(text_at(doc, "$.meta.province"), F.lit("")).alias("province"),
        list_size("$.attractions").alias("attraction_count"),
        list_size("$.festivals").alias("festival_count"),
        statistics.alias("visitor_statistics_count"),
        "checksum_sha256",
        "byte_size",
        *(["body"] if keep_body else []),
    ).withColumn("s3_key", raw_detail_key(F.col("city_name_en"), ingest_date))


def ingest_status(
    manifest: DataFrame,
    previous: DataFrame,
    overwrite: bool = False,
    key: str = "s3_key",
    checksum: str = "checksum_sha256",
) -> DataFrame:
    """Adds ``status``: skipped when the stored checksum is the same, failed
    without a valid key, else uploaded.  ``previous`` is (key, checksum)."""
    stored = pick_per_key(
        previous.select(key, F.col(checksum).alias("_stored")), [key], F.col("_stored")
    )
    same = F.col("_stored").eqNullSafe(F.col(checksum)) if not overwrite else F.lit(False)
    status = (
        F.when(F.col(key).isNull(), F.lit("failed"))
        .when(same, F.lit("skipped"))
        .otherwise(F.lit("uploaded"))
    )
    return manifest.join(stored, key, "left").withColumn("status", status).drop("_stored")


def required_files(spark: SparkSession, names: Sequence[str] | DataFrame, inventory: DataFrame) -> DataFrame:
    """Expected file names, a list or a table (file_name), with found / missing status and an error text."""
    expected = names.select("file_name") if isinstance(names, DataFrame) else spark.createDataFrame([(n,) for n in names], "file_name string")
    present = inventory.select("file_name").distinct().withColumn("found", F.lit(True))
    joined = expected.join(present, "file_name", "left")
    return joined.select(
        "file_name",
        F.when(F.col("found"), F.lit("found")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("found").isNull(), F.concat(F.lit("File not found: "), "file_name")).alias("error"),
    )
