"""Table writers on plain Parquet folders.

A replaced table is written to a new version folder and published by a small
pointer file, so readers see either the old or the new state.  One writer per table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    files_per_partition: int | None = None,
) -> None:
    """Parquet folder.  Rows of one partition value are gathered into few files; AQE
    splits a partition value that is much larger than the others."""
    if partition_by:
        df = df.hint("rebalance", *partition_by) if files_per_partition is None else df.repartition(
            files_per_partition, *partition_by
        )
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int,
                   sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Catalog table hashed on a key: joins and groupings on it need no shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def bucketed_pair(left: DataFrame, right: DataFrame, key: str, root: str, buckets: int | None = None) -> DataFrame:
    """Inner join of two frames over tables bucketed and sorted on its key under `root`:
    neither side is shuffled.  The tables stay in the catalog, for further
    joins, as `b_<folder>_left` and `_right`."""
    spark = left.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    name = "b_" + re.sub(r"\W", "_", root.rstrip("/").rpartition("/")[2])
    for side, df in (("left", left), ("right", right)):
        # One task writes one bucket, so a bucket is one file and its order is kept.
        df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
            "path", f"{root}/{side}").saveAsTable(f"{name}_{side}")
    return spark.table(f"{name}_left").hint("merge").join(spark.table(f"{name}_right"), key)


def replace_slice(df: DataFrame, path: str, part_col: str, day: str | None = None) -> None:
    """Replace the partitions that df holds, or exactly `day`, which is empty afterwards
    if df has no row of it; the others stay."""
    if day is not None:
        rows = df.filter(F.col(part_col) == F.lit(day).cast(df.schema[part_col].dataType)).drop(part_col)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{part_col}={day}")
        return
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)


def write_console(stream: DataFrame, **options):
    """Streaming rows on the console, for a look."""
    return stream.writeStream.format("console").outputMode("append").options(**options).start()


def write_kafka(df: DataFrame, topic: str, options: dict[str, str], columns: Sequence[str] | None = None) -> None:
    """Rows as JSON messages; needs the Kafka connector on the class path."""
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    df.select(value).write.format("kafka").options(**options).option("topic", topic).save()


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def stage(df: DataFrame) -> DataFrame:
    """Rows that several loads of one run read; call unpersist() after the last."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# --- versioned tables -------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, table: str) -> int | None:
    """Published version, or None for a table that was never published."""
    jvm, fs = _fs(spark, table)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{table}/_current")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return int(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip())
    finally:
        stream.close()


def read_version(spark: SparkSession, table: str) -> DataFrame:
    version = current_version(spark, table)
    if version is None:
        raise FileNotFoundError(f"{table} has no published version")
    return spark.read.parquet(f"{table}/v={version}")


def publish(df: DataFrame, table: str, version: int | None = None, partition_by: Sequence[str] = ()) -> int:
    """Write a new version, then move the pointer to it.  A version number given by
    the caller (a batch id) makes a repeated run overwrite its own folder only."""
    spark = df.sparkSession
    now = current_version(spark, table)
    version = (0 if now is None else now + 1) if version is None else version
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table}/v={version}")
    jvm, fs = _fs(spark, table)
    path = jvm.org.apache.hadoop.fs.Path
    fresh = path(f"{table}/_next")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(str(version).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(path(f"{table}/_current")), overwrite)
    return version


def refresh_table(df: DataFrame, table: str) -> int:
    """Refresh of a materialised view."""
    return publish(df, table)


def get_watermark(spark: SparkSession, table: str):
    """Last published load time, or None."""
    if current_version(spark, table) is None:
        return None
    return read_version(spark, table).agg(F.max("load_dttm")).first()[0]


def set_watermark(spark: SparkSession, table: str, value) -> None:
    row = spark.range(1).select(F.lit(value).cast("timestamp_ntz").alias("load_dttm"))
    publish(row, table)
