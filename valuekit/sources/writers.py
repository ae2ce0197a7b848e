"""Sinks: parquet, catalog tables, warehouses, versioned snapshots, eval sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.columns import hash_fraction
from valuekit.operators.clean import dates_to_timestamps
from valuekit.roles import SAMPLES

# Target file size in MB, rows per warehouse batch.
TARGET_FILE_MB, BATCH_ROWS = 245, 12_000


def _path(spark: SparkSession, text: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def output_complete(spark: SparkSession, path: str) -> bool:
    """Did the job that wrote this folder finish? Asks the cluster's own file system."""
    marker, files = _path(spark, f"{path.rstrip('/')}/_SUCCESS")
    return bool(files.exists(marker))


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _path(spark, path)
    return bool(files.exists(place))


def folder_bytes(spark: SparkSession, path: str) -> int:
    folder, files = _path(spark, path)
    return int(files.getContentSummary(folder).getLength()) if files.exists(folder) else 0


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str = "snappy", files: int | None = None, rows_per_file: int | None = None) -> None:
    """Parquet sink. `rows_per_file` bounds files without a shuffle, `files` fixes their number."""
    out = df.repartition(files) if files else df
    writer = out.write.mode(mode).option("compression", compression)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def write_partitioned_table(df: DataFrame, name: str, by: str = "Product", *, compression: str = "gzip", mode: str = "overwrite") -> None:
    """Catalog table partitioned by a column.

    The rebalance hint brings rows of one value together and lets adaptive execution split a value
    that is larger than the advisory size over as many writers as it needs.
    """
    df.hint("rebalance", by).write.mode(mode).option("compression", compression).partitionBy(by).saveAsTable(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def drop_table(spark: SparkSession, name: str, files: bool = False) -> None:
    """Drop a table; the files of an external table stay unless asked for."""
    place = table_location(spark, name) if files and table_exists(spark, name) else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if place:
        path, fs = _path(spark, place)
        fs.delete(path, True)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """(Re)register an external table over finished parquet files, creating its database."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def save_and_register(df: DataFrame, name: str, path: str, *, overwrite: bool = False, files: int | None = None) -> str:
    """Write a frame and register it. Finished files are kept unless `overwrite`.

    Returns what happened: `written`, `registered` (files were there) or `kept` (both were).
    """
    spark = df.sparkSession
    if overwrite or not output_complete(spark, path):
        write_parquet(dates_to_timestamps(df), path, files=files)
        register_table(spark, name, path)
        return "written"
    if not table_exists(spark, name):
        register_table(spark, name, path)
        return "registered"
    return "kept"


def write_sized(df: DataFrame, path: str, *, target_mb: int = TARGET_FILE_MB, mode: str = "overwrite") -> None:
    """Parquet files of about `target_mb`: adaptive execution deals the rows out by their measured size."""
    spark, key = df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, f"{target_mb}m")
    try:
        write_parquet(df.hint("rebalance"), path, mode=mode)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_warehouse(df: DataFrame, url: str, table: str, *, batch: int = BATCH_ROWS, writers: int | None = None, **options: str) -> None:
    """Batched insert; `writers` limits the parallel connections."""
    out = df.coalesce(writers) if writers else df
    out.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode("append").save()


def staging_statements(table: str, staging: str) -> tuple[str, str]:
    """Move a loaded staging table into its target, then drop it."""
    return f"INSERT INTO {table} SELECT * FROM {staging}", f"DROP TABLE {staging}"


def load_through_staging(df: DataFrame, table: str, staging: str) -> None:
    """Load an empty staging table in parallel, move it in one statement, drop it.

    The target sees all rows or none, whatever happens to the tasks of the load.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    df.write.saveAsTable(staging)
    for statement in staging_statements(table, staging):
        spark.sql(statement)


def save_snapshot(df: DataFrame, folder: str, name: str) -> int | None:
    """Write version n + 1 when no version has the same shape and content, else nothing.

    The manifest next to the data holds shapes and a content sum over row hashes, which does not
    depend on the order of rows; returns the new version.
    """
    spark = df.sparkSession
    manifest, data = f"{folder}/{name}_manifest", f"{folder}/{name}"
    content = F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
    n_rows, total = df.agg(F.count(F.lit(1)), content).first()
    shape = (n_rows, len(df.columns), total)
    schema = "version int, n_rows bigint, n_columns int, content string"
    seen = spark.read.schema(schema).parquet(manifest) if output_complete(spark, manifest) else spark.createDataFrame([], schema)
    if not seen.where((F.col("n_rows") == shape[0]) & (F.col("n_columns") == shape[1]) & (F.col("content") == total)).isEmpty():
        return None
    version = (seen.agg(F.max("version")).first()[0] or 0) + 1
    write_parquet(df, f"{data}/version={version}")
    spark.createDataFrame([(version, *shape)], schema).coalesce(1).write.mode("append").parquet(manifest)
    return version


def save_eval_sets(df: DataFrame, path: str, sample: str = "sample") -> None:
    df.write.mode("overwrite").option("compression", "gzip").partitionBy(sample).parquet(path)


def read_eval_sets(spark: SparkSession, path: str, target: str, samples: Sequence[str] = SAMPLES, sample: str = "sample") -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per sample the features and the target; a sample's partition is read on its own."""
    rows = spark.read.parquet(path)
    present = {r[0] for r in rows.select(sample).distinct().collect()}
    parts = {s: rows.where(F.col(sample) == s).drop(sample) for s in samples if s in present}
    return {s: (p.drop(target), p.select(target)) for s, p in parts.items()}
