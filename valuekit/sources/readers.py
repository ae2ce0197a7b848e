"""Sources: marts, catalog tables, delimited files, warehouses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from valuekit.functions.columns import month_list
from valuekit.operators.clean import cast_numbers
from valuekit.roles import require_columns


def read_mart(spark: SparkSession, path: str, slice_date: date, months: int, columns: Sequence[str], month: str = "month") -> DataFrame:
    """Wanted columns of the last `months` month partitions; other partitions are not read."""
    rows = spark.read.parquet(path)
    require_columns(rows, [month, *columns])
    return rows.where(F.col(month).isin(*month_list(slice_date, months))).select(*dict.fromkeys([*columns, month]))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table with refreshed metadata, so that files written elsewhere are seen."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_table_with_numbers(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table whose number-like string columns become doubles."""
    return cast_numbers(read_table(spark, name))


def read_delimited(spark: SparkSession, path: str, sep: str = ";", schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """Delimited file. With a schema nothing is inferred and a header-less export can be read."""
    reader = spark.read.option("sep", sep).option("header", header)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_sample(spark: SparkSession, source: str, **options) -> DataFrame:
    """Load a sample by what its name says: csv, parquet, a SELECT, or a catalog table."""
    lowered = source.strip().lower()
    if lowered.endswith((".csv", ".csv.gz")):
        return spark.read.options(**({"header": True, "inferSchema": True} | options)).csv(source)
    if lowered.endswith(".parquet") or "/" in lowered and not lowered.startswith("select"):
        return spark.read.parquet(source)
    if lowered.startswith(("select", "with")):
        return spark.sql(source)
    return read_table(spark, source)


def read_samples(spark: SparkSession, sources: Mapping[str, str], sample: str = "sample") -> DataFrame:
    """All configured samples as one frame with a sample column."""
    out = None
    for name, source in sources.items():
        part = read_sample(spark, source).withColumn(sample, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no samples configured")
    return out


def jdbc_options(url: str, query: str, *, partition: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1, fetch_size: int = 100_000, **more: str) -> dict[str, str]:
    """Options of a warehouse read; with a partition column the ranges are pulled in parallel."""
    options = {"url": url, "fetchsize": str(fetch_size), **more}
    if partition is None:
        return options | {"query": query}
    if bounds is None:
        raise ValueError("a partitioned read needs the bounds of the partition column")
    # Spark allows no partition column next to `query`, so the query becomes a derived table.
    return options | {
        "dbtable": f"({query}) q",
        "partitionColumn": partition,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_warehouse(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """Warehouse query. Chunked pulls are the partitions of the frame, each read by its task."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()


def list_tables(spark: SparkSession, database: str, pattern: str, number: str = r"(\d+)") -> DataFrame:
    """Tables of a database by name pattern, with the first number found in each name."""
    tables = spark.sql(f"SHOW TABLES IN `{database}` LIKE '{pattern}'").select("tableName")
    found = F.regexp_extract("tableName", number, 1)
    return tables.select("tableName", F.when(found != "", found.cast("bigint")).alias("number"))
