"""Helpers the operators of this package share: inputs, batches of Arrow rows, shared files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. Texts are long, so the default of 10,000 rows would hold too much memory.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of the input folder, by Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size of the session to BATCH_ROWS, unless it is lower already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where it is unset and the master is local, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
        folder = tempfile.mkdtemp(prefix="valuekit-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores added where `df` has such a column, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as parquet into the shared folder and continue from the files, so lineage ends here."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are run within it leave no shuffle files: Spark removes them, on all executors, when the query ends.

    For steps that end in files or on the driver, so that each has the disk to itself. A frame that is made within must
    not be run twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def membership(values: DataFrame, bits: int) -> Callable[[Column], Column]:
    """A test that is true for every long in the single column of `values`, and for few others.

    A bitmap of fixed size, built by Spark: it sorts rows out before a join and never decides alone. However
    many values there are, it has `bits` / 64 longs; with very many it sorts out less.
    """
    place = values.toDF("v").select(F.col("v").bitwiseAND(F.lit(bits - 1)).cast("int").alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)))
    slots = {r.slot: r.held for r in place.groupBy(F.shiftright("p", 6).alias("slot")).agg(F.bit_or(one).alias("held")).collect()}
    held = F.split(F.lit(",".join(str(slots.get(i) or 0) for i in range(bits // 64))), ",").cast("array<bigint>")

    def test(value: Column) -> Column:
        p = value.bitwiseAND(F.lit(bits - 1)).cast("int")
        return F.call_function("shiftrightunsigned", F.get(held, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("bigint")) == 1

    return test


def map_batches(df: DataFrame, step: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """`mapInArrow` for a function from columns (name to list) to the output columns in `schema`."""
    small_batches(df.sparkSession)
    out = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = step(batch.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
