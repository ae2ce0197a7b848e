"""Session helpers: a local builder for tests and benchmarks, and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "valuekit", partitions: int = 8) -> SparkSession:
    """Single-JVM session. On a cluster the submitting side supplies the session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs milliseconds per column expression while a query is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_shared_checkpoints(spark: SparkSession) -> str:
    """Make checkpoints go to the folder named in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local folder
    would be lost with its executor, so there an unset option is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        current = context.getCheckpointDir()
        if current is not None:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="valuekit-checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write `df` as parquet below the shared checkpoint folder and continue from the files.

    Used where a frame is read by many later jobs (model predictions, permutation frames), so that
    a lost executor re-reads files instead of re-running the model, every reader sees the same
    floating-point values, and each job reads the columns it needs only.
    """
    path = f"{use_shared_checkpoints(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """`settle`, and the number of rows, which comes from the files' footers.

    An `Observation` would count while writing, but a session that ever had one cannot send a fitted logistic model,
    whose summary holds the session, to its tasks any more.
    """
    kept = settle(df)
    return kept, kept.count()
