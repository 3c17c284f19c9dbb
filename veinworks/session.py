"""Session helpers: building a session and cutting lineage safely."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Rows that may be sent to every executor, or handled by one task. Larger
# inputs take the shuffled path of the operator concerned.
SMALL_ROWS = 100_000


def build_session(app: str = "veinworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Rows may be whole pages: keep the batches for Python workers small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session on one machine without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="veinworks-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Bounded driver-side results (one row per column, model, k ...) as a DataFrame."""
    if len(rows) > SMALL_ROWS:
        raise ValueError(f"{len(rows)} rows are too many for a driver-side table")
    return spark.createDataFrame(rows, schema)
