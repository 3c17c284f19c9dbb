"""What the operators of this package share: registration, files, lots of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veinworks.session import checkpoint_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

BATCH_BYTES = 8 << 20


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL check when there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def fresh_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that the driver and all executors share.

    It lies in the folder named by ``spark.checkpoint.dir``.
    """
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return path if ":/" in path else f"file://{path}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends here.

    A table survives the loss of executors and is computed once, which matters
    where the rows name files that tasks have written.
    """
    folder = folder or fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of at most ``BATCH_BYTES``: rows may be whole texts.

    Spark keeps a batch in memory on both sides of the exchange with Python.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("bB")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> Iterator[str]:
    """Python strings of an Arrow column, null as the empty string."""
    for value in column:
        yield value.as_py() or ""


def table_bytes(df: DataFrame, col: str) -> int:
    """UTF-8 bytes of a text column: the size test before a table is sent to all tasks."""
    return df.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0
