"""Blocks of rows in files of the shared folder, for work on pairs of rows.

Rows nearest to the same pivot are dealt into blocks of bounded size, each
written once. A task reads the blocks that it needs, one after another: no row is
copied for every block that it meets, so disk grows with the rows and not with
their pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from veinworks.session import checkpoint_folder

BLOCK_ROWS = 2_000
BOUND_CELLS = 4_000_000
SLACK = 1e-9
ABOUT = "path string, n long, low array<double>, high array<double>, center array<double>, radius double, least double"


@dataclass
class Block:
    """Where the rows of a block are, how many, the box and ball around its finite ones, and the least weight of a row."""

    key: tuple
    path: str
    n: int
    low: np.ndarray
    high: np.ndarray
    center: np.ndarray
    radius: float
    least: float


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """An Arrow column of arrays as the rows of a matrix, missing values as NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that the driver and all executors share."""
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return path if ":/" in path else f"file://{path}"


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write(folder: str, rows: pa.Table) -> str:
    """Path of a new file that holds these rows; a task that is tried again writes another."""
    files, at = _filesystem(folder)
    files.create_dir(at, recursive=True)
    name = uuid.uuid4().hex
    with files.open_output_stream(f"{at}/{name}.arrow") as out, pa.ipc.new_file(out, rows.schema) as sink:
        sink.write_table(rows)
    return f"{folder}/{name}.arrow"


def read(path: str) -> pa.Table:
    files, at = _filesystem(path)
    with files.open_input_file(at) as source:
        return pa.ipc.open_file(source).read_all()


def about(x: np.ndarray, path: str, least: float = 1.0) -> dict[str, list]:
    """What is known of a block without reading it, as one row of ``ABOUT``."""
    whole = x[np.isfinite(x).all(1)]
    if len(whole):
        low, high, center = whole.min(0), whole.max(0), whole.mean(0)
        radius = float(np.sqrt(((whole - center) ** 2).sum(1).max()))
    else:
        low, high, center, radius = np.full(x.shape[1], np.inf), np.full(x.shape[1], -np.inf), np.zeros(x.shape[1]), -np.inf
    return {"path": [path], "n": [len(x)], "low": [low], "high": [high], "center": [center], "radius": [radius], "least": [float(least)]}


def blocks_of(rows: Sequence, key: Sequence[str]) -> list[Block]:
    return [
        Block(tuple(r[k] for k in key), r["path"], r["n"], np.array(r["low"]), np.array(r["high"]), np.array(r["center"]), r["radius"], r["least"])
        for r in rows
    ]


def with_cell(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """All rows with ``cell``, the number of the pivot nearest to ``v``."""
    at = df.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (pivots * pivots).sum(1)
        for batch in batches:
            x = matrix(batch.column(at), pivots.shape[1])
            with np.errstate(over="ignore", invalid="ignore"):
                cell = (square - 2 * x @ pivots.T).argmin(1)  # any cell will do: the pivots only gather rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], [*batch.schema.names, "cell"])

    return df.mapInArrow(run, StructType(df.schema.fields[:]).add("cell", "integer"))


def deal(df: DataFrame, width: int, by: Sequence[str], key: str = "id", most: int = BLOCK_ROWS, weight: str | None = None) -> list[Block]:
    """The rows of ``df`` in files of about ``most`` rows of equal ``by``; ``v`` is the place of a row.

    One row per block comes to the driver.
    """
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))  # groups × pivots
    dealt = df.join(F.broadcast(sizes), by).withColumn("_block", F.pmod(F.xxhash64(key), F.ceil(F.col("_n") / most))).drop("_n")
    folder = fresh_folder(df.sparkSession, "blocks")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(part: pa.Table) -> pa.Table:
        least = part[weight].to_numpy().min() if weight else 1.0
        told = about(matrix(part["v"], width), write(folder, part.drop_columns(["_block"])), least)
        return pa.table({**{k: part[k].slice(0, 1).combine_chunks() for k in by}, **told})

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in by), ABOUT])
    found = dealt.groupBy(*by, "_block").applyInArrow(run, schema)
    return sorted(blocks_of(found.collect(), by), key=lambda b: (b.key, b.path))


def least_away(x: np.ndarray, blocks: Sequence[Block]) -> np.ndarray:
    """Per row and block a distance that no finite row of the block is nearer than."""
    low, high, center = (np.array([getattr(b, name) for b in blocks]) for name in ("low", "high", "center"))
    radius, out = np.array([b.radius for b in blocks]), np.empty((len(x), len(blocks)))
    step = max(1, BOUND_CELLS // max(1, low.size))
    for start in range(0, len(x), step):
        own = x[start : start + step, None, :]
        with np.errstate(over="ignore", invalid="ignore"):
            box = np.sqrt((np.maximum(np.maximum(low - own, own - high), 0) ** 2).sum(2)) * (1 - SLACK)
            away = np.sqrt(((own - center) ** 2).sum(2))
            ball = away - radius - SLACK * (away + radius)
        out[start : start + step] = np.fmax(box, ball)
    return out


def over_blocks(spark: SparkSession, n: int, run: Callable[[int], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``run`` yields for the numbers 0 to n - 1, each a task of its own."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from run(i)

    return spark.range(0, n, 1, max(1, n)).mapInArrow(tasks, schema)
