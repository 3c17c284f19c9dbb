"""Reading and writing tables, reports and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession, functions as F

from veinworks.functions.numeric import nan_to_null
from veinworks.session import from_rows

FORMATS = ("csv", "parquet", "json")


def read_delimited(
    spark: SparkSession, path: str, sep: str = ",", schema: str | None = None, header: bool = True
) -> DataFrame:
    """Delimited text. Give a ``schema`` for large files: inference reads them once more."""
    reader = spark.read.option("header", header).option("sep", sep).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_tab_separated(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return read_delimited(spark, path, "\t", schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page bodies: a parquet table, or a folder of HTML files read whole."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    files = spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")
    return files.select(F.xxhash64(F.input_file_name()).alias("page_id"), F.input_file_name().alias("url"), "html")


def write_table(df: DataFrame, path: str, kind: str = "csv", sep: str = ",") -> str:
    """Write a table; nested columns go to CSV as JSON text. Returns the path."""
    if kind not in FORMATS:
        raise ValueError(f"kind must be one of: {', '.join(FORMATS)}")
    writer = df
    if kind == "csv":
        nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
        writer = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
        writer.write.mode("overwrite").option("header", True).option("sep", sep).option(
            "timestampFormat", "yyyy-MM-dd HH:mm:ss"
        ).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    else:
        getattr(writer.write.mode("overwrite"), kind)(path)
    return path


def write_tables(tables: dict[str, DataFrame], folder: str, kind: str = "csv") -> dict[str, str]:
    """One subfolder per table (profiles, sweeps, reports)."""
    return {name: write_table(df, f"{folder}/{name}", kind) for name, df in tables.items() if df is not None}


def write_json(df: DataFrame, path: str) -> str:
    """Extraction results as JSON lines, nested fields kept."""
    return write_table(df, path, "json")


def write_run(df: DataFrame, folder: str, run_id: str, kind: str = "parquet") -> str:
    """Add one run to a table of runs, in a partition of its own.

    Writing a run again replaces only that run.
    """
    tagged = df.withColumn("run_id", F.lit(run_id))
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    getattr(writer.option("header", True) if kind == "csv" else writer, kind)(folder)
    return folder


def report(spark: SparkSession, sections: dict[str, dict[str, object]]) -> DataFrame:
    """(section, key, value) rows of a summary."""
    rows = [(s, str(k), None if v is None else str(v)) for s, items in sections.items() for k, v in items.items()]
    return from_rows(spark, rows, "section string, key string, value string")


def classification_summary(result: dict, features: Sequence[str], n_rows: int, n_columns: int) -> dict:
    return {
        "data": {"rows": n_rows, "columns": n_columns, "selected_features": len(features)},
        "model": {"best": result["best"].name, "metric": result["metric"], **result["best"].params},
        "features": {str(i + 1): f for i, f in enumerate(features)},
    }


def clustering_summary(result: dict, features: Sequence[str], shape: tuple[int, int], prepared: tuple[int, int]) -> dict:
    sizes = {f"cluster {r['prediction']}": f"{r['count']} ({r['percentage']:.1f}%)" for r in result["sizes"].collect()}
    return {
        "data": {
            "rows": shape[0], "columns": shape[1], "prepared_columns": prepared[1], "selected_features": len(features),
        },
        "clusters": {"best_method": result["method"], "n_clusters": result["n_clusters"], **sizes},
    }


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind: type[MLReadable] = PipelineModel):
    return kind.load(path)
