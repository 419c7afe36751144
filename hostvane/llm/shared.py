"""What the corpus operators share: reading tables, tables in the cluster's shared folder, batches of rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hostvane.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder: computed once, and safe when an executor is lost."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut batches, so that a worker holds the Python objects of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts; null is the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from the table's own columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
