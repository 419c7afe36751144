"""Writers. Spark writes one file per task, so appending and overwriting work on folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane.functions import scalars

DAY_KEYS = ("ano", "mes", "dia")


def append_csv(df: DataFrame, path: str) -> None:
    """Add to a folder of CSV files; every part carries the header and quotes are doubled."""
    df.write.mode("append").option("header", "true").option("escape", '"').csv(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def with_date_keys(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(scalars.date_parts(F.col(ts)))


def write_by_day(
    df: DataFrame,
    path: str,
    ts: str = "ts",
    cluster: Sequence[str] = ("machine",),
    mode: str = "append",
    replace_days: bool = False,
) -> None:
    """Curated parquet partitioned by year, month and day, and sorted by machine and time inside files.

    The rebalance hint brings a day's rows together without making one task write a hot day: AQE splits large
    partitions and merges small ones. Sorted files let readers skip row groups by machine. With ``replace_days`` an
    overwrite replaces only the days that ``df`` has rows of.
    """
    keyed = with_date_keys(df, ts)
    (
        keyed.hint("rebalance", *DAY_KEYS)
        .sortWithinPartitions(*DAY_KEYS, *cluster, ts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if replace_days else "static")
        .partitionBy(*DAY_KEYS)
        .parquet(path)
    )


def read_curated(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A folder partitioned by day, of the days from ``start`` to ``end`` (ISO dates, inclusive).

    The range becomes a condition on the folder keys, so folders of other days are not listed for reading.
    """
    stored = spark.read.parquet(path)
    day = F.concat_ws("-", *[F.lpad(F.col(key).cast("string"), 4 if key == "ano" else 2, "0") for key in DAY_KEYS])
    if start is not None:
        stored = stored.where(day >= start)
    if end is not None:
        stored = stored.where(day <= end)
    return stored
