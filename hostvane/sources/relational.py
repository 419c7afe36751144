"""Limits: one threshold per machine and component, from a database table or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from hostvane import schemas

COMPONENTS = ("cpu", "ram", "disk")


def jdbc_reader(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrameReader:
    """Reader for a database table. With a numeric partition column the scan is split into parallel ranges.

    Credentials are arguments: pass them from the deployment's secret store, never from source code.
    """
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, user, password, partition_column, bounds, partitions)
    )


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "pushDownPredicate": "true"}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_limits(spark: SparkSession, path: str) -> DataFrame:
    """Limits kept as parquet, with columns machine, component and limit."""
    return spark.read.schema(schemas.LIMITS_SCHEMA).parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Service profiles kept as CSV with a header."""
    return spark.read.schema(schemas.SERVICE_PROFILE_SCHEMA).option("header", "true").csv(path)


def wide_limits(limits: DataFrame, key: str = "machine") -> DataFrame:
    """One row per machine with a column per component, so that a sample needs one join instead of three.

    Repeated limits of a component are resolved to the greatest.
    """
    return limits.groupBy(key).agg(
        *[F.max(F.when(F.col("component") == c, F.col("limit"))).alias(f"limit_{c}") for c in COMPONENTS]
    )
