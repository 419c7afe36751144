import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hostvane import get_session  # noqa: E402


# Started while collecting, because columns at module level need a running session.
SESSION = get_session(
    "tests",
    "local[8]",
    **{
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column on a single row of named values."""

    def evaluate(column, schema, *values):
        fields = [field.split() for field in schema.split(",")]
        row = spark.range(1).select(*[F.lit(v).cast(dtype).alias(n) for v, (n, dtype) in zip(values, fields)])
        return row.select(column.alias("out")).first()["out"]

    return evaluate
