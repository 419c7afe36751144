from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hostvane import schemas
from hostvane.functions import status
from hostvane.plans import treatment
from hostvane.sources import relational

X, L = F.col("x"), F.col("l")


@pytest.mark.parametrize(
    "value, limit, code",
    [
        (80.0, 80.0, "CRITICO"),
        (79.9, 80.0, "ATENCAO"),
        (65.0, 80.0, "ATENCAO"),
        (64.9, 80.0, "NORMAL"),
        (None, 80.0, None),
        (50.0, None, None),
    ],
)
def test_limit_status(one, value, limit, code):
    assert one(status.limit_status(X, L), "x double, l double", value, limit) == code


@pytest.mark.parametrize(
    "value, code",
    [
        (0.0, "NORMAL"),
        (5.0, "NORMAL"),
        (5.1, "ATENCAO"),
        (20.0, "ATENCAO"),
        (20.1, "ALERTA"),
        (50.0, "ALERTA"),
        (50.1, "CRITICO"),
        (None, None),
    ],
)
def test_swap_status(one, value, code):
    assert one(status.swap_status(X), "x double", value) == code


@pytest.mark.parametrize(
    "value, code", [(50, "BAIXA"), (51, "MODERADA"), (200, "MODERADA"), (201, "ALTA"), (None, None)]
)
def test_ping_status(one, value, code):
    assert one(status.ping_status(X), "x int", value) == code


CPU = "cpu double, freq double, top double"
ARGS = F.col("cpu"), F.col("freq"), F.col("top")


@pytest.mark.parametrize(
    "row, code",
    [
        ((50.1, 2000.0, 4000.0), "DEGRADADA"),
        ((50.0, 2000.0, 4000.0), "SEM_INDICIOS"),
        ((50.1, 2000.1, 4000.0), "SEM_INDICIOS"),
        ((50.1, None, 4000.0), None),
        ((40.0, None, 4000.0), "SEM_INDICIOS"),
    ],
)
def test_cpu_degradation(one, row, code):
    assert one(status.cpu_degradation(*ARGS), CPU, *row) == code


@pytest.mark.parametrize(
    "row, flag",
    [((50.1, 2399.9, 4000.0), True), ((50.1, 2400.0, 4000.0), False), ((50.0, 1000.0, 4000.0), False)],
)
def test_cpu_bottleneck(one, row, flag):
    assert one(status.cpu_bottleneck(*ARGS), CPU, *row) is flag


@pytest.mark.parametrize("free, flag", [(48.14, True), (48.15, False), (None, None)])
def test_low_memory(one, free, flag):
    assert one(status.low_memory(X), "x double", free) is flag


@pytest.mark.parametrize("value, colour", [(59.9, "GREEN"), (60.0, "YELLOW"), (79.9, "YELLOW"), (80.0, "RED")])
def test_severity(one, value, colour):
    assert one(status.severity(X), "x double", value) == colour


def test_below_min_freq(one):
    assert one(status.below_min_freq(X, L), "x double, l double", 799.0, 800.0) is True
    assert one(status.below_min_freq(X, L), "x double, l double", 800.0, 800.0) is False


def agent_row(**changes):
    row = {name: None for name, _ in schemas.AGENT_COLUMNS} | {
        "endereco_mac": "aa:bb:cc:dd:ee:ff",
        "percentual_uso_cpu": 90.0,
        "frequencia_cpu_atual_mhz": 1500.0,
        "frequencia_cpu_maxima_mhz": 3600.0,
        "percentual_uso_ram": 70.0,
        "percentual_uso_swap": 30.0,
        "percentual_uso_disco": 10.0,
        "latencia_ping_ms": 250,
        "data_hora_iso": datetime(2026, 4, 16),
    }
    return tuple((row | changes).values())


def limits(spark):
    machine = "aa:bb:cc:dd:ee:ff"
    rows = [(machine, "cpu", 85.0), ("aabbccddeeff", "ram", 80.0), (machine, "disk", 90.0), (machine, "disk", 80.0)]
    return spark.createDataFrame(rows, schemas.LIMITS_SCHEMA)


def test_treated_layout_and_wording(spark):
    samples = spark.createDataFrame(
        [agent_row(), agent_row(endereco_mac="other")], schemas.struct_type(schemas.AGENT_COLUMNS)
    )
    treated = treatment.treat_agent(samples, limits(spark))
    assert len(treated.columns) == 32
    assert treated.columns[26:] == schemas.STATUS_COLUMNS
    known, unknown = sorted(treated.collect(), key=lambda r: r["endereco_mac"])
    assert known["status_cpu"] == "CRÍTICO"
    assert known["status_ram"] == "ATENÇÃO"
    assert known["status_swap"] == "ALERTA"
    assert known["status_disco"] == "Normal"
    assert known["status_ping"] == "Latêcia alta (Critico)"
    assert known["degradacao"].startswith("Possivel degradação")
    assert unknown["status_cpu"] is None and unknown["status_swap"] == "ALERTA"


def test_status_counts_add_up(spark):
    rows = [(m, float(x)) for m in range(3) for x in range(0, 100, 7)]
    frame = spark.createDataFrame(rows, "machine int, x double").select(
        "machine", status.swap_status(X).alias("status_swap"), status.limit_status(X, F.lit(80.0)).alias("status_cpu")
    )
    counted = treatment.status_counts(frame, statuses=["status_swap", "status_cpu"]).collect()
    for component in ("status_swap", "status_cpu"):
        assert sum(r["samples"] for r in counted if r["component"] == component) == len(rows)


def test_status_counts_of_worded_labels(spark):
    rows = [("m", "Normal", "CRÍTICO"), ("m", "Normal", None), ("n", "ATENÇÃO", "CRÍTICO")]
    frame = spark.createDataFrame(rows, "machine string, status_cpu string, status_ram string")
    counted = treatment.status_counts(frame, statuses=["status_cpu", "status_ram"]).collect()
    assert sorted(map(tuple, counted)) == [
        ("m", "status_cpu", "Normal", 2), ("m", "status_ram", "CRÍTICO", 1),
        ("n", "status_cpu", "ATENÇÃO", 1), ("n", "status_ram", "CRÍTICO", 1),
    ]


def test_treatment_needs_no_shuffle_of_samples(spark, tmp_path):
    """One broadcast of the small limits, one projection: the sample side is not exchanged."""
    samples = spark.range(1000).select(
        F.col("id").cast("string").alias("endereco_mac"),
        *[F.lit(1).cast(t).alias(n) for n, t in schemas.AGENT_COLUMNS[1:] if t not in ("timestamp", "string")],
        *[F.lit(None).cast(t).alias(n) for n, t in schemas.AGENT_COLUMNS[1:] if t in ("timestamp", "string")],
    )
    limits(spark).write.parquet(str(tmp_path / "limits"))
    stored = relational.read_limits(spark, str(tmp_path / "limits"))
    plan = treatment.treat_agent(samples, stored)._jdf.queryExecution().executedPlan().toString()
    above_join = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in above_join and "Exchange hashpartitioning" not in above_join
