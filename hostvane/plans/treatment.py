"""Treatment: attach limits, classify every sample, and summarise the statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane import schemas
from hostvane.functions import scalars, status
from hostvane.operators import ordered
from hostvane.sources import relational

#: Columns the rules read, by the name they have in a canonical sample.
CANONICAL = {
    "cpu": "cpu_pct",
    "freq": "freq_cur_mhz",
    "freq_max": "freq_max_mhz",
    "ram": "ram_used_pct",
    "swap": "swap_used_pct",
    "disk": "disk_used_pct",
    "ping": "ping_ms",
}

#: The same columns by the name they have in an agent file.
AGENT = {
    "cpu": "percentual_uso_cpu",
    "freq": "frequencia_cpu_atual_mhz",
    "freq_max": "frequencia_cpu_maxima_mhz",
    "ram": "percentual_uso_ram",
    "swap": "percentual_uso_swap",
    "disk": "percentual_uso_disco",
    "ping": "latencia_ping_ms",
}

#: Every code each status can take, in order of severity.
CODES = {
    "status_cpu": ("NORMAL", "ATENCAO", "CRITICO"),
    "status_ram": ("NORMAL", "ATENCAO", "CRITICO"),
    "status_swap": ("NORMAL", "ATENCAO", "ALERTA", "CRITICO"),
    "status_disco": ("NORMAL", "ATENCAO", "CRITICO"),
    "status_ping": ("BAIXA", "MODERADA", "ALTA"),
    "degradacao": ("SEM_INDICIOS", "DEGRADADA"),
}

_WORDING = {
    "degradacao": status.DEGRADATION_TEXT,
    "status_cpu": status.LIMIT_TEXT,
    "status_ram": status.LIMIT_TEXT,
    "status_swap": status.SWAP_TEXT,
    "status_disco": status.LIMIT_TEXT,
    "status_ping": status.PING_TEXT,
}


def attach_limits(samples: DataFrame, limits: DataFrame, key: str = "machine") -> DataFrame:
    """Left join of the limits by machine. A machine without limits keeps its samples, with NULL limits.

    The planner broadcasts the limits when they are small enough; beyond that threshold it sort-merges and AQE
    splits hot machines.
    """
    return samples.join(relational.wide_limits(limits, key), key, "left")


def status_columns(names: dict[str, str] = CANONICAL, wording: bool = False) -> dict[str, Column]:
    """The six labels of a sample that already carries limit_cpu, limit_ram and limit_disk."""
    c = {role: F.col(name) for role, name in names.items()}
    labels = {
        "degradacao": status.cpu_degradation(c["cpu"], c["freq"], c["freq_max"]),
        "status_cpu": status.limit_status(c["cpu"], F.col("limit_cpu")),
        "status_ram": status.limit_status(c["ram"], F.col("limit_ram")),
        "status_swap": status.swap_status(c["swap"]),
        "status_disco": status.limit_status(c["disk"], F.col("limit_disk")),
        "status_ping": status.ping_status(c["ping"]),
    }
    if wording:
        labels = {name: status.label_text(code, _WORDING[name]) for name, code in labels.items()}
    return labels


def treat(
    samples: DataFrame,
    limits: DataFrame,
    names: dict[str, str] = CANONICAL,
    key: str = "machine",
    wording: bool = False,
) -> DataFrame:
    """All columns of the sample plus the six labels. Works on batches and streams: one join, one projection."""
    limited = attach_limits(samples, limits, key)
    kept = [c for c in limited.columns if c not in {f"limit_{c}" for c in relational.COMPONENTS}]
    return limited.withColumns(status_columns(names, wording)).select(*kept, *schemas.STATUS_COLUMNS)


def treat_agent(samples: DataFrame, limits: DataFrame, wording: bool = True) -> DataFrame:
    """Agent samples to the 32-column treated layout: 26 agent columns in file order, then the labels.

    Limits may name a machine by its MAC address, with or without colons.
    """
    keyed = limits.withColumn("machine", scalars.machine_id(F.col("machine")))
    identified = samples.withColumn("machine", scalars.machine_id(F.col("endereco_mac")))
    treated = treat(identified, keyed, AGENT, wording=wording)
    return treated.select(*[name for name, _ in schemas.AGENT_COLUMNS], *schemas.STATUS_COLUMNS)


def machine_overview(
    samples: DataFrame, keys: Sequence[str] = ("machine",), order: Sequence[str] = ("ts",)
) -> DataFrame:
    """The latest canonical sample of every machine as an operator sees it: percentages as text with one decimal and a
    traffic light each, free memory in whole GiB, and ping."""
    percentages = {"cpu": "cpu_pct", "ram": "ram_used_pct", "disk": "disk_used_pct"}
    needed = [*keys, *order, *percentages.values(), "freq_cur_mhz", "mem_free_bytes", "ping_ms"]
    latest = ordered.last_row(samples.select(*needed), keys, order)
    return latest.select(
        *keys,
        *order,
        *[scalars.fixed_text(F.col(column)).alias(f"{name}_text") for name, column in percentages.items()],
        *[status.severity(F.col(column)).alias(f"{name}_severity") for name, column in percentages.items()],
        "freq_cur_mhz",
        scalars.whole_gib(F.col("mem_free_bytes")).alias("mem_free_gib"),
        "ping_ms",
    )


def status_counts(
    treated: DataFrame, keys: Sequence[str] = ("machine",), statuses: Sequence[str] | None = None
) -> DataFrame:
    """Samples per machine, component and status, as rows, for whatever labels there are: codes or their wording.

    One pass; every task counts its part first, so few rows per machine are shuffled. NULL labels are not counted.
    """
    statuses = list(statuses or CODES)
    long = treated.select(*keys, *statuses).unpivot(list(keys), statuses, "component", "status")
    counted = long.where(F.col("status").isNotNull()).groupBy(*keys, "component", "status")
    return counted.agg(F.count(F.lit(1)).alias("samples"))
