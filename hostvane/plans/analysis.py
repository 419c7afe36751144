"""Analysis of simulated samples: flags, process rows and the chart series, from one reading of the file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.functions import process_text, scalars, status
from hostvane.operators import processes, series


def flag_samples(samples: DataFrame) -> DataFrame:
    """Simulated samples with the bottleneck and low-memory flags and free memory in GiB."""
    return samples.withColumns(
        {
            "cpu_gargalo_flag": status.cpu_bottleneck(
                F.col("porcentagem_uso_da_cpu"), F.col("frequencia_atual"), F.col("frequencia_max")
            ),
            "memoria_livre_gib": scalars.bytes_to_gib(F.col("memoria_livre")),
        }
    ).withColumn("memoria_baixa_flag", status.low_memory(F.col("memoria_livre_gib")))


def process_rows(samples: DataFrame, safe: bool = True) -> DataFrame:
    """One row per process with time, and memory_info split into memory_info_rss and memory_info_vms."""
    parsed = samples.select("data", process_text.parse_list(F.col("processos"), safe=safe).alias("processos_list"))
    return processes.flatten_struct(processes.explode_list(parsed, "processos_list", ["data"]), "memory_info")


def chart_series(samples: DataFrame) -> dict[str, DataFrame]:
    """The eight chart series, each sorted along time and lazily evaluated."""
    flagged, rows = flag_samples(samples), process_rows(samples)
    cpu, gib = F.col("porcentagem_uso_da_cpu"), F.col("memoria_livre_gib")
    long_io = series.wide_to_long(flagged, ["data"], ["read_rate_Bps", "write_rate_Bps"])
    data = {"data": F.col("data")}
    return {
        "cpu": series.series(flagged, data | {"cpu": cpu}, ["data"]),
        "frequency": series.series(flagged, data | {"freq": F.col("frequencia_atual")}, ["data"]),
        "free_memory": series.series(flagged, data | {"gib": gib}, ["data"]),
        "disk_io": long_io.orderBy("data", "metric"),
        "cpu_bottlenecks": series.series(
            flagged,
            data
            | {
                "cpu": cpu,
                "flag": F.col("cpu_gargalo_flag"),
                "flagged": series.overlay(F.col("cpu_gargalo_flag"), cpu),
            },
            ["data"],
        ),
        "low_memory": series.series(
            flagged,
            data
            | {
                "gib": gib,
                "flag": F.col("memoria_baixa_flag"),
                "flagged": series.overlay(F.col("memoria_baixa_flag"), gib),
            },
            ["data"],
        ),
        "process_cpu": series.series(
            rows, data | {"name": F.col("name"), "cpu_percent": F.col("cpu_percent")}, ["data", "name"]
        ),
        "process_rss": series.series(
            rows,
            data | {"name": F.col("name"), "rss_mib": scalars.bytes_to_mib(F.col("memory_info_rss"))},
            ["data", "name"],
        ),
    }
