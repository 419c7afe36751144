"""Readers for the CSV files agents leave in the landing zone, and the mapping to the canonical sample."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane import schemas
from hostvane.functions import scalars

# One more column than the oldest files have: newer agents write a process count before the timestamp, into files
# whose header does not mention it.
_WIDE = [f"c{i}" for i in range(len(schemas.AGENT_COLUMNS) + 1)]
_RAW_SCHEMA = ", ".join(f"{name} string" for name in _WIDE)
#: The keys of keyed day folders.
DAY_FOLDERS = ("ano", "mes", "dia")
_CSV_OPTIONS = {"header": "false", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}

_OBJECT_NAME = r"(\d{4})/(\d{2})/(\d{2})/dados_(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})_([0-9A-Za-z]+)\.csv"


def day_path(root: str, year: int, month: int, day: int, keyed: bool = False) -> str:
    """Folder of one day. Days are plain folders unless ``keyed`` (ano=/mes=/dia=), so a day is chosen by its path."""
    return _folder(root, (f"{year:04d}", f"{month:02d}", f"{day:02d}"), keyed)


def _folder(root: str, parts: Sequence[str], keyed: bool) -> str:
    return "/".join([root.rstrip("/"), *(f"{key}={part}" if keyed else part for key, part in zip(DAY_FOLDERS, parts))])


def range_paths(root: str, first: date, last: date, keyed: bool = False) -> list[str]:
    """Patterns for the folders of all days from ``first`` to ``last``: whole years and months by one pattern each, so that
    a range of years has few of them. Nothing outside the range is listed."""
    paths, day = [], first
    while day <= last:
        month_end = (day.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)
        parts: tuple[str, ...] = (f"{day.year:04d}", f"{day.month:02d}", f"{day.day:02d}")
        end = day
        if day.day == 1 and month_end <= last:
            parts, end = (*parts[:2], "*"), month_end
            if day.month == 1 and date(day.year, 12, 31) <= last:
                parts, end = (parts[0], "*", "*"), date(day.year, 12, 31)
        paths.append(_folder(root, parts, keyed))
        day = end + timedelta(days=1)
    return paths


def read_agent_days(spark: SparkSession, root: str, first: date, last: date, keyed: bool = False) -> DataFrame:
    """Agent samples of all days from ``first`` to ``last``; days without a folder have none."""
    folders = [path[len(root.rstrip("/")) + 1 :] for path in range_paths(root, first, last, keyed)]
    if not folders:
        return agent_samples(spark.createDataFrame([], _RAW_SCHEMA))
    # one pattern: a path that matches nothing would be an error, a part of a pattern is not
    return read_agent_csv(spark, f"{root.rstrip('/')}/{{{','.join(folders)}}}")


def read_agent_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Agent samples of either version, from files with or without a header line, mixed within one file if need be."""
    raw = spark.read.schema(_RAW_SCHEMA).options(**_CSV_OPTIONS).csv(list(paths))
    return agent_samples(raw)


def stream_agent_csv(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same samples as a stream over files as they arrive."""
    reader = spark.readStream.schema(_RAW_SCHEMA).options(**_CSV_OPTIONS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return agent_samples(reader.csv(path))


def agent_samples(raw: DataFrame) -> DataFrame:
    """Type the raw text columns. Header lines are recognised by content; the last filled column is the timestamp."""
    *measures, last = schemas.AGENT_COLUMNS
    longer = F.col(_WIDE[-1]).isNotNull()
    typed = [F.col(c).try_cast(dtype).alias(name) for c, (name, dtype) in zip(_WIDE, measures)]
    count = F.when(longer, F.col(_WIDE[-2])).try_cast("int").alias("qtd_processos")
    ts = scalars.parse_timestamp(F.coalesce(F.col(_WIDE[-1]), F.col(_WIDE[-2]))).alias(last[0])
    header = F.col(_WIDE[0]) == measures[0][0]
    return raw.where(~F.coalesce(header, F.lit(False))).select(*typed, count, ts)


def read_simulated_csv(spark: SparkSession, *paths: str) -> DataFrame:
    return _read_typed(spark, schemas.SIMULATED_COLUMNS, paths)


def read_variant_csv(spark: SparkSession, *paths: str) -> DataFrame:
    return _read_typed(spark, schemas.VARIANT_COLUMNS, paths)


def read_treated_csv(spark: SparkSession, *paths: str) -> DataFrame:
    return _read_typed(spark, schemas.TREATED_FILE_COLUMNS, paths)


def _read_typed(spark: SparkSession, columns: list[tuple[str, str]], paths: tuple[str, ...]) -> DataFrame:
    """CSV with a header line; read as text and cast, so one bad cell is NULL instead of a failed job."""
    text = ", ".join(f"{name} string" for name, _ in columns)
    raw = spark.read.schema(text).options(**{**_CSV_OPTIONS, "header": "true"}).csv(list(paths))

    def typed(name: str, dtype: str) -> Column:
        return scalars.parse_timestamp(F.col(name)) if dtype == "timestamp" else F.col(name).try_cast(dtype)

    return raw.select(*[typed(name, dtype).alias(name) for name, dtype in columns])


def with_object_name(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add date keys, upload time and machine id from the object name. ``path`` defaults to the file being read."""
    path = F.col("_metadata.file_path") if path is None else path

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(path, _OBJECT_NAME, group), F.lit(""))

    return df.withColumns(
        {
            "ano": part(1),
            "mes": part(2),
            "dia": part(3),
            "upload_ts": F.try_to_timestamp(part(4), F.lit("yyyy-MM-dd'T'HH-mm-ss")),
            "id_maquina": part(5),
        }
    )


def list_objects(spark: SparkSession, prefix: str, glob: str = "*.csv") -> DataFrame:
    """Path, size and modification time of every object below a prefix. Contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return files.load(prefix).select("path", "length", "modificationTime")


# Canonical samples -----------------------------------------------------------------------------------------------


def _canonical(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    from pyspark.sql import types as T

    fields = T.StructType.fromDDL(schemas.CANONICAL_SAMPLE).fields
    return df.select(
        *[mapping.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def canonical_agent(df: DataFrame) -> DataFrame:
    c = F.col
    return _canonical(
        df,
        {
            "machine": scalars.machine_id(c("endereco_mac")),
            "user": c("nome_usuario"),
            "ts": c("data_hora_iso"),
            "cpu_pct": c("percentual_uso_cpu"),
            "freq_cur_mhz": c("frequencia_cpu_atual_mhz"),
            "freq_min_mhz": c("frequencia_cpu_minima_mhz"),
            "freq_max_mhz": c("frequencia_cpu_maxima_mhz"),
            "mem_total_bytes": c("memoria_total_bytes"),
            "mem_free_bytes": c("memoria_disponivel_bytes"),
            "ram_used_pct": c("percentual_uso_ram"),
            "ram_free_pct": F.try_divide(c("memoria_disponivel_bytes"), c("memoria_total_bytes")) * 100,
            "swap_total_bytes": c("swap_total_bytes"),
            "swap_used_bytes": c("swap_usado_bytes"),
            "swap_used_pct": c("percentual_uso_swap"),
            "disk_used_pct": c("percentual_uso_disco"),
            "read_bps": c("taxa_leitura_disco_bytes_por_segundo"),
            "write_bps": c("taxa_escrita_disco_bytes_por_segundo"),
            "ping_ms": c("latencia_ping_ms"),
            "download_bps": c("taxa_download_rede_bytes_por_segundo"),
            "upload_bps": c("taxa_upload_rede_bytes_por_segundo"),
            "processes": c("processos"),
            "n_processes": c("qtd_processos") if "qtd_processos" in df.columns else F.lit(None),
        },
    )


def _shared_by_simulated_and_variant() -> dict[str, Column]:
    """Both report memory as percent FREE, unlike the agent's percent used."""
    c = F.col
    free = F.try_divide(c("memoria_livre"), c("memoria_total")) * 100
    return {
        "user": c("usuario"),
        "ts": c("data"),
        "cpu_pct": c("porcentagem_uso_da_cpu"),
        "freq_cur_mhz": c("frequencia_atual"),
        "freq_min_mhz": c("frequencia_min"),
        "freq_max_mhz": c("frequencia_max"),
        "mem_total_bytes": c("memoria_total"),
        "mem_free_bytes": c("memoria_livre"),
        "ram_used_pct": 100 - free,
        "ram_free_pct": c("memoria_percentual"),
        "disk_used_pct": c("porcentagem_uso_do_disco"),
        "read_bps": c("read_rate_Bps"),
        "write_bps": c("write_rate_Bps"),
        "processes": c("processos"),
    }


def canonical_simulated(df: DataFrame) -> DataFrame:
    return _canonical(
        df, {"machine": scalars.machine_id(F.col("macAdress")), **_shared_by_simulated_and_variant()}
    )


def canonical_variant(df: DataFrame, machine: Column | None = None) -> DataFrame:
    """The variant agent writes no machine address; its user stands in unless ``machine`` is given."""

    def whole(name: str) -> Column:
        return F.col(name).try_cast("double").cast("bigint")

    return _canonical(
        df,
        {
            **_shared_by_simulated_and_variant(),
            "machine": F.col("usuario") if machine is None else machine,
            "ping_ms": whole("ping_ms"),
            "download_bps": whole("download_mbps"),
            "upload_bps": whole("upload_mbps"),
        },
    )
