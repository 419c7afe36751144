"""Declared schemas of the telemetry files and the canonical sample model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the files, which readers and the treated output must reproduce.
AGENT_COLUMNS = [
    ("endereco_mac", "string"),
    ("nome_usuario", "string"),
    ("percentual_uso_cpu", "double"),
    ("frequencia_cpu_atual_mhz", "double"),
    ("frequencia_cpu_minima_mhz", "double"),
    ("frequencia_cpu_maxima_mhz", "double"),
    ("memoria_total_bytes", "bigint"),
    ("memoria_disponivel_bytes", "bigint"),
    ("percentual_uso_ram", "double"),
    ("swap_total_bytes", "bigint"),
    ("swap_usado_bytes", "bigint"),
    ("swap_livre_bytes", "bigint"),
    ("swap_entrada_bytes", "bigint"),
    ("swap_saida_bytes", "bigint"),
    ("percentual_uso_swap", "double"),
    ("disco_total_bytes", "bigint"),
    ("disco_usado_bytes", "bigint"),
    ("disco_livre_bytes", "bigint"),
    ("percentual_uso_disco", "double"),
    ("taxa_leitura_disco_bytes_por_segundo", "bigint"),
    ("taxa_escrita_disco_bytes_por_segundo", "bigint"),
    ("latencia_ping_ms", "int"),
    ("taxa_download_rede_bytes_por_segundo", "bigint"),
    ("taxa_upload_rede_bytes_por_segundo", "bigint"),
    ("processos", "string"),
    ("data_hora_iso", "timestamp"),
]

SIMULATED_COLUMNS = [
    ("macAdress", "string"),
    ("usuario", "string"),
    ("porcentagem_uso_da_cpu", "double"),
    ("frequencia_atual", "int"),
    ("frequencia_min", "int"),
    ("frequencia_max", "int"),
    ("porcentagem_uso_do_disco", "double"),
    ("read_rate_Bps", "bigint"),
    ("write_rate_Bps", "bigint"),
    ("memoria_percentual", "int"),
    ("memoria_total", "bigint"),
    ("memoria_livre", "bigint"),
    ("processos", "string"),
    ("data", "timestamp"),
]

VARIANT_COLUMNS = [
    ("usuario", "string"),
    ("porcentagem_uso_da_cpu", "double"),
    ("frequencia_atual", "int"),
    ("frequencia_min", "int"),
    ("frequencia_max", "int"),
    ("porcentagem_uso_do_disco", "double"),
    ("read_rate_Bps", "bigint"),
    ("write_rate_Bps", "bigint"),
    ("memoria_percentual", "int"),
    ("memoria_total", "bigint"),
    ("memoria_livre", "bigint"),
    ("download_mbps", "string"),
    ("upload_mbps", "string"),
    ("ping_ms", "string"),
    ("data", "timestamp"),
    ("processos", "string"),
]

TREATED_FILE_COLUMNS = [
    ("cpu", "double"),
    ("disco", "double"),
    ("datahora", "timestamp"),
    ("ram_percentual", "double"),
    ("status_ram", "string"),
    ("status_cpu", "string"),
    ("status_disco", "string"),
    ("periodo", "string"),
]

STATUS_COLUMNS = ["degradacao", "status_cpu", "status_ram", "status_swap", "status_disco", "status_ping"]

SERVICE_PROFILE_SCHEMA = (
    "name string, cpu int, mem_mb int, disk_kbps int, lat_min int, lat_max int, "
    "crash double, startup_fail double, hang double"
)

LIMITS_SCHEMA = "machine string, component string, limit double"

# Process records. The simulated form nests memory_info; the agent form writes two attributes as named tuples,
# which are first read as text and then turned into structs.
SIMULATED_PROCESS = (
    "array<struct<pid:bigint,name:string,username:string,cpu_percent:double,"
    "memory_info:struct<rss:bigint,vms:bigint>>>"
)

AGENT_PROCESS_RAW = (
    "array<struct<pid:bigint,name:string,username:string,status:string,create_time:double,cpu_percent:double,"
    "memory_info:string,num_threads:int,exe:string,cmdline:array<string>,cpu_times:string,memory_percent:double>>"
)

# Canonical host sample: one row per machine and instant, whatever file it came from.
CANONICAL_SAMPLE = (
    "machine string, user string, ts timestamp, cpu_pct double, freq_cur_mhz double, freq_min_mhz double, "
    "freq_max_mhz double, mem_total_bytes bigint, mem_free_bytes bigint, ram_used_pct double, ram_free_pct double, "
    "swap_total_bytes bigint, swap_used_bytes bigint, swap_used_pct double, disk_used_pct double, read_bps bigint, "
    "write_bps bigint, ping_ms int, download_bps bigint, upload_bps bigint, processes string, n_processes int"
)


def struct_type(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {dtype}" for name, dtype in columns))
