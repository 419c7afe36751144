"""Classification of samples. Codes are returned; ``label_text`` gives the wording shown to users.

All rules are CASE chains without a catch-all branch, so a NULL input gives a NULL status.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the rules.
LIMIT_BAND = 15.0
SWAP_STEPS = (5.0, 20.0, 50.0)
PING_STEPS = (50, 200)
DEGRADED_FREQ_SHARE = 0.5
BOTTLENECK_FREQ_SHARE = 0.6
BUSY_CPU_PCT = 50.0
LOW_MEMORY_GIB = 48.15
SEVERITY_STEPS = (60.0, 80.0)

# The wording of each status as users see it (spelling included).
LIMIT_TEXT = {"CRITICO": "CRÍTICO", "ATENCAO": "ATENÇÃO", "NORMAL": "Normal"}
SWAP_TEXT = {"NORMAL": "Normal", "ATENCAO": "Atenção", "ALERTA": "ALERTA", "CRITICO": "CRÍTICO"}
PING_TEXT = {
    "BAIXA": "Baixa latência",
    "MODERADA": "Latência moderada (Alerta)",
    "ALTA": "Latêcia alta (Critico)",
}
DEGRADATION_TEXT = {
    "DEGRADADA": "Possivel degradação da CPU devido a temperatura muito elevada (Baixa freqência de mhz e alto percentual de uso)",  # noqa: E501
    "SEM_INDICIOS": "Sem indicios de degradação na CPU",
}


def limit_status(value: Column, limit: Column, band: float = LIMIT_BAND) -> Column:
    """Against a limit: CRITICO from the limit on, ATENCAO within ``band`` below it, else NORMAL."""
    return (
        F.when(value >= limit, "CRITICO")
        .when(value >= limit - F.lit(band), "ATENCAO")
        .when(value < limit - F.lit(band), "NORMAL")
    )


def swap_status(percent: Column) -> Column:
    normal, attention, alert = SWAP_STEPS
    return (
        F.when(percent <= normal, "NORMAL")
        .when(percent <= attention, "ATENCAO")
        .when(percent <= alert, "ALERTA")
        .when(percent > alert, "CRITICO")
    )


def ping_status(millis: Column) -> Column:
    low, moderate = PING_STEPS
    return F.when(millis <= low, "BAIXA").when(millis <= moderate, "MODERADA").when(millis > moderate, "ALTA")


def cpu_degradation(cpu_pct: Column, freq: Column, freq_max: Column) -> Column:
    """Busy CPU at half its top frequency or less."""
    degraded = (freq <= freq_max * F.lit(DEGRADED_FREQ_SHARE)) & (cpu_pct > BUSY_CPU_PCT)
    return F.when(degraded, "DEGRADADA").when(~degraded, "SEM_INDICIOS")


def cpu_bottleneck(cpu_pct: Column, freq: Column, freq_max: Column) -> Column:
    """Flag: busy CPU strictly below 60 % of its top frequency."""
    return (cpu_pct > BUSY_CPU_PCT) & (freq < freq_max * F.lit(BOTTLENECK_FREQ_SHARE))


def low_memory(free_gib: Column, threshold: float = LOW_MEMORY_GIB) -> Column:
    return free_gib < F.lit(threshold)


def below_min_freq(freq: Column, freq_min: Column) -> Column:
    """Power saving or overheating."""
    return freq < freq_min


def severity(percent: Column, yellow: float = SEVERITY_STEPS[0], red: float = SEVERITY_STEPS[1]) -> Column:
    return F.when(percent >= red, "RED").when(percent >= yellow, "YELLOW").when(percent < yellow, "GREEN")


def label_text(code: Column, wording: dict[str, str]) -> Column:
    """Status code to user wording."""
    chain = None
    for key, text in wording.items():
        chain = F.when(code == key, text) if chain is None else chain.when(code == key, text)
    return chain
