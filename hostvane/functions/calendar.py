"""Calendar rules: how much load a machine is expected to carry at a given hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Load per kind of day and hour, and the size of the service fleet.
SUNDAY_LOAD = 0.15
SATURDAY_LOAD = 0.50
PEAK_LOAD = 1.0
OFFICE_LOAD = 0.75
NIGHT_LOAD = 0.30
SERVICE_COUNT = 26
PEAK_MULTIPLIER = 1.15
OFF_PEAK_MULTIPLIER = 0.90


def load_factor(ts: Column) -> Column:
    """Share of the fleet expected to run: low on weekends, full in the morning and evening peaks."""
    day, hour = F.weekday(ts), F.hour(ts)
    return (
        F.when(day == 6, SUNDAY_LOAD)
        .when(day == 5, SATURDAY_LOAD)
        .when(hour.between(6, 9) | hour.between(16, 19), PEAK_LOAD)
        .when(hour.between(10, 15), OFFICE_LOAD)
        .when(ts.isNotNull(), NIGHT_LOAD)
    )


def expected_services(factor: Column, total: int = SERVICE_COUNT) -> Column:
    return F.when(factor.isNotNull(), F.greatest(F.lit(1), (factor * total).cast("int")))


def live_population(factor: Column, low: int = 4, high: int = 20) -> Column:
    """Process count of the live load test, between its two bounds."""
    return (low + (high - low) * factor).cast("int")


def load_multiplier(factor: Column) -> Column:
    return F.when(factor >= OFFICE_LOAD, PEAK_MULTIPLIER).when(factor.isNotNull(), OFF_PEAK_MULTIPLIER)


def day_part(ts: Column) -> Column:
    """MADRUGADA before 6 h, MANHA before 12 h, TARDE before 18 h, else NOITE."""
    hour = F.hour(ts)
    return (
        F.when(hour < 6, "MADRUGADA").when(hour < 12, "MANHA").when(hour < 18, "TARDE").when(hour >= 18, "NOITE")
    )
