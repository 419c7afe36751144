"""Value-level column functions. Every one is a built-in Catalyst expression; none needs Python at run time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1024**2
GIB = 1024**3


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Apply ``use`` to a value that is computed once, however often ``use`` mentions it.

    Plain nesting copies the expression at every mention, inside CASE branches without common-subexpression
    elimination, and chains of such rules grow exponentially.
    """
    return F.transform(F.array(value), use)[0]


def parse_timestamp(text: Column) -> Column:
    """ISO text with ``T`` or blank separator to timestamp; anything else is NULL."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d"), F.try_to_timestamp(text))


def bytes_to_gib(size: Column) -> Column:
    return size / F.lit(float(GIB))


def bytes_to_mib(size: Column, digits: int | None = None) -> Column:
    mib = size / F.lit(float(MIB))
    return mib if digits is None else F.round(mib, digits)


def whole_gib(size: Column) -> Column:
    """Floor division to whole GiB, as bigint."""
    return F.call_function("div", size - F.pmod(size, F.lit(GIB)), F.lit(GIB))


def used_percent(used: Column, total: Column) -> Column:
    """Share in percent; a device of size zero is 0 % used, an unknown size is NULL."""
    return F.when(total > 0, used / total * 100).when(total.isNotNull(), F.lit(0.0))


def free_percent(free: Column, total: Column) -> Column:
    """Whole percent free, cut off (not rounded); NULL when the total is zero."""
    return truncate(F.try_divide(free, total) * 100)


def truncate(value: Column) -> Column:
    """Toward zero."""
    return value.cast("bigint")


def clamp(value: Column, low: float, high: float) -> Column:
    """Into ``[low, high]``; NULL stays NULL although least/greatest skip NULLs."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def round_or_zero(value: Column, digits: int = 2) -> Column:
    return F.coalesce(F.round(value, digits), F.lit(0.0))


def zero_if_missing(rate: Column) -> Column:
    return F.coalesce(rate, F.lit(0))


def mac_text(number: Column) -> Column:
    """48-bit integer to ``aa:bb:cc:dd:ee:ff``."""
    digits = F.lpad(F.lower(F.hex(number.bitwiseAND(F.lit(2**48 - 1)))), 12, "0")
    return F.rtrim(F.regexp_replace(digits, "(..)", "$1:"), F.lit(":"))


def machine_id(mac: Column) -> Column:
    return F.replace(mac, F.lit(":"), F.lit(""))


def first_user(login: Column, *fallbacks: Column, default: str = "desconhecido") -> Column:
    """Login name, else the first non-empty fallback, else the default."""
    return F.coalesce(login, *[F.nullif(f, F.lit("")) for f in fallbacks], F.lit(default))


def ping_millis(output: Column) -> Column:
    """Whole milliseconds from the text a ping command prints; 0 when it holds no usable time.

    Only the first line with a time counts, and the Portuguese spelling wins within it.
    """
    line = F.regexp_extract(F.lower(output), r"([^\n]*(?:tempo=|time=)[^\n]*)", 1)
    value = bind(
        line,
        lambda t: F.when(
            t.contains("tempo="), F.regexp_extract(t, r"tempo=(.*?)(?:tempo=|ms|$)", 1)
        ).otherwise(F.regexp_extract(t, r"time=(.*?)(?:time=|ms|$)", 1)),
    )
    return F.coalesce(F.trim(value).try_cast("double").try_cast("int"), F.lit(0))


def upload_stamp(ts: Column) -> Column:
    """Timestamp spelling used in object names."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH-mm-ss")


def file_stamp(ts: Column) -> Column:
    """Unpadded day-month-year-hour-minute spelling of the local file names."""
    return F.date_format(ts, "d-M-yyyy-H-m")


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month and day text, the date keys of landing and curated zones."""
    return {
        "ano": F.date_format(ts, "yyyy"),
        "mes": F.date_format(ts, "MM"),
        "dia": F.date_format(ts, "dd"),
    }


def number_text(value: Column) -> Column:
    """Double as plain decimal text with at least one decimal, never in exponent form between 1e-4 and 1e16."""
    plain = F.regexp_replace(value.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    in_range = (F.abs(value) < 1e16) & ((F.abs(value) >= 1e-4) | (value == 0))
    return F.when(in_range, plain).otherwise(value.cast("string"))


def fixed_text(value: Column, digits: int = 1) -> Column:
    """Text with a fixed number of decimals; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))


def exact_sum(value: Column) -> Column:
    """Sum as double that does not depend on the order of partitions or on task retries.

    Values below 1e16 are added up as decimals with twelve places and those below 1e28 as whole numbers, both exactly.
    What twelve places leave over, and larger, infinite and NaN values, are added as doubles. No values: NULL.
    """
    value = value.cast("double")
    size = F.abs(value)
    near = F.when(size < 1e16, value.cast("decimal(28,12)"))
    far = F.when((size >= 1e16) & (size < 1e28), value.cast("decimal(38,0)"))
    rest = F.when(size < 1e-3, value - near.cast("double")).when(~(size < 1e28), value)
    total = F.lit(0.0)
    for part in (near, far, rest):
        total = total + F.coalesce(F.sum(part).cast("double"), F.lit(0.0))
    return F.when(F.count(value) > 0, total)


def exact_avg(value: Column) -> Column:
    """Mean from an exact sum; an empty group is NULL."""
    return F.try_divide(exact_sum(value), F.count(value))
