"""Calendar conversion and dated-name parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine.functions.text import as_column, found


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("int")


def jalali(date) -> Column:
    """Solar Hijri year, month, day of a Gregorian date, in closed form.

    Years come in cycles of 33 (12053 days) made of four-year spans (1461
    days); the first six months have 31 days and the others 30.
    """
    # Day 79 of the Gregorian year 1600 opens the year 979.
    day = F.date_diff(as_column(date).cast("date"), F.lit("1600-01-01").cast("date")) - 79
    in_cycle = F.pmod(day, F.lit(12053))
    in_span = in_cycle % 1461
    later = in_span >= 366
    year = (979 + 33 * _div(day, 12053) + 4 * _div(in_cycle, 1461)
            + F.when(later, _div(in_span - 1, 365)).otherwise(0))
    left = F.when(later, (in_span - 1) % 365).otherwise(in_span)
    first_half = left < 186
    month = F.when(first_half, 1 + _div(left, 31)).otherwise(7 + _div(left - 186, 30))
    dom = F.when(first_half, 1 + left % 31).otherwise(1 + (left - 186) % 30)
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"),
                    dom.cast("int").alias("day"))


def jalali_text(date) -> Column:
    d = jalali(date)
    return F.when(as_column(date).isNotNull(), F.format_string(
        "%04d/%02d/%02d", d["year"], d["month"], d["day"]))


def stamp_in_name(name) -> Column:
    """Timestamp of a ``..._YYYYMMDD_HHMMSS...`` file name."""
    return F.try_to_timestamp(found(name, r"([0-9]{8}_[0-9]{6})"), F.lit("yyyyMMdd_HHmmss"))


def folder_stamp(name) -> Column:
    """Timestamp of a dated folder in any of its three spellings."""
    name = as_column(name)
    shapes = ((r"^[0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd_HH-mm-ss"),
              (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
              (r"^[0-9]{8}$", "yyyyMMdd"))
    return F.coalesce(*[F.when(name.rlike(rx), F.try_to_timestamp(name, F.lit(fmt)))
                        for rx, fmt in shapes])


def made_from_newer(catalog_name, scan_name) -> Column:
    """True when the catalogue is not older than the scan it is compared to."""
    return F.coalesce(stamp_in_name(catalog_name) >= stamp_in_name(scan_name), F.lit(False))


def older_than(date, run_date, days: int) -> Column:
    return as_column(date) < F.date_sub(as_column(run_date), days)
