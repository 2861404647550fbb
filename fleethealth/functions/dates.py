"""Dates: parsing, formatting, and weeks that begin on Monday and are counted from the year's first one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")


def parse(c: Column, fmt: str | None = None) -> Column:
    """A timestamp, by the format and else by Spark's own rules; null where neither fits."""
    plain = F.try_to_timestamp(c)
    return F.coalesce(F.try_to_timestamp(c, F.lit(fmt)), plain) if fmt else plain


def days_between(a: Column, b: Column) -> Column:
    """Whole days between two times, in either order; 0 if one is null."""
    micros = F.abs(F.timestamp_diff("MICROSECOND", a, b))
    return F.coalesce(F.floor(micros / F.lit(86_400_000_000)), F.lit(0)).cast("long")


def spanish(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit("N/A"))


def spanish_month(c: Column) -> Column:
    return F.when(c.isNotNull(), F.element_at(F.array(*(F.lit(m) for m in MONTHS)), F.month(c))).otherwise("N/A")


def recent_months(n: int, until: Column | None = None) -> tuple[Column, Column]:
    end = F.current_timestamp() if until is None else until
    return end - F.make_ym_interval(F.lit(0), F.lit(n)), end


def week_monday(year: Column, week: Column) -> Column:
    """The Monday of a week; week 1 holds the first Monday of the year."""
    before = F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1)
    return F.date_add(F.next_day(before, "MO"), ((week - 1) * 7).cast("int"))


def week_number(c: Column) -> Column:
    """The week of a date in that count; 0 before the first Monday."""
    first = F.next_day(F.date_sub(F.make_date(F.year(c), F.lit(1), F.lit(1)), 1), "MO")
    return F.floor((F.date_diff(c.cast("date"), first) + 7) / 7).cast("int")


def week_label(year: Column, week: Column) -> Column:
    return F.format_string("W%02d-%d", week, year)


def label_order(label: Column) -> Column:
    """year * 100 + week of such a label, for sorting."""
    parts = F.split(F.substring(label, 2, 20), "-")
    return parts[1].cast("int") * 100 + parts[0].cast("int")


def version_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")
