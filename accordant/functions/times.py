"""Timestamp parsing, ages and texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp notations, tried in order.
TIMESTAMP_FORMATS = ["dd-MM-yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"]


def parse_timestamp(c: Column) -> Column:
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS]
    return F.coalesce(*tries, c.try_cast("timestamp"))


def hours_between(start: Column, end: Column) -> Column:
    """Fractional hours; both sides timestamp or timestamp_ntz."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3.6e9)


def age_hours(created: Column, closed: Column, is_terminal: Column, as_of: Column) -> Column:
    """Open cases age until ``as_of``, closed ones until they were closed; never negative."""
    end = F.coalesce(F.when(is_terminal, closed), as_of)
    return F.greatest(F.lit(0.0), hours_between(created, end))


def kpi_age_hours(created: Column, closed: Column, today: str) -> Column:
    """Age as the KPI page counts it: until closing, or until the last second of ``today``."""
    end = F.coalesce(closed, F.lit(f"{today} 23:59:59").cast("timestamp"))
    return F.coalesce(F.greatest(F.lit(0.0), hours_between(created, end)), F.lit(0.0))


def iso_seconds(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def sla_text(age: Column, breach: Column, sla_hours: int) -> Column:
    """Display text of the queue's SLA column (the page shows the age figure with unit h)."""
    shown = F.concat(F.round(age.cast("decimal(28,10)"), 0).cast("decimal(28,0)").cast("string"), F.lit("h"))
    return F.when(breach, F.concat(F.lit("BREACH "), shown)).otherwise(
        F.concat(shown, F.lit(f" / {sla_hours}h")))
