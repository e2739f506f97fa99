"""Calendar derivations from the hourly ``step``.

Everything is computed on TIMESTAMP_NTZ values, so results do not depend on
the session time zone of whoever runs the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DAY_NAMES, MONTH_NAMES, SIMULATION_START


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def step_to_timestamp(step: Column | str) -> Column:
    """Step 1 is hour 0 of SIMULATION_START; one step is one hour."""
    start = F.lit(f"{SIMULATION_START} 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("HOUR", _c(step) - 1, start)


def timestamp_to_step(ts: Column | str) -> Column:
    """Inverse mapping used by sources that carry a timestamp instead of a step."""
    ts = _c(ts)
    days = F.datediff(F.to_date(ts), F.lit(SIMULATION_START).cast("date"))
    return (F.lit(1) + days * 24 + F.hour(ts)).cast("int")


def date_key_of(ts: Column | str) -> Column:
    """YYYYMMDDHH as a long."""
    ts = _c(ts)
    return (F.year(ts).cast("long") * 1000000 + F.month(ts) * 10000
            + F.dayofmonth(ts) * 100 + F.hour(ts)).cast("long")


def iso_day_of_week(ts: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(F.to_date(_c(ts))) + 1).cast("int")


def day_name(ts: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), iso_day_of_week(ts))


def month_name(ts: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(_c(ts)))


def week_of_month(ts: Column | str) -> Column:
    return F.ceil(F.dayofmonth(_c(ts)) / 7).cast("int")


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(F.to_date(_c(ts))).isin(1, 7)
