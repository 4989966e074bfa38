"""Calendar and cut-off expressions. The reference instant is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablescout.functions import vocabulary as V


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds to timestamp; zero, negative or null means unknown."""
    ms = ms.cast("long")
    return F.when(ms > 0, F.timestamp_millis(ms))


def months_idle(past: Column, ref: Column) -> Column:
    """Whole calendar months from `past` to `ref`, never negative, 0 for null."""
    months = ((F.year(ref) - F.year(past)) * 12 + F.month(ref) - F.month(past)
              - (F.dayofmonth(ref) < F.dayofmonth(past)).cast("int"))
    return F.greatest(F.coalesce(months, F.lit(0)), F.lit(0))


def idle_bucket(months: Column) -> Column:
    return F.least(F.greatest(F.coalesce(months, F.lit(0)), F.lit(0)), F.lit(4))


def active_levels(depth: Column) -> Column:
    """[4..depth], or just [depth] beyond four."""
    ladder = F.array(*[F.lit(x) for x in (4, 3, 2, 1)])
    return F.when(depth <= 4, F.filter(ladder, lambda u: u >= depth)).otherwise(F.array(depth))


def parse_threshold(raw: Column, default: int = V.DEFAULT_IDLE_MONTHS) -> Column:
    value = raw.cast("string").try_cast("int")
    return F.when(value.between(1, 12), value).otherwise(F.lit(default))


def parse_cutoff_days(raw: Column, default: int = V.DEFAULT_CUTOFF_DAYS) -> Column:
    value = raw.cast("string").try_cast("int")
    return F.when(value.isNull(), F.lit(default)).otherwise(F.greatest(value, F.lit(0)))


def older_than(created: Column, ref: Column, days) -> Column:
    days = days if isinstance(days, Column) else F.lit(days)
    return created < ref - F.make_interval(days=days)


def criterion_label(days: Column) -> Column:
    return (F.when(days == V.DEFAULT_CUTOFF_DAYS, F.lit("> 6 meses"))
            .when(days == 0, F.lit("sin filtro (pruebas)"))
            .otherwise(F.format_string("> %d días", days)))


def format_day(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("-"))


def reason_chip(last_run: Column, contributors: Column, months: Column) -> Column:
    return (F.when(last_run.isNull(), F.lit(V.REASON_NEVER))
            .when(F.coalesce(F.size(contributors), F.lit(0)) <= 0, F.lit(V.REASON_OWNER))
            .otherwise(F.format_string(V.REASON_IDLE, months)))


def first_filled(*cols: Column, default: str = "-") -> Column:
    """First non-null, non-empty value."""
    return F.coalesce(*[F.when(c != "", c) for c in cols], F.lit(default))
