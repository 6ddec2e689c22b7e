"""Scalar column expressions: durations, calendar parts, flags and labels.

All are plain ``Column`` expressions so they fuse into whole-stage codegen.
Trap numbers (S1...) refer to the value rules of the blueprint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateline.functions import labels as L

__all__ = [
    "col_of", "epoch_s", "stage_hours", "clip_lower", "floor_days", "late_flag",
    "safe_div", "quarter_label", "year_month", "week_label", "snapshot_label",
    "month_name", "day_name", "weekend_flag", "weekend_label", "time_period",
    "time_period_ord", "fill_unknown", "translate_category", "percent",
    "hours_to_days", "short_id", "recommended_days", "status_mark", "round4",
    "money", "scalars", "with_scalars", "erfc_sql",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_s(ts) -> Column:
    """Seconds since the epoch of a timestamp (session zone is UTC)."""
    return F.unix_timestamp(col_of(ts))


def stage_hours(end, start) -> Column:
    """Elapsed hours between two timestamps; null if either is null."""
    return (epoch_s(end) - epoch_s(start)) / F.lit(3600.0)


def clip_lower(c, lo: float = 0.0) -> Column:
    """Negative values to ``lo``; null stays null (S4: not ``greatest``)."""
    c = col_of(c)
    return F.when(c < lo, F.lit(lo)).otherwise(c)


def floor_days(end, start) -> Column:
    """Whole days as the floor of elapsed time (S1): -14 h is -1 day.
    Not ``datediff``, which counts calendar midnights."""
    return F.floor((epoch_s(end) - epoch_s(start)) / F.lit(86400)).cast("int")


def late_flag(delivered, estimate) -> Column:
    """1 if delivered after the estimate, 0 otherwise or when unknown (S3)."""
    return F.coalesce((col_of(delivered) > col_of(estimate)).cast("int"), F.lit(0))


def safe_div(num, den) -> Column:
    """Division that is null for a zero denominator (S6; ANSI-safe)."""
    return col_of(num) / F.nullif(col_of(den), F.lit(0))


def quarter_label(ts) -> Column:
    """``2017Q3``."""
    ts = col_of(ts)
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def year_month(ts) -> Column:
    """``2017-07``."""
    return F.date_format(col_of(ts), "yyyy-MM")


def week_label(ts) -> Column:
    """``%Y-W%W``: Monday-based week, days before the first Monday are week 00 (S31)."""
    ts = col_of(ts)
    week = F.floor((F.dayofyear(ts) + F.lit(6) - F.weekday(ts)) / F.lit(7)).cast("int")
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def snapshot_label(ts) -> Column:
    """``yyyyMMdd_HHmmss``."""
    return F.date_format(col_of(ts), "yyyyMMdd_HHmmss")


def month_name(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in L.MONTH_NAMES]), col_of(month).cast("int"))


def day_name(dow) -> Column:
    """Monday = 0 (S10)."""
    return F.element_at(F.array(*[F.lit(d) for d in L.DAY_NAMES]), col_of(dow).cast("int") + 1)


def weekend_flag(dow) -> Column:
    return (col_of(dow) >= 5).cast("int")


def weekend_label(flag) -> Column:
    flag = col_of(flag)
    return F.when(flag == 1, F.lit(L.WEEKEND_LABELS[1])).otherwise(F.lit(L.WEEKEND_LABELS[0]))


def time_period(hour) -> Column:
    h = col_of(hour)
    return (F.when((h >= 6) & (h < 12), F.lit(L.TIME_PERIODS[1]))
            .when((h >= 12) & (h < 18), F.lit(L.TIME_PERIODS[2]))
            .when((h >= 18) & (h < 24), F.lit(L.TIME_PERIODS[3]))
            .otherwise(F.lit(L.TIME_PERIODS[0])))


def time_period_ord(hour) -> Column:
    h = col_of(hour)
    return (F.when((h >= 6) & (h < 12), 1).when((h >= 12) & (h < 18), 2)
            .when((h >= 18) & (h < 24), 3).otherwise(0))


def fill_unknown(c) -> Column:
    return F.coalesce(col_of(c), F.lit(L.UNKNOWN))


def translate_category(english, original) -> Column:
    return F.coalesce(col_of(english), col_of(original))


def percent(c) -> Column:
    return col_of(c) * F.lit(100.0)


def hours_to_days(c) -> Column:
    """Hours to days, one decimal, half-even like pandas (S26)."""
    return F.bround(col_of(c) / F.lit(24.0), 1)


def short_id(c) -> Column:
    return F.concat(F.substring(col_of(c), 1, 8), F.lit("..."))


def recommended_days(p75) -> Column:
    """``int(p75) + 1`` for a non-negative percentile."""
    return (F.floor(col_of(p75)) + F.lit(1)).cast("int")


def status_mark(passed) -> Column:
    return F.when(col_of(passed), F.lit(L.KPI_PASS)).otherwise(F.lit(L.KPI_FAIL))


def round4(c) -> Column:
    return F.round(col_of(c), 4)


def scalars(one_row) -> dict:
    """Columns of a one-row DataFrame (a global aggregate) as the fields of one
    scalar subquery, a struct: no join, no shuffle, and one run of its plan
    however many columns it has."""
    row = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("row")).scalar()
    return {c: row.getField(c) for c in one_row.columns}


def with_scalars(df, one_row):
    """``df`` with the values of a one-row DataFrame added as columns.  The row
    is one struct first, so its plan is analysed once, not for every field."""
    row = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("row")).scalar()
    kept = [F.col(f"`{c}`") for c in df.columns if c not in one_row.columns]
    return df.withColumn("__row", row).select(*kept, *[F.col("__row").getField(c).alias(c) for c in one_row.columns])


def erfc_sql(x: str, terms: int = 60) -> str:
    """The complementary error function of a column x >= 0, as an expression
    that Spark and other SQL engines read alike: a power series of positive
    terms below 2.5, where it loses no digits, a continued fraction beyond."""
    series = "1"
    for k in range(terms, 0, -1):
        series = f"(1 + 2 * {x} * {x} / {2 * k + 1} * {series})"
    fraction = x
    for k in range(terms, 0, -1):
        fraction = f"({x} + {k / 2} / {fraction})"
    root = "sqrt(pi())"
    return (f"CASE WHEN {x} < 2.5 THEN 1 - 2 / {root} * exp(-{x} * {x}) * {x} * {series} "
            f"ELSE exp(-{x} * {x}) / {root} / {fraction} END")


def money(c) -> Column:
    """Exact money: cents as decimal so summation order cannot matter."""
    return col_of(c).cast("decimal(18,2)")
