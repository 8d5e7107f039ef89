"""Calendar scalars (F-D1..F-D4, F-S6, D4, D5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.text import _col

# Months that form the high season, and the meteorological
# seasons by month.
HIGH_SEASON_MONTHS = [6, 7, 8, 9]
SEASONS = {"winter": [12, 1, 2], "spring": [3, 4, 5], "summer": [6, 7, 8], "autumn": [9, 10, 11]}


def year_month(y, m) -> Column:
    """F-S6: zero-padded ``YYYY-MM`` from numeric year and month."""
    return F.format_string("%04d-%02d", _col(y), _col(m))


def ym_of(ts) -> Column:
    """``YYYY-MM`` of a date/timestamp; sorts lexicographically = chronologically."""
    return F.date_format(_col(ts), "yyyy-MM")


def month_index(ym) -> Column:
    """D-4: ``year*12 + month - 1`` from a ``YYYY-MM`` key, for lag/rolling/split logic."""
    c = _col(ym)
    return F.substring(c, 1, 4).cast("int") * 12 + F.substring(c, 6, 2).cast("int") - 1


def ym_from_index(idx) -> Column:
    c = _col(idx)
    return year_month(F.floor(c / 12), c % 12 + 1)


def weekday_mon0(d) -> Column:
    """Monday = 0 ... Sunday = 6 (Python ``date.weekday``), never ``dayofweek``."""
    return F.weekday(_col(d))


def calendar_columns(df: DataFrame, date_col: str, prefix: str = "") -> DataFrame:
    """F-D1: ISO date -> year, month, year_month, day_of_week (Mon=0), is_weekend."""
    d = F.to_date(F.col(date_col))
    return df.withColumns({
        f"{prefix}year": F.year(d),
        f"{prefix}month": F.month(d),
        f"{prefix}year_month": ym_of(d),
        f"{prefix}day_of_week": weekday_mon0(d),
        f"{prefix}is_weekend": weekday_mon0(d) >= 5,
    })


def month_start(ym) -> Column:
    """F-D2: ``YYYY-MM`` -> first day of that month."""
    return F.to_date(F.concat(_col(ym), F.lit("-01")))


def date_parts(df: DataFrame, ym_col: str) -> DataFrame:
    """F-D2/F-D3: date, year, month, quarter and the high-season flag."""
    d = month_start(ym_col)
    return df.withColumns({
        "date": d,
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "is_high_season": F.month(d).isin(HIGH_SEASON_MONTHS).cast("int"),
    })


def season(month) -> Column:
    """Meteorological season of a month number."""
    m = _col(month)
    out = None
    for name, months in SEASONS.items():
        out = (F.when(m.isin(months), F.lit(name)) if out is None
               else out.when(m.isin(months), F.lit(name)))
    return out


def period_flag(ym, start: str, end: str) -> Column:
    """Inclusive ``YYYY-MM`` range flag (e.g. 2020-01..2021-12)."""
    return _col(ym).between(F.lit(start), F.lit(end))


def range_stem(start, end) -> Column:
    """F-D4: ``YYYYMMDD_YYYYMMDD`` from two dates."""
    return F.concat(F.date_format(_col(start), "yyyyMMdd"), F.lit("_"),
                    F.date_format(_col(end), "yyyyMMdd"))


def output_stem(name, from_year=None, from_month=None, to_year=None, to_month=None) -> Column:
    """S11/F-D4: file stem of a download: the slug of its name and ``_YYYYMM_YYYYMM``, or the bare slug where a
    bound is unset (NULL)."""
    from panelkit.functions.text import slugify

    bounds = [F.lit(None).cast("int") if b is None else _col(b).cast("int") for b in (from_year, from_month, to_year, to_month)]
    span = F.format_string("_%04d%02d_%04d%02d", *bounds)
    known = bounds[0].isNotNull() & bounds[1].isNotNull() & bounds[2].isNotNull() & bounds[3].isNotNull()
    return F.concat(slugify(name), F.when(known, span).otherwise(F.lit("")))
