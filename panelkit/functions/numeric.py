"""Numeric scalars (F-M1..F-M4, F-C1) and exact-sum helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.text import _col


def rnd(c, digits: int) -> Column:
    """Round to ``digits`` decimals, ties away from zero (ledger L1).

    Spark's ``round``. NaN is missing (L10) and gives NULL; infinities stay.
    """
    return F.round(null_nan(c), digits)


def null_nan(c) -> Column:
    """NaN is missing. Spark keeps NaN distinct from NULL, so map it."""
    x = _col(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def clean_number(c, digits: int = 4) -> Column:
    """F-M1: NULL/NaN -> NULL, otherwise rounded to ``digits``."""
    return rnd(null_nan(c), digits)


def truncating_cast(c) -> Column:
    """F-M2: NaN/NULL -> 0, then truncate toward zero to bigint (raises on overflow)."""
    return F.coalesce(null_nan(c), F.lit(0.0)).cast("bigint")


def clip_lower(c, lower: float = 0.0) -> Column:
    x = _col(c)
    return F.when(x < F.lit(lower), F.lit(lower)).otherwise(x)


def log1p_clipped(c) -> Column:
    return F.log1p(clip_lower(c))


def sqrt_clipped(c) -> Column:
    return F.sqrt(clip_lower(c))


def exact_sum(c, scale: int = 2) -> Column:
    """Sum through DECIMAL so the result does not depend on addition order.

    Use for doubles that carry at most ``scale`` decimals (prices, amounts).
    """
    return F.sum(_col(c).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(c, scale: int = 2) -> Column:
    """Order-independent average: exact decimal sum / non-NULL count.

    Both sides are scaled to whole numbers, so that the division is the only
    step that rounds and a result of few decimals is met exactly.
    """
    units = F.sum(_col(c).cast(f"decimal(18,{scale})")) * F.lit(10 ** scale)
    return F.try_divide(units.cast("double"), F.count(_col(c)).cast("double") * F.lit(float(10 ** scale)))


def bucket(c, edges: list[float], labels: list[str]) -> Column:
    """F-C1: right-closed fixed-edge bins ``(e[i], e[i+1]]``; outside/NULL -> NULL.

    ``Bucketizer`` is left-closed, so the bins are a ``when`` chain.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(labels) + 1 edges")
    x = _col(c)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = F.lit(True)
        if lo != -math.inf:
            cond = cond & (x > F.lit(lo))
        if hi != math.inf:
            cond = cond & (x <= F.lit(hi))
        cond = x.isNotNull() & ~F.isnan(x) & cond
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def quantile_labels(c, cuts: list[Column], labels: list[str]) -> Column:
    """F-C2 helper: ``x <= q1 -> l0``, ``x <= q2 -> l1`` ... else last label.

    The lowest value lands in the first bin (pandas ``qcut`` includes it);
    repeated edges collapse onto the first matching label (ledger L15).
    """
    x = _col(c)
    out = None
    for cut, label in zip(cuts, labels[:-1]):
        cond = x <= cut
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.lit(labels[-1])))


def safe_ratio(a, b, digits: int | None = 4) -> Column:
    """``a / b`` with NULL on a zero or NULL denominator."""
    r = F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
    return rnd(r, digits) if digits is not None else r
