"""Statistics with the guards that ANSI mode makes necessary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are known.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when one side is constant,
    so the same quotient is taken with ``try_divide``, which gives NULL.
    """
    x = x.cast("double")
    y = y.cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def moments(x: Column, y: Column, name: str) -> list[Column]:
    """Exact sums over the rows where two BIGINT columns are known, to be added up over groups."""
    known = x.isNotNull() & y.isNotNull()
    x, y = (F.when(known, c).cast("decimal(14,0)") for c in (x, y))
    sums = {"x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "yy": F.sum(y * y), "xy": F.sum(x * y)}
    ends = {"x_low": F.min(x), "x_high": F.max(x), "y_low": F.min(y), "y_high": F.max(y)}
    return [c.alias(f"{name}_{k}") for k, c in {"n": F.count_if(known), **sums, **ends}.items()]


def pearson_of(name: str) -> Column:
    """Pearson correlation from the moments of groups, as an aggregate; NULL when one side is constant."""
    n, x, y, xx, yy, xy = (F.sum(f"{name}_{k}").cast("double") for k in ("n", "x", "y", "xx", "yy", "xy"))
    varies = (F.min(f"{name}_x_low") < F.max(f"{name}_x_high")) & (F.min(f"{name}_y_low") < F.max(f"{name}_y_high"))
    return F.when(varies, F.try_divide(n * xy - x * y, F.sqrt(n * xx - x * x) * F.sqrt(n * yy - y * y)))


def correlation_strength(r: Column) -> Column:
    """Verbal strength of a coefficient; zero falls in the last band."""
    return (
        F.when(r.isNull(), F.lit(None).cast("string"))
        .when(r > 0.5, "forte positiva")
        .when(r > 0.2, "moderada positiva")
        .when(r > 0, "fraca positiva")
        .when(r < -0.5, "forte negativa")
        .when(r < -0.2, "moderada negativa")
        .otherwise("fraca negativa")
    )
