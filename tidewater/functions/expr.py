"""Small column expressions. Everything here stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service level (percent, lower bound) -> standard normal factor.
Z_TABLE = [(99.0, 2.33), (98.0, 2.05), (95.0, 1.65), (90.0, 1.28)]
Z_DEFAULT = 1.65


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a, b, alt: float | None = 0.0) -> Column:
    """a / b as double; ``alt`` where b is zero or either side is missing."""
    ratio = F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
    return ratio if alt is None else F.coalesce(ratio, F.lit(float(alt)))


def stable_round(c, digits: int) -> Column:
    """Round half up after dropping floating noise below 1e-10.

    A sum of doubles depends on the order of the rows, so a value on a rounding
    tie could flip between two runs of the same job. Going through a decimal
    makes the mart identical for every partitioning.
    """
    return F.round(_col(c).cast("decimal(38,10)"), digits).cast("double")


def floor_round(c) -> Column:
    """Round a non-negative double to whole units."""
    return F.floor(_col(c) + F.lit(0.5)).cast("long")


def sample_std(n, total, total_sq) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    The three inputs merge by addition, so days without demand need no rows and
    a hot key is reduced before the shuffle. One observation gives NULL.
    """
    n, s, q = (_col(x).cast("double") for x in (n, total, total_sq))
    spread = F.greatest(F.lit(0.0), n * q - s * s)
    return F.when(n > 1, F.sqrt(spread / (n * (n - F.lit(1.0)))))


def tier(*rules: tuple[Column, str], otherwise: str | None) -> Column:
    """First matching rule wins."""
    (cond, label), *rest = rules
    c = F.when(cond, F.lit(label))
    for cond, label in rest:
        c = c.when(cond, F.lit(label))
    return c.otherwise(F.lit(otherwise))


def between_labels(value, bounds: list[tuple[float, str]], above: str) -> Column:
    """Label by ascending inclusive upper bounds."""
    v = _col(value)
    return tier(*[(v <= b, label) for b, label in bounds], otherwise=above)


def z_score(level) -> Column:
    level = _col(level)
    c = None
    for bound, z in Z_TABLE:
        c = F.when(level >= bound, z) if c is None else c.when(level >= bound, z)
    return c.otherwise(Z_DEFAULT)


def date_key(d) -> Column:
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def month_label(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def sum_when(cond: Column, value) -> Column:
    """Sum of ``value`` over the rows where ``cond`` holds, else 0."""
    v = _col(value) if not isinstance(value, (int, float)) else F.lit(value)
    return F.coalesce(F.sum(F.when(cond, v)), F.lit(0))
