"""Money arithmetic.

Amounts are DOUBLE in the tables. Sums run on whole cents (BIGINT): exact,
independent of the order in which partitions arrive, and several times cheaper
than wide DECIMAL buffers inside a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: Column | str) -> Column:
    """DOUBLE amount to whole cents, half away from zero."""
    c = as_col(c)
    return F.when(c >= 0, F.floor(c * 100 + 0.5)).otherwise(F.ceil(c * 100 - 0.5))


def money_sum(c: Column | str, where: Column | None = None) -> Column:
    """Exact conditional sum of an amount; 0 when nothing matches."""
    v = cents(c)
    if where is not None:
        v = F.when(where, v)
    return F.coalesce(F.sum(v), F.lit(0)) / F.lit(100.0)


def cells(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Cents and row count per key: the first step of every report with many figures.

    Reports that show a dozen conditional sums, subtotals or several groupings
    reduce the ledger to its few key combinations first and do the rest on
    those. The wide expressions then never run per ledger row, and roll-ups
    multiply a few hundred cells instead of every title.
    """
    return rows.groupBy(*keys).agg(F.sum(cents("valor")).alias("_c"), F.count(F.lit(1)).alias("_n"))


def cell_sum(where: Column | None = None) -> Column:
    """Amount over ``cells``."""
    v = F.col("_c") if where is None else F.when(where, F.col("_c"))
    return F.coalesce(F.sum(v), F.lit(0)) / F.lit(100.0)


def cell_count(where: Column | None = None) -> Column:
    v = F.col("_n") if where is None else F.when(where, F.col("_n"))
    return F.coalesce(F.sum(v), F.lit(0))


def cell_diff(plus: Column, minus: Column) -> Column:
    v = F.col("_c")
    return F.coalesce(F.sum(F.when(plus, v).when(minus, -v)), F.lit(0)) / F.lit(100.0)


def money_diff(c: Column | str, plus: Column, minus: Column) -> Column:
    """Exact ``sum(plus rows) - sum(minus rows)``."""
    v = cents(c)
    return F.coalesce(F.sum(F.when(plus, v).when(minus, -v)), F.lit(0)) / F.lit(100.0)


def round_cents(c: Column) -> Column:
    """Removes binary noise after adding or subtracting already exact amounts."""
    return cents(c) / F.lit(100.0)


def ratio(num: Column, den: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """``num / den * scale``; NULL when the denominator is 0 or NULL."""
    r = num * F.lit(scale) / F.nullif(den, F.lit(0.0))
    return r if digits is None else F.round(r, digits)


def to_number(c: Column | str) -> Column:
    """Text or number to DOUBLE; missing and unreadable values become 0."""
    return F.coalesce(as_col(c).try_cast("double"), F.lit(0.0))


def is_reject(c: Column | str) -> Column:
    """True where ``to_number`` replaced a non-empty unreadable value."""
    c = as_col(c)
    return (F.trim(c.cast("string")) != "") & c.try_cast("double").isNull()


def variation_pct(real: Column | str, planned: Column | str, digits: int = 2) -> Column:
    """(real - planned) / |planned| in percent; NULL when nothing was planned."""
    real, planned = as_col(real), as_col(planned)
    return F.round((real - planned) / F.nullif(F.abs(planned), F.lit(0.0)) * 100, digits)


def display_brl(c: Column | str) -> Column:
    """1234.5 -> 'R$ 1.234,50'."""
    c = as_col(c)
    body = F.translate(F.format_number(F.abs(c), 2), ",.", ".,")
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.lit("R$ "), body)


def display_short(c: Column | str) -> Column:
    """'R$ 1.2M', 'R$ 35K'; amounts below one thousand in full."""
    c = as_col(c)
    mag = F.abs(c)
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(mag >= 1e6, F.concat(sign, F.lit("R$ "), F.format_string("%.1fM", mag / 1e6)))
        .when(mag >= 1e3, F.concat(sign, F.lit("R$ "), F.format_string("%.0fK", mag / 1e3)))
        .otherwise(display_brl(c))
    )

