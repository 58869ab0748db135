"""Which ledger rows a report reads, and by which date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D


def inflow() -> Column:
    return F.col("tipo") == K.INFLOW


def outflow() -> Column:
    return F.col("tipo") == K.OUTFLOW


def realised() -> Column:
    """Done in the reports: settled or cancelled."""
    return F.coalesce(F.col("status").isin(*K.REALISED), F.lit(False))


def status_in(names) -> Column:
    """Plain membership, so that filters reach the Parquet scan; NULL status is NULL."""
    return F.col("status").isin(*names)


def overdue() -> Column:
    return F.col("status") == K.OVERDUE


def not_overdue() -> Column:
    """Rows without a status count as not overdue."""
    return F.coalesce(F.col("status") != K.OVERDUE, F.lit(True))


def with_cash_date(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("data", D.cash_date())


def in_period(day: Column, de=None, ate=None) -> Column:
    """Never NULL: rows without the date are outside."""
    if de is None and ate is None:
        return day.isNotNull()
    return F.coalesce(in_bounds(day, de, ate), F.lit(False))


def in_bounds(day: Column, de=None, ate=None) -> Column:
    """Comparison only, NULL where the date is NULL."""
    if de is None:
        return day <= D.date_lit(ate)
    return day >= D.date_lit(de) if ate is None else day.between(D.date_lit(de), D.date_lit(ate))


def _between(df: DataFrame, col: str, de, ate) -> DataFrame:
    if de is not None:
        df = df.filter(F.col(col) >= D.date_lit(de))
    if ate is not None:
        df = df.filter(F.col(col) <= D.date_lit(ate))
    return df.filter(F.col(col).isNotNull()) if de is None and ate is None else df


def cash_rows(
    ledger: DataFrame,
    de: dt.date | str | None = None,
    ate: dt.date | str | None = None,
    project: int | None = None,
) -> DataFrame:
    """Cash basis: rows whose cash date lies in the period.

    The cash date is computed, so a filter on it cannot reach the scan. One of
    the three stored dates must lie in the period as well, and that can.
    """
    if de is not None or ate is not None:
        stored = [in_bounds(F.col(c), de, ate) for c in ("data_pagamento", "data_previsao", "data_vencimento")]
        ledger = ledger.filter(stored[0] | stored[1] | stored[2])
    rows = _between(with_cash_date(ledger), "data", de, ate)
    return rows if project is None else rows.filter(F.col("projeto_id") == project)


def accrual_rows(
    ledger: DataFrame,
    de: dt.date | str | None = None,
    ate: dt.date | str | None = None,
    project: int | None = None,
) -> DataFrame:
    """Accrual basis: due date in the period, overdue titles left out."""
    rows = _between(ledger, "data_vencimento", de, ate).filter(not_overdue())
    return rows if project is None else rows.filter(F.col("projeto_id") == project)
