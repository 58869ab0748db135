"""Date rules. "Today" never appears: every rule takes an explicit as-of date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.money import as_col

# Short month names used on report axes.
MONTH_NAMES = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")


def as_date(d: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def date_lit(d: dt.date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(as_date(d))


def parse_br(c: Column | str) -> Column:
    """DD/MM/YYYY text (one or two digits) to DATE; anything else is NULL."""
    return F.try_to_date(as_col(c), "d/M/yyyy")


def parse_br_prefix(c: Column | str) -> Column:
    """Date from the first ten characters of a DD/MM/YYYY hh:mm text."""
    return parse_br(F.substring(as_col(c), 1, 10))


def show_br(c: Column | str) -> Column:
    return F.coalesce(F.date_format(as_col(c), "dd/MM/yyyy"), F.lit(""))


def show_iso(c: Column | str) -> Column:
    return F.coalesce(F.date_format(as_col(c), "yyyy-MM-dd"), F.lit(""))


def month_start(c: Column | str) -> Column:
    """Grouping key for months: a DATE groups much faster than its text."""
    return F.trunc(as_col(c), "month")


def month_text(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def month_label(mes: Column | str) -> Column:
    """'2026-03' -> 'Mar/26'."""
    mes = as_col(mes)
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    name = F.element_at(names, F.substring(mes, 6, 2).cast("int"))
    return F.concat(name, F.lit("/"), F.substring(mes, 3, 2))


def next_workday(c: Column | str) -> Column:
    """Saturday and Sunday move to Monday."""
    c = as_col(c)
    return F.date_add(c, F.when(F.weekday(c) == 5, 2).when(F.weekday(c) == 6, 1).otherwise(0))


def cash_date() -> Column:
    """Date on which a title hits the cash: payment when settled, else forecast, else due.

    Ledger statuses are upper case already (see ``text.status_code``).
    """
    paid = F.col("status").isin(*K.SETTLED)
    return F.when(paid & F.col("data_pagamento").isNotNull(), F.col("data_pagamento")).otherwise(
        F.coalesce(F.col("data_previsao"), F.col("data_vencimento"))
    )


def month_bounds(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """First day of the as-of month and of the next one."""
    first = as_date(as_of).replace(day=1)
    return first, (first + dt.timedelta(days=32)).replace(day=1)


def week_bounds(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """Monday and Sunday of the as-of week."""
    d = as_date(as_of)
    monday = d - dt.timedelta(days=d.weekday())
    return monday, monday + dt.timedelta(days=6)


def months_back(as_of: dt.date | str, n: int) -> Column:
    return F.add_months(date_lit(as_of), -n)


def period_columns(as_of: Column | str) -> Column:
    """All report presets as an array of (preset, de, ate).

    The open preset spans half a year on both sides of the as-of month start.
    """
    d = as_col(as_of)
    year = F.trunc(d, "year")
    quarter = F.trunc(d, "quarter")
    month = F.trunc(d, "month")

    def preset(name: str, start: Column, end: Column) -> Column:
        return F.struct(F.lit(name).alias("preset"), start.alias("de"), end.alias("ate"))

    return F.array(
        preset("mes", month, F.last_day(d)),
        preset("tri", quarter, F.last_day(F.add_months(quarter, 2))),
        preset("ano", year, F.last_day(F.add_months(year, 11))),
        preset("ytd", year, d),
        preset("padrao", F.add_months(month, -6), F.add_months(month, 6)),
    )


def month_status(mes: Column | str, as_of: dt.date | str) -> Column:
    """realizado / andamento / projecao of a 'yyyy-MM' month."""
    mes = as_col(mes)
    cur = F.lit(as_date(as_of).strftime("%Y-%m"))
    return F.when(mes < cur, "realizado").when(mes == cur, "andamento").otherwise("projecao")


def year_months(as_of: dt.date | str) -> list[str]:
    year = as_date(as_of).year
    return [f"{year}-{m:02d}" for m in range(1, 13)]
