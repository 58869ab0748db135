"""Bank balances: list, month ends and the monthly curve."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import money_sum


def balance_list(balances: DataFrame, by_size: bool = False) -> DataFrame:
    """Accounts with a balance, largest first; ``by_size`` ignores the sign."""
    key = F.abs("saldo") if by_size else F.col("saldo")
    return (
        balances.filter("saldo <> 0")
        .select(
            "conta_id",
            "conta_nome",
            T.account_type("conta_tipo").alias("tipo"),
            "saldo",
            "saldo_conciliado",
            "diferenca",
        )
        .orderBy(F.desc(key), "conta_id")
    )


def balance_total(balances: DataFrame) -> DataFrame:
    return balances.agg(
        money_sum("saldo").alias("saldo_total"),
        F.count_if(F.col("saldo") != 0).alias("contas"),
        F.count_if(F.col("diferenca") != 0).alias("contas_nao_conciliadas"),
    )


def _monthly(history: DataFrame, excluded: str | None) -> DataFrame:
    rows = history.filter("tipo = 'mensal'")
    if excluded:
        rows = rows.filter(~F.upper(F.coalesce("conta_nome", F.lit(""))).contains(excluded.upper()))
    return rows


def month_end_balances(history: DataFrame, until: dt.date | str) -> DataFrame:
    """Balance per account in the newest month up to ``until``, else in the newest month of all.

    The month is a scalar subquery, so the history scan filters on a constant.
    """
    rows = _monthly(history, None)
    m = D.month_start("data_referencia")
    limit = F.trunc(D.date_lit(until), "month")
    month = rows.agg(F.coalesce(F.max(F.when(m <= limit, m)), F.max(m)).alias("m")).scalar()
    g = (
        rows.filter(m == month)
        .groupBy("conta_nome", D.month_text("data_referencia").alias("mes"))
        .agg(money_sum("saldo_atual").alias("saldo"))
    )
    return g.filter("saldo <> 0").select("mes", "conta_nome", "saldo").orderBy(F.desc("saldo"), "conta_nome")


def balances_asof(history: DataFrame, ends: DataFrame) -> DataFrame:
    """Balance of every account at every period end: the newest month end up to it, else the account's newest.

    ``ends``: fim. The as-of join is a union: balances and period ends of an account in one order, and
    the last balance is carried on. Period ends are dates of a calendar, so few; they meet the accounts
    as one array.
    """
    rows = _monthly(history, None).select("conta_id", "conta_nome", F.col("data_referencia").alias("dia"), "saldo_atual")
    found = F.struct("dia", "saldo_atual", "conta_nome")
    known = rows.select("conta_id", "dia", found.alias("r"), F.lit(False).alias("pedido"))
    wanted = ends.agg(F.collect_set("fim")).scalar()
    asked = rows.select("conta_id").distinct().select("conta_id", F.explode(wanted).alias("dia"))
    asked = asked.select("conta_id", "dia", F.lit(None).cast(known.schema["r"].dataType).alias("r"), F.lit(True).alias("pedido"))
    upto = Window.partitionBy("conta_id").orderBy("dia", "pedido", "r").rowsBetween(Window.unboundedPreceding, 0)
    newest = F.max("r").over(Window.partitionBy("conta_id"))
    asof = known.unionByName(asked).withColumns({"antes": F.last("r", ignorenulls=True).over(upto), "novo": newest}).filter("pedido")
    value = F.coalesce("antes", "novo")
    return asof.select(
        F.col("dia").alias("fim"), "conta_id", value["conta_nome"].alias("conta_nome"), value["dia"].alias("data_referencia"), value["saldo_atual"].alias("saldo")
    )


def month_totals(history: DataFrame, excluded: str | None = None) -> DataFrame:
    g = (
        _monthly(history, excluded)
        .groupBy(D.month_start("data_referencia").alias("_m"))
        .agg(money_sum("saldo_atual").alias("saldo"))
    )
    return g.select(D.month_text("_m").alias("mes"), "saldo")


def balance_curve(
    history: DataFrame, balances: DataFrame, as_of: dt.date | str, excluded: str | None = None
) -> DataFrame:
    """Monthly total balance; the current month shows the previous-day balance."""
    current = D.as_date(as_of).strftime("%Y-%m")
    past = month_totals(history, excluded).filter(F.col("mes") != current)
    now = balances
    if excluded:
        now = now.filter(~F.upper(F.coalesce("conta_nome", F.lit(""))).contains(excluded.upper()))
    return past.unionByName(now.agg(money_sum("saldo").alias("saldo")).select(F.lit(current).alias("mes"), "saldo"))


def forecast(kpis: DataFrame, balances: DataFrame) -> DataFrame:
    """Balance plus open receivables minus open payables."""
    total: Column = balances.agg(money_sum("saldo").alias("s")).scalar()
    return kpis.select("a_receber", "a_pagar", total.alias("saldo_total")).withColumn(
        "previsao", F.round(F.col("saldo_total") + F.col("a_receber") - F.col("a_pagar"), 2)
    )
