"""Landing-page figures: headline numbers, six-month series and alerts.

All of them start from ``regime_months``, one scan of the ledger that counts
each title on the cash and on the accrual basis at once. What follows works on
a handful of month rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions.money import cell_sum, cells, money_sum, ratio, round_cents
from ledgerline.operators.balances import month_totals
from ledgerline.operators.flows import in_out_cells
from ledgerline.operators.rows import in_period, inflow, not_overdue, overdue, with_cash_date
from ledgerline.operators.terms import pct_band

CASH, ACCRUAL = "caixa", "competencia"


def month_cells(ledger: DataFrame, *keys: str, de=None, ate=None) -> DataFrame:
    """Cells of (cash month, due month, side, overdue) and of further ``keys`` of the ledger."""
    due = F.col("data_vencimento")
    return cells(
        with_cash_date(ledger),
        F.when(in_period(F.col("data"), de, ate), D.month_start("data")).alias("_cash"),
        F.when(in_period(due, de, ate) & not_overdue(), D.month_start(due)).alias("_acc"),
        "tipo",
        overdue().alias("_late"),
        *keys,
    )


def months_of(g: DataFrame) -> DataFrame:
    """regime, mes, entrada, saida, vencido_receber of ``month_cells``, which count once per regime."""
    tag = lambda name, m: F.struct(F.lit(name).alias("regime"), F.col(m).alias("_m"))
    both = g.select("*", F.explode(F.array(tag(CASH, "_cash"), tag(ACCRUAL, "_acc"))).alias("_h"))
    g = (
        both.filter("_h._m IS NOT NULL")
        .groupBy(F.col("_h.regime").alias("regime"), F.col("_h._m").alias("_m"))
        .agg(*in_out_cells(), cell_sum(inflow() & F.col("_late")).alias("vencido_receber"))
    )
    return g.select("regime", D.month_text("_m").alias("mes"), "entrada", "saida", "vencido_receber")


def projects_of(g: DataFrame) -> DataFrame:
    """projeto_id, entrada, saida of ``month_cells`` by project; both null for titles without a project.

    No filter on the project, which would reach the ledger: so months and projects share the cells' exchange.
    """
    totals = g.groupBy("projeto_id").agg(*in_out_cells())
    named = lambda c: F.when(F.col("projeto_id") != 0, F.col(c)).alias(c)
    return totals.select("projeto_id", named("entrada"), named("saida"))


def regime_months(ledger: DataFrame, de=None, ate=None) -> DataFrame:
    """regime, mes, entrada, saida, vencido_receber.

    Titles are first reduced to cells of (cash month, due month, side, overdue);
    only these few cells are counted twice, once per regime.
    """
    return months_of(month_cells(ledger, de=de, ate=ate))


def _month_array(regime: str) -> Column:
    row = F.struct("mes", "entrada", "saida", "vencido_receber")
    return F.array_sort(F.collect_list(F.when(F.col("regime") == regime, row)))


def _total(months: Column, field: str) -> Column:
    return round_cents(F.aggregate(months, F.lit(0.0), lambda a, x: a + x.getField(field)))


def _current_month(months: Column, as_of: dt.date | str) -> Column:
    """The as-of month if it has rows, else the last month with inflow, else the last month."""
    this = F.lit(D.as_date(as_of).strftime("%Y-%m"))
    names = F.transform(months, lambda x: x.mes)
    earning = F.transform(F.filter(months, lambda x: x.entrada > 0), lambda x: x.mes)
    last = lambda a: F.try_element_at(a, F.lit(-1))
    return F.when(F.array_contains(names, this), this).otherwise(F.coalesce(last(earning), last(names)))


def overview_values(
    months: DataFrame, balances: DataFrame, history: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """One row, percentages and runway not rounded: revenue of the month, result, margin, delinquency, cash.

    ``months``: ``regime_months``; ``history``: deduplicated balance history.
    """
    past = month_totals(history).agg(F.array_sort(F.collect_list(F.struct("mes", "saldo"))).alias("h"))
    one = months.agg(_month_array(CASH).alias("c"), _month_array(ACCRUAL).alias("a")).select(
        "*",
        _current_month(F.col("c"), as_of).alias("mes_atual"),
        balances.agg(money_sum("saldo").alias("s")).scalar().alias("saldo_total"),
        past.scalar().alias("_h"),
    )
    cur = F.try_element_at(F.filter("c", lambda x: x.mes == F.col("mes_atual")), F.lit(1))
    prev = F.try_element_at(F.filter("c", lambda x: x.mes < F.col("mes_atual")), F.lit(-1))
    tail = F.slice("c", F.greatest(F.size("c") - 2, F.lit(1)), F.lit(3))
    one = one.select(
        "*",
        F.coalesce(cur.getField("entrada"), F.lit(0.0)).alias("receita_mes"),
        F.coalesce(cur.getField("saida"), F.lit(0.0)).alias("despesa_mes"),
        F.coalesce(prev.getField("entrada"), F.lit(0.0)).alias("receita_mes_ant"),
        _total(F.col("c"), "entrada").alias("_ent"),
        _total(F.col("c"), "vencido_receber").alias("vencido_receber"),
        _total(F.col("a"), "entrada").alias("_acc_e"),
        round_cents(_total(F.col("a"), "entrada") - _total(F.col("a"), "saida")).alias("resultado"),
        F.coalesce(ratio(_total(tail, "saida"), F.size(tail).cast("double")), F.lit(0.0)).alias("_media"),
        F.coalesce(F.get(F.col("_h"), F.size("_h") - 2).getField("saldo"), F.lit(0.0)).alias("saldo_anterior"),
    )
    pct = F.coalesce(ratio(F.col("vencido_receber"), F.col("_ent"), None, 100.0), F.lit(0.0))
    runway = F.when(F.col("_media") > 0, F.col("saldo_total") / F.col("_media")).otherwise(F.lit(99.0))
    base = F.when(F.col("receita_mes_ant") > 0, F.col("receita_mes_ant"))
    acc = F.when(F.col("_acc_e") > 0, F.col("_acc_e"))
    return one.select(
        "mes_atual",
        "receita_mes",
        "receita_mes_ant",
        "despesa_mes",
        ratio(F.col("receita_mes") - base, base, 0, 100.0).alias("var_receita_pct"),
        "resultado",
        F.coalesce(ratio(F.col("resultado"), acc, 1, 100.0), F.lit(0.0)).alias("margem_pct"),
        "vencido_receber",
        pct.alias("inadimplencia_pct"),
        pct_band(pct).alias("faixa_inadimplencia"),
        "saldo_total",
        runway.alias("meses_caixa"),
        F.when(runway >= 6, "verde").when(runway >= 3, "amarelo").otherwise("vermelho").alias("faixa_caixa"),
        "saldo_anterior",
        ratio(F.col("saldo_total") - F.col("saldo_anterior"), F.abs("saldo_anterior"), 0, 100.0).alias("var_saldo_pct"),
    )


def overview_kpis(values: DataFrame) -> DataFrame:
    """``overview_values`` as shown: percent and runway with one decimal."""
    shown = {c: F.round(c, 1) for c in ("inadimplencia_pct", "meses_caixa")}
    return values.withColumns(shown)


def overview_series(months: DataFrame, as_of: dt.date | str, n: int = 6) -> DataFrame:
    """Last n months up to the current one: cash in/out, running net, accrual margin."""
    cash, acc = F.col("regime") == CASH, F.col("regime") == ACCRUAL
    wide = months.groupBy("mes").agg(
        F.max(F.when(cash, F.col("entrada"))).alias("entrada"),
        F.max(F.when(cash, F.col("saida"))).alias("saida"),
        F.max(F.when(acc, F.col("entrada"))).alias("_ae"),
        F.max(F.when(acc, F.col("saida"))).alias("_as"),
    )
    current = months.agg(_current_month(_month_array(CASH), as_of).alias("m")).scalar()
    last = wide.filter(F.col("entrada").isNotNull() & (F.col("mes") <= current)).orderBy(F.desc("mes")).limit(n)
    running = F.sum(F.col("entrada") - F.col("saida")).over(
        Window.orderBy("mes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    e = F.coalesce("_ae", "entrada")
    s = F.when(F.col("_ae").isNotNull(), F.col("_as")).otherwise(F.col("saida"))
    margin = F.when(e > 0, F.round((e - s) / e * 100)).otherwise(F.lit(0.0))
    return last.select(
        "mes", "entrada", "saida", round_cents(running).alias("acumulado"), margin.alias("margem_pct")
    )


def alerts(
    values: DataFrame,
    projects: DataFrame,
    budget: DataFrame,
    k: int = 4,
    project_floor: float = 50000.0,
) -> DataFrame:
    """First k alerts in priority order: delinquency, runway, falling revenue, losing projects, budget beaten.

    ``values``: ``overview_values``, so thresholds see figures before rounding.
    """
    c = F.col
    rule = lambda n, cls, name, hit, value, ref: F.when(
        hit,
        F.struct(
            F.lit(n).cast("long").alias("prioridade"),
            F.lit(cls).alias("classe"),
            F.lit(name).alias("regra"),
            value.cast("double").alias("valor"),
            ref.cast("double").alias("referencia"),
        ),
    )
    from_kpis = values.select(
        F.explode(
            F.array_compact(
                F.array(
                    rule(1, "vermelho", "inadimplencia", c("inadimplencia_pct") > 10, c("vencido_receber"), c("inadimplencia_pct")),
                    rule(2, "vermelho", "caixa", c("meses_caixa") < 4, c("meses_caixa"), c("saldo_total")),
                    rule(
                        3, "amarelo", "receita",
                        (c("receita_mes_ant") > 0) & (c("receita_mes") < c("receita_mes_ant") * 0.8),
                        c("receita_mes"), c("receita_mes_ant"),
                    ),
                )
            )
        ).alias("r")
    )
    losing = projects.filter((c("entrada") > project_floor) & (c("entrada") < c("saida"))).agg(
        F.count(F.lit(1)).alias("n")
    )
    from_projects = losing.select(
        rule(4, "amarelo", "projetos_negativos", c("n") > 0, c("n"), F.lit(project_floor)).alias("r")
    )
    gross = budget.filter((c("label") == K.GROSS_REVENUE) & c("mes_com_real")).agg(
        money_sum("valor_real").alias("real"), money_sum("valor_bp").alias("bp")
    )
    from_budget = gross.select(
        rule(5, "verde", "orcamento", (c("bp") > 0) & (c("real") > c("bp") * 1.1), c("real"), c("bp")).alias("r")
    )
    every = from_kpis.unionByName(from_projects).unionByName(from_budget).filter("r IS NOT NULL")
    return every.select("r.*").orderBy("prioridade").limit(k)
