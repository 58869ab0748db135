"""Inflow and outflow by period, month, category, group, project and client.

Every function takes rows already chosen by ``rows.cash_rows`` or
``rows.accrual_rows``; ``date_col`` is ``data`` or ``data_vencimento``. Groupings
have few keys, so partial aggregation leaves next to nothing to shuffle, and
windows and pivots only ever see the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import (
    cell_count,
    cell_diff,
    cell_sum,
    cells,
    money_sum,
    ratio,
    round_cents,
)
from ledgerline.operators.rows import (
    in_period,
    inflow,
    not_overdue,
    outflow,
    overdue,
    realised,
    status_in,
    with_cash_date,
)


def in_out() -> list[Column]:
    return [money_sum("valor", inflow()).alias("entrada"), money_sum("valor", outflow()).alias("saida")]


def in_out_cells() -> list[Column]:
    """``in_out`` over ``cells`` that keep the side."""
    return [cell_sum(inflow()).alias("entrada"), cell_sum(outflow()).alias("saida")]


def split_flag() -> Column:
    return F.coalesce(F.col("is_faturamento_direto"), F.lit(False))


def split_sums() -> list[Column]:
    """SK/FD sums per side over ``cells`` that keep the side and ``_fd``."""
    fd = F.col("_fd")
    return [
        cell_sum(inflow() & ~fd).alias("ent_sk"),
        cell_sum(inflow() & fd).alias("ent_fd"),
        cell_sum(outflow() & ~fd).alias("sai_sk"),
        cell_sum(outflow() & fd).alias("sai_fd"),
    ]


def result(ent: str = "entrada", sai: str = "saida") -> Column:
    return round_cents(F.col(ent) - F.col(sai))


def by_month_key(rows: DataFrame, date_col: str, *aggs: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Groups by calendar month (and keys); the month is a DATE until after the aggregation."""
    g = rows.groupBy(D.month_start(date_col).alias("_m"), *keys).agg(*aggs)
    return g.select(D.month_text("_m").alias("mes"), *[c for c in g.columns if c != "_m"])


def period_kpis(rows: DataFrame) -> DataFrame:
    """One row of period totals: realised, open, overdue and to-mature per side."""
    g = cells(rows, "tipo", "status").agg(
        *in_out_cells(),
        cell_sum(inflow() & realised()).alias("recebido"),
        cell_sum(outflow() & realised()).alias("pago"),
        cell_sum(inflow() & ~realised()).alias("a_receber"),
        cell_sum(outflow() & ~realised()).alias("a_pagar"),
        cell_sum(inflow() & overdue()).alias("vencido_receber"),
        cell_sum(outflow() & overdue()).alias("vencido_pagar"),
        cell_sum(inflow() & status_in(K.TO_MATURE)).alias("a_vencer_receber"),
        cell_sum(outflow() & status_in(K.TO_MATURE)).alias("a_vencer_pagar"),
        cell_count(inflow()).alias("qtd_entradas"),
        cell_count(outflow()).alias("qtd_saidas"),
    )
    return g.select(
        "*",
        result().alias("resultado"),
        round_cents(F.col("recebido") - F.col("pago")).alias("resultado_realizado"),
        round_cents(F.col("a_receber") - F.col("a_pagar")).alias("resultado_a_realizar"),
        F.coalesce(ratio(result(), F.col("entrada"), 1, 100.0), F.lit(0.0)).alias("margem_pct"),
    )


def accrual_kpis(ledger: DataFrame, de=None, ate=None, project: int | None = None) -> DataFrame:
    """Accrual totals; open and overdue amounts still come from the cash rows, which keep overdue titles.

    Both row choices are flags of one scan.
    """
    rows = with_cash_date(ledger)
    if project is not None:
        rows = rows.filter(F.col("projeto_id") == project)
    g = cells(
        rows,
        "tipo",
        "status",
        in_period(F.col("data"), de, ate).alias("_cash"),
        (in_period(F.col("data_vencimento"), de, ate) & not_overdue()).alias("_acc"),
    )
    acc, cash = F.col("_acc"), F.col("_cash")
    one = g.agg(
        cell_sum(acc & inflow()).alias("entrada"),
        cell_sum(acc & outflow()).alias("saida"),
        cell_count(acc & inflow()).alias("qtd_entradas"),
        cell_count(acc & outflow()).alias("qtd_saidas"),
        cell_sum(cash & inflow() & ~realised()).alias("a_receber"),
        cell_sum(cash & outflow() & ~realised()).alias("a_pagar"),
        cell_sum(cash & inflow() & overdue()).alias("vencido_receber"),
        cell_sum(cash & outflow() & overdue()).alias("vencido_pagar"),
    )
    return one.withColumn("resultado", result())


def status_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tipo", "status").agg(money_sum("valor").alias("total"), F.count(F.lit(1)).alias("qtd"))


def in_out_by_month(rows: DataFrame, date_col: str = "data") -> DataFrame:
    return by_month_key(rows, date_col, *in_out()).withColumn("resultado", result())


def in_out_by_category(rows: DataFrame) -> DataFrame:
    """The lowest name per code; names are compared on cells, where it costs nothing."""
    code = T.or_default("categoria_codigo", K.NOT_INFORMED).alias("categoria")
    g = cells(rows, code, "categoria_nome", "tipo").groupBy("categoria")
    g = g.agg(F.min("categoria_nome").alias("nome"), *in_out_cells())
    return g.withColumn("nome", F.coalesce("nome", "categoria"))


def in_out_by_project(rows: DataFrame) -> DataFrame:
    """Per project with the SK/FD split; rows without a project are left out.

    A minimum over text cannot run in a hash aggregate, so names join the keys
    of the first step instead of being compared per title.
    """
    named = rows.filter(F.col("projeto_id").isNotNull() & (F.col("projeto_id") != 0))
    g = cells(named, "projeto_id", "projeto_nome", "tipo", split_flag().alias("_fd")).groupBy("projeto_id")
    return g.agg(F.min("projeto_nome").alias("projeto_nome"), *in_out_cells(), *split_sums())


def inflow_by_client(rows: DataFrame) -> DataFrame:
    named = F.coalesce(F.col("cliente_nome"), F.lit("")) != ""
    return rows.filter(inflow() & named).groupBy("cliente_nome").agg(money_sum("valor").alias("entrada"))


def group_names(groups: DataFrame, categories: DataFrame) -> DataFrame:
    """Adds ``nome`` of the group, falling back to its code."""
    names = categories.select(F.col("codigo").alias("grupo"), F.col("nome").alias("_nome"))
    return (
        groups.join(names, "grupo", "left").withColumn("nome", F.coalesce("_nome", "grupo")).drop("_nome")
    )


def totals_by_group(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """tipo, grupo, nome, valor."""
    g = (
        rows.withColumn("grupo", T.category_group("categoria_codigo"))
        .filter("grupo IS NOT NULL")
        .groupBy("tipo", "grupo")
        .agg(money_sum("valor").alias("valor"))
    )
    return group_names(g, categories).select("tipo", "grupo", "nome", "valor")


def group_month_cells(rows: DataFrame, date_col: str) -> DataFrame:
    """Side x category group x month in cents; the month is still a DATE ``_m``."""
    return cells(rows, "tipo", T.category_group("categoria_codigo").alias("grupo"), D.month_start(date_col).alias("_m"))


def month_total(where: Column) -> Column:
    """Month total over ``group_month_cells``, next to every cell of the month."""
    v = F.sum(F.when(where, F.col("_c"))).over(Window.partitionBy("_m"))
    return F.coalesce(v, F.lit(0)) / F.lit(100.0)


def group_month_matrix(rows: DataFrame, categories: DataFrame, date_col: str = "data") -> DataFrame:
    """Outflow per group and month with the group total, its rank and the month's revenue and outflow.

    One reduction of the rows; all totals are windows over its few cells.
    """
    g = group_month_cells(rows, date_col).select(
        "*", month_total(inflow()).alias("receita_mes"), month_total(outflow()).alias("saida_mes")
    )
    g = g.filter(outflow() & F.col("grupo").isNotNull())
    total = F.sum("_c").over(Window.partitionBy("grupo")) / F.lit(100.0)
    # dense rank over (total, code) numbers the groups 1, 2, ...
    order = F.dense_rank().over(Window.orderBy(F.desc("total_grupo"), "grupo")).cast("long")
    g = g.withColumn("total_grupo", total).withColumn("ordem", order)
    return group_names(g, categories).select(
        "grupo",
        "nome",
        D.month_text("_m").alias("mes"),
        (F.col("_c") / F.lit(100.0)).alias("valor"),
        "total_grupo",
        "ordem",
        "receita_mes",
        "saida_mes",
    )


def modality_by_month(rows: DataFrame, date_col: str = "data") -> DataFrame:
    """Monthly inflow and outflow split into SK and FD."""
    g = cells(rows, D.month_start(date_col).alias("_m"), "tipo", split_flag().alias("_fd"))
    return by_month_key(g, "_m", *split_sums())


def modality_totals(ledger: DataFrame, date_col: str = "data_pagamento") -> DataFrame:
    """Settled titles by payment month and modality: total and count."""
    rows = ledger.filter(status_in(K.PAID)).withColumn("modalidade", T.modality(F.col("is_faturamento_direto")))
    return by_month_key(
        rows, date_col, money_sum("valor").alias("total"), F.count(F.lit(1)).alias("qtd"), keys=("modalidade",)
    )


def top_groups(rows: DataFrame, categories: DataFrame, k: int = 8) -> DataFrame:
    """The k largest groups of each side, with their position."""
    g = totals_by_group(rows, categories)
    w = Window.partitionBy("tipo").orderBy(F.desc("valor"), "grupo")
    return g.withColumn("posicao", F.row_number().over(w).cast("long")).filter(F.col("posicao") <= k)


def outflow_composition(rows: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    g = totals_by_group(rows.filter(outflow()), categories).filter("valor > 0")
    return g.select("grupo", "nome", "valor").orderBy(F.desc("valor"), "grupo").limit(k)


def monthly_cash_flow(ledger: DataFrame) -> DataFrame:
    """Received and paid by payment month."""
    done = status_in([K.RECEIVED]) & inflow() | status_in([K.PAID_OUT]) & outflow()
    rows = ledger.filter(F.col("data_pagamento").isNotNull())
    return by_month_key(
        rows,
        "data_pagamento",
        money_sum("valor", inflow() & done).alias("entradas"),
        money_sum("valor", outflow() & done).alias("saidas"),
    )


def running_result(months: DataFrame) -> DataFrame:
    """Cumulated result over a month series. One row per month, so a single ordered window is fine."""
    w = Window.orderBy("mes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return months.withColumn("acumulado", round_cents(F.sum("resultado").over(w)))


def month_over_month(months: DataFrame, value: str = "entrada") -> DataFrame:
    """Previous present month and variation in percent; NULL when the previous value is not positive."""
    prev = F.lag(value).over(Window.orderBy("mes"))
    m = months.select("mes", value).withColumn("anterior", prev)
    base = F.when(F.col("anterior") > 0, F.col("anterior"))
    return m.withColumn("variacao_pct", ratio(F.col(value) - base, base, 1, 100.0))


def last_months_mean(months: DataFrame, value: str = "saida", n: int = 3) -> DataFrame:
    """Mean of the last n present months."""
    last = months.select("mes", value).orderBy(F.desc("mes")).limit(n)
    return last.agg(
        F.count(F.lit(1)).alias("meses"),
        F.coalesce(F.round(money_sum(value) / F.count(F.lit(1)), 2), F.lit(0.0)).alias("media"),
    )


def cash_flow_table(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Category rows, group subtotals and the grand total; net realised, net to realise, net total.

    ``nivel``: 0 category, 1 group, 2 total.
    """
    code = T.or_default("categoria_codigo", K.NOT_INFORMED)
    base = cells(
        rows, F.substring_index(code, ".", 2).alias("grupo"), code.alias("categoria"), "categoria_nome", "tipo",
        realised().alias("_done"),
    )
    done = F.col("_done")
    g = base.rollup("grupo", "categoria").agg(
        F.grouping_id().alias("_g"),
        F.min("categoria_nome").alias("_nome"),
        *in_out_cells(),
        cell_diff(inflow() & done, outflow() & done).alias("realizado"),
        cell_diff(inflow() & ~done, outflow() & ~done).alias("a_realizar"),
        cell_diff(inflow(), outflow()).alias("total"),
    )
    g = g.filter((F.col("_g") == 3) | (F.col("entrada") != 0) | (F.col("saida") != 0))
    names = categories.select(F.col("codigo").alias("grupo"), F.col("nome").alias("_grupo"))
    nivel = F.when(F.col("_g") == 0, 0).when(F.col("_g") == 1, 1).otherwise(2).cast("long")
    nome = (
        F.when(F.col("_g") == 0, F.coalesce("_nome", "categoria"))
        .when(F.col("_g") == 1, F.coalesce("_grupo", "grupo"))
        .otherwise(F.lit("TOTAL"))
    )
    return g.join(names, "grupo", "left").select(
        nivel.alias("nivel"), "grupo", "categoria", nome.alias("nome"), "realizado", "a_realizar", "total"
    )


def cash_flow_cube(rows: DataFrame, date_col: str = "data") -> DataFrame:
    """Net flow per group and month with both totals ('TOTAL' on either axis)."""
    code = T.or_default("categoria_codigo", K.NOT_INFORMED)
    base = cells(rows, F.substring_index(code, ".", 2).alias("grupo"), D.month_start(date_col).alias("_m"), "tipo")
    g = base.cube("grupo", "_m").agg(
        F.grouping("grupo").alias("_gg"),
        F.grouping("_m").alias("_gm"),
        cell_diff(inflow(), outflow()).alias("saldo"),
    )
    total = F.lit("TOTAL")
    return g.select(
        F.when(F.col("_gg") == 1, total).otherwise(F.col("grupo")).alias("grupo"),
        F.when(F.col("_gm") == 1, total).otherwise(D.month_text("_m")).alias("mes"),
        "saldo",
    )


def pivot_months(cells: DataFrame, key: str, value: str, months: list[str], fill: float = 0.0) -> DataFrame:
    """Month columns from long cells; the month list is given, so no extra job looks for it."""
    wide = cells.groupBy(key).pivot("mes", months).agg(F.sum(value))
    return wide.select(key, *[F.coalesce(F.col(f"`{m}`"), F.lit(fill)).alias(m) for m in months])
