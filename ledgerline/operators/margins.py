"""Cost buckets, margins and the monthly financial view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import cell_count, cell_sum, cells, money_sum, ratio
from ledgerline.operators.flows import (
    by_month_key,
    group_month_cells,
    in_out,
    in_out_cells,
    month_total,
    result,
)
from ledgerline.operators.rows import inflow, outflow, overdue, realised, status_in


def bucket(group: Column, direct: str = K.DIRECT_COST_GROUP, sga=K.SGA_GROUPS) -> Column:
    return F.when(group == direct, "direto").when(group.isin(*sga), "sga").otherwise("outros")


def cost_buckets(rows: DataFrame) -> DataFrame:
    """Direct cost, SG&A, other cost and revenue, each realised and open."""
    kind = F.when(inflow(), "receita").otherwise(bucket(F.col("grupo")))
    g = cells(rows, "tipo", T.category_group("categoria_codigo").alias("grupo"), realised().alias("_done"))
    done = F.col("_done")
    return g.groupBy(kind.alias("tipo_custo")).agg(
        cell_sum(done).alias("realizado"), cell_sum(~done).alias("em_aberto")
    )


def maturity_split(rows: DataFrame) -> DataFrame:
    """To-mature against overdue per side."""
    return cells(rows, "tipo", "status").groupBy("tipo").agg(
        cell_sum(status_in(K.TO_MATURE)).alias("a_vencer"), cell_sum(overdue()).alias("atrasado")
    )


def financial_kpis(rows: DataFrame, top: int = 2) -> DataFrame:
    """Revenue, expense, result, margin and the largest expense groups as percent of revenue.

    One aggregation by (side, group) carries everything; the rest works on its few rows.
    """
    g = cells(rows, "tipo", T.category_group("categoria_codigo").alias("grupo"))
    g = g.withColumn("valor", F.col("_c") / F.lit(100.0))
    group_value = F.when(outflow() & F.col("grupo").isNotNull(), F.struct("valor", "grupo"))
    # sort: largest value first, then the lower code
    order = lambda a, b: (
        F.when(a.valor > b.valor, -1).when(a.valor < b.valor, 1).when(a.grupo < b.grupo, -1).otherwise(1)
    )
    one = g.agg(
        *in_out_cells(),
        cell_count(inflow()).alias("qtd_entradas"),
        cell_count(outflow()).alias("qtd_saidas"),
        F.array_sort(F.collect_list(group_value), order).alias("_groups"),
    )
    cols = [
        "entrada",
        "saida",
        "qtd_entradas",
        "qtd_saidas",
        result().alias("resultado"),
        F.coalesce(ratio(result(), F.col("entrada"), 1, 100.0), F.lit(0.0)).alias("margem_pct"),
    ]
    for i in range(top):
        item = F.get("_groups", F.lit(i))
        cols += [
            item.getField("grupo").alias(f"grupo_{i + 1}"),
            item.getField("valor").alias(f"valor_{i + 1}"),
            ratio(item.getField("valor"), F.col("entrada"), 1, 100.0).alias(f"pct_{i + 1}"),
        ]
    return one.select(*cols)


def _series(rows: DataFrame, date_col: str, k: int) -> DataFrame:
    """``group_month_cells`` with ``serie``: receita, direto, sga, or the code of a top-k other group.

    The ranking is a window over the few cells, other groups first.
    """
    g = group_month_cells(rows, date_col)
    kind = bucket(F.col("grupo"))
    other = outflow() & F.col("grupo").isNotNull() & (kind == "outros")
    g = g.withColumn("_other", F.coalesce(other, F.lit(False)))
    total = F.sum(F.when(F.col("_other"), F.col("_c"))).over(Window.partitionBy("grupo"))
    rank = F.dense_rank().over(Window.orderBy(F.desc("_other"), F.desc("_total"), "grupo"))
    g = g.withColumn("_total", F.when(F.col("_other"), total)).withColumn("_rank", rank)
    serie = (
        F.when(inflow(), "receita")
        .when(F.col("_other"), F.when(F.col("_rank") <= k, F.col("grupo")))
        .when(F.col("grupo").isNotNull(), kind)
    )
    return g.withColumn("serie", serie)


def monthly_cost_mix(rows: DataFrame, date_col: str = "data_vencimento", k: int = 4) -> DataFrame:
    """Revenue, direct cost, SG&A and the top other groups by month (long form)."""
    g = _series(rows, date_col, k).filter("serie IS NOT NULL").groupBy("serie", "_m").agg(cell_sum().alias("valor"))
    return g.select("serie", D.month_text("_m").alias("mes"), "valor")


def cost_pct_of_revenue(rows: DataFrame, date_col: str = "data_vencimento", k: int = 5) -> DataFrame:
    """SG&A and other groups as percent of the month's revenue; 0 where there is none."""
    g = _series(rows, date_col, k).withColumn("receita", month_total(inflow()))
    g = g.filter(~F.col("serie").isin("receita", "direto")).groupBy("serie", "_m")
    g = g.agg(cell_sum().alias("valor"), F.max("receita").alias("receita"))
    pct = F.when(F.col("receita") > 0, ratio(F.col("valor"), F.col("receita"), 2, 100.0)).otherwise(F.lit(0.0))
    return g.select("serie", D.month_text("_m").alias("mes"), pct.alias("pct"))


def monthly_result(rows: DataFrame, date_col: str = "data_vencimento") -> DataFrame:
    m = by_month_key(rows, date_col, *in_out())
    return m.select("mes", result().alias("resultado"))


def month_group_table(rows: DataFrame, groups: list[str], date_col: str = "data_vencimento") -> DataFrame:
    """Month rows plus TOTAL: revenue, one column per expense group, result and margin.

    As in the printed table, the result subtracts the listed groups only.
    """
    col = lambda g: "g_" + g.replace(".", "_")
    t = group_month_cells(rows, date_col).rollup("_m").agg(
        F.grouping("_m").alias("_g"),
        cell_sum(inflow()).alias("receita"),
        *[cell_sum(outflow() & (F.col("grupo") == g)).alias(col(g)) for g in groups],
        cell_sum(outflow() & F.col("grupo").isin(*groups)).alias("_desp"),
    )
    res = result("receita", "_desp")
    return t.select(
        F.when(F.col("_g") == 1, "TOTAL").otherwise(D.month_text("_m")).alias("mes"),
        "receita",
        *[col(g) for g in groups],
        res.alias("resultado"),
        F.when(F.col("receita") > 0, ratio(res, F.col("receita"), 1, 100.0)).otherwise(F.lit(0.0)).alias("margem_pct"),
    )


def project_totals(projects: DataFrame) -> DataFrame:
    """One row over ``flows.in_out_by_project``."""
    return projects.agg(
        F.count(F.lit(1)).alias("projetos"),
        money_sum("entrada").alias("receita"),
        money_sum("saida").alias("despesa"),
    ).withColumn("resultado", result("receita", "despesa"))


def project_detail(projects: DataFrame, search: str | None = None) -> DataFrame:
    """Result and margin per project, best first; a project with cost only has margin -100."""
    p = projects if not search else projects.filter(F.lower("projeto_nome").contains(search.lower()))
    margin = (
        F.when(F.col("entrada") > 0, ratio(result(), F.col("entrada"), 1, 100.0))
        .when(F.col("saida") > 0, F.lit(-100.0))
        .otherwise(F.lit(0.0))
    )
    return p.select("*", result().alias("resultado"), margin.alias("margem_pct")).orderBy(
        F.desc("resultado"), "projeto_id"
    )


def project_points(projects: DataFrame, floor: float = 70000.0, exclude: str = r"\bsk\b") -> DataFrame:
    """Margin against revenue for large projects: band and marker size by share of the largest revenue."""
    large = projects.filter(F.col("entrada") >= floor)
    # the maximum reads the same columns as the rows below, so both share one aggregation of the ledger
    top = F.max(F.struct("entrada", "saida", "projeto_nome", "projeto_id")).getField("entrada")
    biggest = large.agg(F.greatest(top, F.lit(1.0)).alias("m"))
    pct = (F.col("entrada") - F.col("saida")) / F.col("entrada") * 100
    band = F.when(pct >= 20, "verde").when(pct >= 0, "amarelo").otherwise("vermelho")
    return large.filter(~T.name_matches("projeto_nome", exclude)).select(
        "projeto_id",
        "projeto_nome",
        F.col("entrada").alias("receita"),
        F.col("saida").alias("despesa"),
        F.round(pct, 1).alias("margem_pct"),
        band.alias("faixa"),
        (6 + F.round(F.col("entrada") / biggest.scalar() * 12)).cast("long").alias("raio"),
    )


def top_by(df: DataFrame, key: str, value: str, k: int = 10) -> DataFrame:
    """The k largest positive values, ties broken by key."""
    return df.filter(F.col(value) > 0).select(key, value).orderBy(F.desc(value), key).limit(k)


def direct_billing_balance(rows: DataFrame) -> DataFrame:
    """Direct billing received and spent per project."""
    fd = F.coalesce(F.col("is_faturamento_direto"), F.lit(False)) & F.col("projeto_id").isNotNull()
    g = cells(rows.filter(fd & (F.col("projeto_id") != 0)), "projeto_id", "projeto_nome", "tipo").groupBy("projeto_id")
    g = g.agg(
        F.min("projeto_nome").alias("projeto_nome"),
        cell_sum(inflow()).alias("rec_fd"),
        cell_sum(outflow()).alias("desp_fd"),
    )
    return g.withColumn("diferenca", result("rec_fd", "desp_fd"))


def direct_billing_totals(balance: DataFrame, tolerance: float = 100.0) -> DataFrame:
    return balance.agg(
        F.count(F.lit(1)).alias("projetos"),
        F.count_if(F.abs("diferenca") <= tolerance).alias("equilibrados"),
        money_sum("rec_fd").alias("receita_fd"),
        money_sum("desp_fd").alias("despesa_fd"),
    ).withColumn("saldo_fd", result("receita_fd", "despesa_fd"))


def direct_billing_unbalanced(balance: DataFrame, tolerance: float = 100.0, k: int = 20) -> DataFrame:
    return (
        balance.filter(F.abs("diferenca") > tolerance)
        .orderBy(F.desc(F.abs("diferenca")), "projeto_id")
        .limit(k)
    )


def sales_kpis(rows: DataFrame, date_col: str = "data_vencimento") -> DataFrame:
    """Total, count, ticket and monthly mean of the inflow; months with any flow count."""
    months = rows.groupBy(D.month_start(date_col).alias("_m")).agg(
        money_sum("valor", inflow()).alias("valor"), F.count_if(inflow()).alias("qtd")
    )
    one = months.agg(
        money_sum("valor").alias("total"),
        F.coalesce(F.sum("qtd"), F.lit(0)).alias("qtd"),
        F.greatest(F.count("_m"), F.lit(1)).alias("meses"),
    )
    return one.select(
        "total",
        "qtd",
        "meses",
        F.coalesce(ratio(F.col("total"), F.col("qtd").cast("double"), 2), F.lit(0.0)).alias("ticket_medio"),
        F.round(F.col("total") / F.col("meses"), 2).alias("media_mensal"),
    )
