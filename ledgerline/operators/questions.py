"""Fixed answers to the usual finance questions. Every date is a parameter."""

from __future__ import annotations



from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import cell_count, cell_sum, cells, money_diff, money_sum, round_cents
from ledgerline.operators.flows import by_month_key, in_out
from ledgerline.operators.rows import inflow, outflow, overdue, status_in


def _n():
    return F.count(F.lit(1)).alias("qtd")


def _top(df: DataFrame, key: str, value: str = "total", k: int | None = 20) -> DataFrame:
    out = df.orderBy(F.desc(value), key)
    return out if k is None else out.limit(k)


def _in_month(col: str, as_of):
    first, after = D.month_bounds(as_of)
    return (F.col(col) >= D.date_lit(first)) & (F.col(col) < D.date_lit(after))


def _in_week(col: str, as_of):
    first, last = D.week_bounds(as_of)
    return F.col(col).between(D.date_lit(first), D.date_lit(last))


def _in_year(col: str, as_of):
    d = D.as_date(as_of)
    return F.col(col).between(D.date_lit(d.replace(month=1, day=1)), D.date_lit(d))


def _with_project():
    return F.col("projeto_nome").isNotNull() & (F.col("projeto_nome") != K.NO_PROJECT)


# --- analysis snapshot -------------------------------------------------------


def settled_summary(ledger: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Revenue, expense and result of settled titles by payment month."""
    rows = ledger.filter(status_in(K.PAID) & (F.col("data_pagamento") >= D.months_back(as_of, months)))
    return by_month_key(
        rows,
        "data_pagamento",
        money_sum("valor", inflow()).alias("receita"),
        money_sum("valor", outflow()).alias("despesa"),
        money_diff("valor", inflow(), ~inflow()).alias("resultado"),
    )


def open_totals(ledger: DataFrame) -> DataFrame:
    """Open titles per side: total, count, overdue total and count."""
    return (
        cells(ledger.filter(status_in(K.OPEN)), "tipo", "status")
        .groupBy("tipo")
        .agg(
            cell_sum().alias("total"),
            cell_count().alias("qtd"),
            cell_sum(overdue()).alias("atrasado"),
            cell_count(overdue()).alias("qtd_atrasado"),
        )
    )


def top_expense_categories(ledger: DataFrame, as_of, months: int = 3, k: int = 10) -> DataFrame:
    rows = ledger.filter(
        outflow() & status_in([K.PAID_OUT]) & (F.col("data_pagamento") >= D.months_back(as_of, months))
    )
    return _top(rows.groupBy("categoria_nome").agg(money_sum("valor").alias("total")), "categoria_nome", k=k)


def top_revenue_clients(ledger: DataFrame, as_of, months: int = 3, k: int = 5) -> DataFrame:
    rows = ledger.filter(
        inflow() & status_in([K.RECEIVED]) & (F.col("data_pagamento") >= D.months_back(as_of, months))
    )
    return _top(rows.groupBy("cliente_nome").agg(money_sum("valor").alias("total")), "cliente_nome", k=k)


def recent_project_margins(ledger: DataFrame, as_of, months: int = 3, k: int = 10) -> DataFrame:
    rows = ledger.filter(
        _with_project() & status_in(K.PAID) & (F.col("data_pagamento") >= D.months_back(as_of, months))
    )
    g = rows.groupBy("projeto_nome").agg(
        money_sum("valor", inflow()).alias("receita"), money_sum("valor", outflow()).alias("custo")
    )
    return _top(g.filter("receita > 0 OR custo > 0"), "projeto_nome", "receita", k)


# --- recipes -----------------------------------------------------------------


def revenue_of_month(ledger: DataFrame, as_of) -> DataFrame:
    rows = ledger.filter(inflow() & status_in([K.RECEIVED]) & _in_month("data_pagamento", as_of))
    return rows.agg(money_sum("valor").alias("total_faturado"), _n())


def expected_receipts(ledger: DataFrame, as_of, k: int = 20) -> DataFrame:
    """Open receivables due in the month, by client."""
    rows = ledger.filter(inflow() & status_in(K.OPEN) & _in_month("data_vencimento", as_of))
    return _top(rows.groupBy("cliente_nome").agg(money_sum("valor").alias("total"), _n()), "cliente_nome", k=k)


def projects_issued(ledger: DataFrame, as_of) -> DataFrame:
    """Projects with documents issued in the month."""
    rows = ledger.filter(_with_project() & _in_month("data_emissao", as_of))
    return _top(rows.groupBy("projeto_nome").agg(_n(), money_sum("valor").alias("total")), "projeto_nome", k=None)


def overdue_by_supplier(ledger: DataFrame, k: int = 20) -> DataFrame:
    rows = ledger.filter(outflow() & overdue())
    return _top(rows.groupBy("cliente_nome").agg(money_sum("valor").alias("total"), _n()), "cliente_nome", k=k)


def supplier_open_items(ledger: DataFrame, words: list[str]) -> DataFrame:
    rows = ledger.filter(outflow() & status_in(K.OPEN) & T.contains_all("cliente_nome", words))
    return rows.select(
        F.round("valor", 2).alias("valor"),
        "status",
        D.show_br("data_vencimento").alias("vencimento"),
        "categoria_nome",
        "data_vencimento",
        "numero_documento",
    ).orderBy("data_vencimento", "numero_documento")


def project_margin(ledger: DataFrame) -> DataFrame:
    rows = ledger.filter(_with_project() & status_in(K.PAID))
    g = rows.groupBy("projeto_nome").agg(
        money_sum("valor", inflow()).alias("receita"),
        money_sum("valor", outflow()).alias("custo"),
        money_diff("valor", inflow(), ~inflow()).alias("margem"),
    )
    return _top(g, "projeto_nome", "margem", None)


def due_next_days(ledger: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Open receivables due within the next days."""
    today = D.date_lit(as_of)
    rows = ledger.filter(
        inflow() & status_in(K.OPEN) & F.col("data_vencimento").between(today, F.date_add(today, days))
    )
    return rows.select(
        "id", "cliente_nome", F.round("valor", 2).alias("valor"), "data_vencimento", "status"
    ).orderBy("data_vencimento", "id")


def due_this_week(ledger: DataFrame, as_of) -> DataFrame:
    rows = ledger.filter(status_in(K.OPEN) & _in_week("data_previsao", as_of))
    return rows.groupBy("tipo").agg(money_sum("valor").alias("total"), _n())


def supplier_spend(ledger: DataFrame, words: list[str], as_of) -> DataFrame:
    """Spend with one supplier: paid by month of the year, plus year and open totals, dearest month marked."""
    paid = status_in([K.PAID_OUT]) & F.coalesce(_in_year("data_pagamento", as_of), F.lit(False))
    month = F.when(paid, D.month_start("data_pagamento"))
    rows = ledger.filter(outflow() & T.contains_all("cliente_nome", words))
    g = cells(rows, month.alias("_m"), status_in(K.OPEN).alias("_open"))
    labels = (
        F.when(F.col("_m").isNotNull(), F.array(D.month_text("_m"), F.lit("ANO")))
        .when(F.col("_open"), F.array(F.lit("ABERTO")))
    )
    g = g.select("_c", "_n", F.explode(labels).alias("mes")).groupBy("mes")
    g = g.agg(cell_sum().alias("total"), cell_count().alias("qtd"))
    is_month = ~F.col("mes").isin("ANO", "ABERTO")
    place = F.row_number().over(Window.partitionBy(is_month).orderBy(F.desc("total"), F.desc("mes")))
    return g.select("mes", "total", "qtd", (is_month & (place == 1)).alias("mais_caro"))


def top_suppliers(ledger: DataFrame, as_of, k: int = 20) -> DataFrame:
    rows = ledger.filter(outflow() & status_in([K.PAID_OUT]) & _in_year("data_pagamento", as_of))
    return _top(rows.groupBy("cliente_nome").agg(money_sum("valor").alias("total"), _n()), "cliente_nome", k=k)


def loss_projects(ledger: DataFrame) -> DataFrame:
    """Projects that cost more than they earn."""
    g = ledger.filter(_with_project()).groupBy("projeto_nome").agg(*in_out())
    g = g.filter("saida > entrada").withColumn("resultado", round_cents(F.col("entrada") - F.col("saida")))
    return g.orderBy("resultado", "projeto_nome")


def project_result(ledger: DataFrame, words: list[str]) -> DataFrame:
    g = ledger.filter(T.contains_all("projeto_nome", words)).agg(*in_out())
    return g.withColumn("resultado", round_cents(F.col("entrada") - F.col("saida")))


def top_debtor(ledger: DataFrame) -> DataFrame:
    """Client that owes most, with the overdue part."""
    g = (
        ledger.filter(inflow() & status_in(K.OPEN))
        .groupBy("cliente_nome")
        .agg(money_sum("valor").alias("total"), money_sum("valor", overdue()).alias("vencido"), _n())
    )
    return _top(g, "cliente_nome", k=1)


def category_spend(ledger: DataFrame, needle: str, as_of) -> DataFrame:
    """Paid by month of the year for a category, ignoring accents and case."""
    rows = ledger.filter(
        outflow()
        & status_in([K.PAID_OUT])
        & _in_year("data_pagamento", as_of)
        & T.contains_folded("categoria_nome", needle)
    )
    return by_month_key(rows, "data_pagamento", money_sum("valor").alias("total"), _n())


def month_vs_month(ledger: DataFrame, first: str, second: str) -> DataFrame:
    """Received in two months side by side."""
    m = D.month_text("data_pagamento")
    rows = ledger.filter(inflow() & status_in([K.RECEIVED]))
    g = rows.agg(
        money_sum("valor", m == first).alias("mes_1"),
        money_sum("valor", m == second).alias("mes_2"),
    )
    diff = round_cents(F.col("mes_2") - F.col("mes_1"))
    return g.select(
        "mes_1",
        "mes_2",
        diff.alias("diferenca"),
        F.round(diff / F.nullif("mes_1", F.lit(0.0)) * 100, 1).alias("variacao_pct"),
    )


def projects_with_revenue(ledger: DataFrame, as_of) -> DataFrame:
    rows = ledger.filter(
        inflow() & status_in([K.RECEIVED]) & _with_project() & _in_month("data_pagamento", as_of)
    )
    return _top(rows.groupBy("projeto_nome").agg(money_sum("valor").alias("total"), _n()), "projeto_nome", k=None)


def issued_this_week(ledger: DataFrame, as_of) -> DataFrame:
    return ledger.filter(_in_week("data_emissao", as_of)).select(
        "tipo", "numero_documento", "cliente_nome", "data_emissao", F.round("valor", 2).alias("valor")
    )


def clients_that_paid(ledger: DataFrame, as_of) -> DataFrame:
    rows = ledger.filter(inflow() & status_in([K.RECEIVED]) & _in_month("data_pagamento", as_of))
    return _top(rows.groupBy("cliente_nome").agg(money_sum("valor").alias("total"), _n()), "cliente_nome", k=None)


def month_digest(ledger: DataFrame, balances: DataFrame, as_of) -> DataFrame:
    """Received, paid, open, overdue and balance as (indicador, valor). One scan of the ledger."""
    month = F.col("_month")
    measures = {
        "recebido": inflow() & status_in([K.RECEIVED]) & month,
        "pago": outflow() & status_in([K.PAID_OUT]) & month,
        "a_receber": inflow() & status_in(K.OPEN),
        "a_pagar": outflow() & status_in(K.OPEN),
        "receber_atrasado": inflow() & overdue(),
        "pagar_atrasado": outflow() & overdue(),
    }
    g = cells(ledger, "tipo", "status", F.coalesce(_in_month("data_pagamento", as_of), F.lit(False)).alias("_month"))
    wide = g.agg(*[cell_sum(cond).alias(name) for name, cond in measures.items()])
    long = wide.unpivot([], list(measures), "indicador", "valor")
    return long.unionByName(balances.agg(money_sum("saldo").alias("valor")).select(F.lit("saldo").alias("indicador"), "valor"))


def ledger_check(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("linhas"), F.max("data_emissao").alias("ultima_emissao"))


def by_document(ledger: DataFrame, number: str) -> DataFrame:
    return ledger.filter(F.col("numero_documento") == number)
