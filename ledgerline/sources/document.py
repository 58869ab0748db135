"""The dashboard document: one JSON dataset per block, plus the public payroll export.

The ledger block stays distributed; only blocks that are already aggregated
carry maps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import to_number
from ledgerline.operators import budget as G
from ledgerline.operators import payroll, sales, terms


def ledger_block(ledger: DataFrame) -> DataFrame:
    day = D.show_br
    direct = F.coalesce(F.col("is_faturamento_direto"), F.lit(False))
    return ledger.withColumn("status", T.status_code("status")).select(
        "id",
        to_number("valor").alias("valor"),
        F.coalesce("tipo", F.lit("")).alias("tipo"),
        "status",
        day(D.cash_date()).alias("data"),
        day("data_vencimento").alias("data_vencimento"),
        day("data_pagamento").alias("data_pagamento"),
        day("data_previsao").alias("data_previsao"),
        day("data_emissao").alias("data_emissao"),
        F.coalesce("categoria_codigo", F.lit("")).alias("categoria"),
        F.coalesce("categoria_nome", F.lit("")).alias("categoria_nome"),
        F.col("projeto_id").alias("projeto"),
        T.or_default("projeto_nome", K.NO_PROJECT).alias("projeto_nome"),
        F.coalesce("cliente_nome", F.lit("")).alias("cliente_nome"),
        direct.alias("is_fd"),
        T.modality_or_flag("modalidade", direct).alias("modalidade"),
    )


def project_block(projects: DataFrame, ledger: DataFrame) -> DataFrame:
    """Projects that have ledger rows."""
    used = ledger.select(F.col("projeto_id").alias("id"))
    return projects.select("id", "nome").join(used, "id", "left_semi")


def balance_block(balances: DataFrame) -> DataFrame:
    return balances.select(
        F.col("conta_id").alias("id"),
        F.col("conta_nome").alias("nome"),
        F.col("conta_tipo").alias("tipo"),
        to_number("saldo").alias("saldo"),
        to_number("saldo_conciliado").alias("saldo_conciliado"),
        to_number("diferenca").alias("diferenca"),
        D.show_br("data_referencia").alias("data"),
    )


def history_block(history: DataFrame) -> DataFrame:
    """Expects the deduplicated history."""
    return history.select(
        F.col("conta_id").alias("banco_id"),
        F.col("conta_nome").alias("banco_nome"),
        D.show_iso("data_referencia").alias("data"),
        F.coalesce("label", F.lit("")).alias("label"),
        to_number("saldo_atual").alias("saldo_atual"),
        to_number("saldo_conciliado").alias("saldo_conciliado"),
        to_number("diferenca").alias("diferenca"),
        F.coalesce("tipo", F.lit("mensal")).alias("tipo"),
    )


def _map(df: DataFrame, key: str, *values: str):
    """Aggregated rows as one map column (scalar subquery)."""
    value = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    rows = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return df.agg(F.map_from_entries(rows).alias("m")).scalar()


def sales_block(items: DataFrame) -> DataFrame:
    return sales.sales_summary(items).select(
        "*",
        _map(sales.sales_by_month(items), "mes", "valor", "qtd").alias("por_mes"),
        _map(sales.sales_by_stage(items), "etapa", "qtd").alias("por_etapa"),
        _map(sales.top_products(items), "produto", "qtd", "valor").alias("top_produtos"),
    )


def client_block(clients: DataFrame) -> DataFrame:
    return sales.client_summary(clients).select(
        "*",
        _map(sales.clients_by_state(clients), "estado", "qtd").alias("por_estado"),
        _map(sales.new_clients_by_month(clients), "mes", "qtd").alias("por_mes_cadastro"),
    )


def budget_block(budget: DataFrame) -> DataFrame:
    """One row: all months, months with actuals, and the statement lines in report order."""
    months = G.statement_months(budget)
    lines = G.statement(budget).select(F.struct("ordem", "label", "section", "level", "bp", "real").alias("l"))
    # maps cannot be compared, so the few lines are ordered by their position
    by_order = lambda a, b: F.when(a.ordem < b.ordem, -1).when(a.ordem > b.ordem, 1).otherwise(0)
    return months.agg(
        F.sort_array(F.collect_list("mes")).alias("meses_disponiveis"),
        F.sort_array(F.collect_list(F.when(F.col("mes_com_real"), F.col("mes")))).alias("meses_com_real"),
    ).select("*", lines.agg(F.array_sort(F.collect_list("l"), by_order).alias("d")).scalar().alias("dre"))


def dashboard_blocks(
    ledger: DataFrame,
    categories: DataFrame,
    projects: DataFrame,
    balances: DataFrame,
    history: DataFrame,
    items: DataFrame,
    clients: DataFrame,
    budget: DataFrame | None,
    as_of: dt.date | str,
    generated_at: dt.datetime,
    role: str = "exec",
) -> dict[str, DataFrame]:
    """Block name -> frame. The budget block exists only when there is a budget; balances only for executives."""
    spark = ledger.sparkSession
    stamp = generated_at.isoformat(timespec="seconds")
    blocks = {
        "meta": spark.createDataFrame(
            [(stamp, generated_at.strftime("%d/%m/%Y às %H:%M"))], "atualizado_em STRING, atualizado_em_formatado STRING"
        ),
        "lancamentos": ledger_block(ledger),
        "categorias": categories.select("codigo", "nome"),
        "projetos": project_block(projects, ledger),
        "vendas": sales_block(items),
        "clientes": client_block(clients),
        "pmr_pmp_mensal": terms.collection_days_by_month(ledger, as_of),
    }
    if role == "exec":
        blocks["saldos_bancarios"] = balance_block(balances)
        blocks["historico_conciliacao"] = history_block(history)
    if budget is not None and not budget.isEmpty():
        blocks["orcamento"] = budget_block(budget)
    return blocks


def write_blocks(blocks: dict[str, DataFrame], path: str) -> None:
    for name, df in blocks.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct("*")).alias("json"))


def write_public_payroll(demographic: DataFrame, bands: DataFrame, path: str) -> None:
    """Aggregates only: no names, no single salaries below the area, level or role."""
    people, salaries = payroll.public_rows(demographic, bands)
    write_blocks({"demografico": people, "faixa_salarial": salaries}, path)
