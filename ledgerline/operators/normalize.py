"""Landed records to clean tables: titles, movements, categories, clients, orders, balances.

Lookups are left joins without hints: Spark broadcasts a lookup whose size is
below the threshold and shuffles (with skew splitting) beyond it. Payments and
clients of the ledger are always shuffled (see ``build_ledger``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import as_col, is_reject, round_cents, to_number


def last_landed(raw: DataFrame, key: str) -> DataFrame:
    """One record per key, the last in ingest order: pages shift while they are fetched and repeat records.

    Rows without ingest columns come from a table whose keys are unique.
    """
    if not {"_page", "_pos"} <= set(raw.columns):
        return raw
    latest = Window.partitionBy(key).orderBy(ingest_order().desc())
    return raw.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1").drop("_nth")


def clean_categories(raw: DataFrame) -> DataFrame:
    """codigo, nome, grupo; drops unavailable and unnamed categories."""
    raw = last_landed(raw, "codigo")
    named = F.coalesce(F.col("descricao"), F.lit("")) != ""
    return raw.filter(named & ~F.col("descricao").contains(K.UNAVAILABLE_CATEGORY)).select(
        "codigo", T.strip_code_prefix("descricao").alias("nome"), T.category_group("codigo").alias("grupo")
    )


def clean_projects(raw: DataFrame) -> DataFrame:
    raw = last_landed(raw, "codigo")
    named = F.coalesce(F.col("nome"), F.lit("")) != ""
    return raw.filter(F.col("codigo").isNotNull() & (F.col("codigo") != 0) & named).select(
        F.col("codigo").alias("id"), "nome"
    )


def client_names(raw: DataFrame) -> DataFrame:
    """id -> trade name, else legal name."""
    raw = last_landed(raw, "codigo_cliente")
    name = F.coalesce(F.nullif("nome_fantasia", F.lit("")), F.nullif("razao_social", F.lit("")))
    return raw.select(F.col("codigo_cliente").alias("id"), name.alias("nome")).filter(
        F.col("id").isNotNull() & (F.col("id") != 0) & F.col("nome").isNotNull()
    )


def clean_clients(raw: DataFrame) -> DataFrame:
    """Client registry, one row per client with an id."""
    raw = last_landed(raw, "codigo_cliente")
    return raw.filter(F.col("codigo_cliente").isNotNull() & (F.col("codigo_cliente") != 0)).select(
        F.col("codigo_cliente").alias("id"),
        F.coalesce("nome_fantasia", F.lit("")).alias("nome_fantasia"),
        F.coalesce("razao_social", F.lit("")).alias("razao_social"),
        F.nullif("estado", F.lit("")).alias("estado"),
        (~T.flag("inativo")).alias("ativo"),
        T.flag("pessoa_fisica").alias("pessoa_fisica"),
        D.parse_br_prefix("info.dInc").alias("data_cadastro"),
    )


def missing_categories(titles: DataFrame, categories: DataFrame) -> DataFrame:
    """Used codes and their groups that the category table does not know."""
    code = F.nullif("codigo_categoria", F.lit(""))
    used = titles.select(code.alias("codigo")).filter("codigo IS NOT NULL").distinct()
    both = used.select(F.explode(F.array("codigo", T.category_group("codigo"))).alias("codigo")).distinct()
    return both.join(categories.select("codigo"), "codigo", "left_anti")


def ingest_order(page: Column | str = "_page", pos: Column | str = "_pos") -> Column:
    """Page and position as one BIGINT, so that it can live in a hash aggregate's buffer."""
    return F.shiftleft(as_col(page).cast("long"), 32) + as_col(pos).cast("long")


def payment_dates(movements: DataFrame, order: Column | None = None) -> DataFrame:
    """Title id -> payment date; the last readable movement in ingest order wins."""
    day = D.parse_br("detalhes.dDtPagamento")
    order = ingest_order() if order is None else order
    rows = movements.select(
        F.col("detalhes.nCodTitulo").alias("id"), day.alias("dia"), order.alias("ordem")
    ).filter(F.col("id").isNotNull() & (F.col("id") != 0) & F.col("dia").isNotNull())
    return rows.groupBy("id").agg(F.max_by("dia", "ordem").alias("data_movimento"))


def type_titles(raw: DataFrame, tipo: str, ignored: Iterable[int] = K.IGNORED_ACCOUNTS) -> DataFrame:
    """Typed titles of one side, still without lookups. Titles without an account stay."""
    due = D.parse_br("data_vencimento")
    fiscal = F.col("numero_documento_fiscal") if "numero_documento_fiscal" in raw.columns else F.lit(None)
    return raw.filter(T.keep_account("id_conta_corrente", tuple(ignored))).select(
        F.col("codigo_lancamento").alias("id"),
        F.lit(tipo).alias("tipo"),
        to_number("valor_documento").alias("valor"),
        T.status_code("status_titulo").alias("status"),
        due.alias("data_vencimento"),
        D.parse_br("data_emissao").alias("data_emissao"),
        D.parse_br("data_previsao").alias("_previsao"),
        F.coalesce(D.parse_br("data_previsao"), due).alias("data_previsao"),
        F.coalesce("numero_documento", F.lit("")).alias("numero_documento"),
        fiscal.cast("string").alias("_fiscal"),
        F.nullif("codigo_categoria", F.lit("")).alias("categoria_codigo"),
        F.col("codigo_projeto").alias("projeto_id"),
        F.col("codigo_cliente_fornecedor").alias("cliente_id"),
        F.col("id_conta_corrente").alias("conta_corrente_id"),
    )


def build_ledger(
    receivables: DataFrame,
    payables: DataFrame,
    categories: DataFrame,
    projects: DataFrame,
    clients: DataFrame,
    payments: DataFrame,
    ignored: Iterable[int] = K.IGNORED_ACCOUNTS,
    sync_timestamp: Column | None = None,
) -> DataFrame:
    """Receivables and payables as one ledger with names, payment dates and modality.

    ``categories``: codigo, nome. ``projects``, ``clients``: id, nome.
    ``payments``: id, data_movimento (see ``payment_dates``).
    """
    ignored = tuple(ignored)
    titles = type_titles(receivables, K.INFLOW, ignored).unionByName(type_titles(payables, K.OUTFLOW, ignored))
    # Titles move twice, by id and by client: what other columns tell is left behind.
    document = T.is_direct_outflow("numero_documento", "_fiscal")
    titles = titles.withColumns({"_entrada": F.col("tipo") == K.INFLOW, "_direto": document}).drop("tipo", "data_previsao", "_fiscal")
    cat = categories.select(F.col("codigo").alias("categoria_codigo"), F.col("nome").alias("_categoria"))
    prj = projects.select(F.col("id").alias("_prj"), F.col("nome").alias("_projeto"))
    cli = clients.select(F.col("id").alias("_cli"), F.col("nome").alias("_cliente"))
    # Payments and clients grow with the ledger: they meet the titles by shuffles at any size and never pass
    # the driver. The short lists come last; their sizes are known by then, and names don't move with the titles.
    j = (
        titles.join(payments.hint("merge"), "id", "left")
        .join(cli.hint("merge"), F.coalesce("cliente_id", _nowhere("id")) == F.col("_cli"), "left")
        .join(cat, "categoria_codigo", "left")
        .join(prj, F.coalesce("projeto_id", _nowhere("id")) == F.col("_prj"), "left")
    )
    name = F.coalesce("_categoria", "categoria_codigo")
    inflow = F.col("_entrada")
    direct = F.when(inflow, T.is_direct_inflow(name)).otherwise(F.col("_direto"))
    paid = F.when(F.col("status").isin(*K.SETTLED), F.coalesce("data_movimento", "_previsao"))
    out = j.select(
        "id",
        F.when(inflow, K.INFLOW).otherwise(K.OUTFLOW).alias("tipo"),
        "valor",
        "status",
        "data_vencimento",
        "data_emissao",
        paid.alias("data_pagamento"),
        F.coalesce("_previsao", "data_vencimento").alias("data_previsao"),
        "numero_documento",
        "categoria_codigo",
        name.alias("categoria_nome"),
        T.category_group("categoria_codigo").alias("categoria_grupo"),
        "projeto_id",
        T.or_default("_projeto", K.NO_PROJECT).alias("projeto_nome"),
        "cliente_id",
        F.coalesce("_cliente", F.lit("")).alias("cliente_nome"),
        "conta_corrente_id",
        direct.alias("is_faturamento_direto"),
        T.modality(direct).alias("modalidade"),
    )
    if sync_timestamp is not None:
        out = out.withColumn("sync_timestamp", sync_timestamp).withColumn("sync_date", F.to_date("sync_timestamp"))
    return out


def _nowhere(c: str) -> Column:
    """A key that no lookup has, another for each row: rows without a key spread over all tasks of a shuffled join.

    Ids of projects and clients are positive.
    """
    return -F.abs(F.xxhash64(c) % (1 << 62)) - 1


def order_items(raw: DataFrame) -> DataFrame:
    """Sales orders, one row per item; an order without items keeps one row with NULL item columns."""
    rows = raw.select(
        F.col("cabecalho.codigo_pedido").alias("pedido_id"),
        to_number("total_pedido.valor_mercadorias").alias("valor_mercadorias"),
        T.order_stage("cabecalho.etapa").alias("etapa"),
        D.parse_br("cabecalho.data_previsao").alias("data_previsao"),
        F.explode_outer("det").alias("_item"),
    )
    has = F.col("_item").isNotNull()
    prod = F.col("_item.produto")
    return rows.select(
        "pedido_id",
        "valor_mercadorias",
        "etapa",
        "data_previsao",
        F.when(has, F.coalesce(prod.getField("descricao"), F.lit(K.NO_NAME))).alias("produto_descricao"),
        F.when(has, to_number(prod.getField("quantidade"))).alias("produto_quantidade"),
        F.when(has, to_number(prod.getField("valor_total"))).alias("produto_valor_total"),
    )


def account_balances(
    accounts: DataFrame, statements: DataFrame, reference_day: Column, ignored: Iterable[int] = K.IGNORED_ACCOUNTS
) -> DataFrame:
    """Balance of the day per account; an account without a statement counts as 0.

    ``statements``: conta_id, saldo, saldo_conciliado.
    """
    valid = F.col("nCodCC").isNotNull() & (F.col("nCodCC") != 0) & T.keep_account("nCodCC", tuple(ignored), False)
    acc = accounts.filter(valid).select(
        F.col("nCodCC").alias("conta_id"),
        F.coalesce("descricao", F.lit(K.NO_NAME)).alias("conta_nome"),
        F.coalesce("cCodTipo", "tipo", F.lit("")).alias("conta_tipo"),
    )
    j = acc.join(statements, "conta_id", "left")
    saldo, conc = F.coalesce("saldo", F.lit(0.0)), F.coalesce("saldo_conciliado", F.lit(0.0))
    return j.select(
        "conta_id",
        "conta_nome",
        "conta_tipo",
        saldo.alias("saldo"),
        conc.alias("saldo_conciliado"),
        round_cents(saldo - conc).alias("diferenca"),
        reference_day.alias("data_referencia"),
    )


def rejected_numbers(raw: DataFrame, cols: Iterable[str]) -> DataFrame:
    """How many values per column were not empty and not numeric (coerced to 0)."""
    cols = list(cols)
    counts = raw.agg(*[F.count_if(is_reject(c)).alias(c) for c in cols])
    return counts.unpivot([], cols, "coluna", "rejeitados")
