"""Sales orders and client registry reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import money_sum, ratio


def order_headers(items: DataFrame) -> DataFrame:
    """One row per order out of the item rows.

    Header values repeat on every item, so any of them will do; the lowest is
    deterministic. The stage is text and joins the keys of a first hash
    aggregation, which also folds orders with very many items before the shuffle.
    """
    g = items.groupBy("pedido_id", "etapa").agg(
        F.min("valor_mercadorias").alias("valor_mercadorias"), F.min("data_previsao").alias("data_previsao")
    )
    first = Window.partitionBy("pedido_id").orderBy("etapa")
    one = g.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return one.select("pedido_id", "valor_mercadorias", "etapa", "data_previsao")


def sales_summary(items: DataFrame) -> DataFrame:
    g = order_headers(items).agg(
        money_sum("valor_mercadorias").alias("total_vendas"), F.count(F.lit(1)).alias("quantidade_pedidos")
    )
    ticket = ratio(F.col("total_vendas"), F.col("quantidade_pedidos").cast("double"), 2)
    return g.withColumn("ticket_medio", F.coalesce(ticket, F.lit(0.0)))


def sales_by_month(items: DataFrame) -> DataFrame:
    g = (
        order_headers(items)
        .filter("data_previsao IS NOT NULL")
        .groupBy(D.month_start("data_previsao").alias("_m"))
        .agg(money_sum("valor_mercadorias").alias("valor"), F.count(F.lit(1)).alias("qtd"))
    )
    return g.select(D.month_text("_m").alias("mes"), "valor", "qtd")


def sales_by_stage(items: DataFrame) -> DataFrame:
    return order_headers(items).groupBy("etapa").agg(F.count(F.lit(1)).alias("qtd"))


def top_products(items: DataFrame, k: int = 10) -> DataFrame:
    """Largest products by value. Orders without items count under the fallback name with 0."""
    name = T.or_default("produto_descricao", K.NO_NAME)
    return (
        items.groupBy(name.alias("produto"))
        .agg(
            F.sum(F.coalesce("produto_quantidade", F.lit(0.0)).cast("decimal(18,4)")).cast("double").alias("qtd"),
            money_sum("produto_valor_total").alias("valor"),
        )
        .orderBy(F.desc("valor"), "produto")
        .limit(k)
    )


def client_summary(clients: DataFrame) -> DataFrame:
    active, person = F.coalesce("ativo", F.lit(False)), F.coalesce("pessoa_fisica", F.lit(False))
    return clients.agg(
        F.count(F.lit(1)).alias("total_clientes"),
        F.count_if(active).alias("ativos"),
        F.count_if(~active).alias("inativos"),
        F.count_if(person).alias("pessoa_fisica"),
        F.count_if(~person).alias("pessoa_juridica"),
    )


def clients_by_state(clients: DataFrame, k: int = 15) -> DataFrame:
    g = clients.groupBy(T.or_default("estado", K.NOT_INFORMED).alias("estado")).agg(F.count(F.lit(1)).alias("qtd"))
    return g.orderBy(F.desc("qtd"), "estado").limit(k)


def new_clients_by_month(clients: DataFrame, since_year: int = 2020, last: int | None = None) -> DataFrame:
    """Sign-ups per month from a year on; ``last`` keeps the most recent months."""
    g = (
        clients.filter(F.col("data_cadastro") >= F.make_date(F.lit(since_year), F.lit(1), F.lit(1)))
        .groupBy(D.month_start("data_cadastro").alias("_m"))
        .agg(F.count(F.lit(1)).alias("qtd"))
        .select(D.month_text("_m").alias("mes"), "qtd")
    )
    return g if last is None else g.orderBy(F.desc("mes")).limit(last)
