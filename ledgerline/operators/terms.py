"""Days to collect and to pay, aging and delinquency."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions.money import cell_count, cell_sum, cells, cents, money_sum, ratio
from ledgerline.operators.flows import by_month_key
from ledgerline.operators.rows import inflow, outflow, overdue, status_in

MAX_DAYS = 120


def days_taken() -> Column:
    return F.datediff("data_pagamento", "data_emissao")


def weighted(days: Column, where: Column) -> Column:
    """Sum of days x cents. The product outgrows BIGINT on very large ledgers, so it sums as DECIMAL."""
    return F.sum(F.when(where, (days * cents("valor")).cast("decimal(20,0)"))).cast("double")


def weight(where: Column) -> Column:
    return F.sum(F.when(where, cents("valor"))).cast("double")


def _clip(max_days: int) -> Column:
    return days_taken().between(0, max_days)


def collection_days_by_month(
    ledger: DataFrame, as_of: dt.date | str, months: int = 12, max_days: int = MAX_DAYS
) -> DataFrame:
    """Value-weighted mean days to collect (pmr) and to pay (pmp) by payment month, last ``months`` months."""
    rows = ledger.filter(
        status_in(K.PAID)
        & (F.col("data_pagamento") >= D.months_back(as_of, months))
        & (F.col("data_pagamento") < D.date_lit(as_of))
        & F.col("data_emissao").isNotNull()
    )
    ok, d = _clip(max_days), days_taken()
    g = by_month_key(
        rows,
        "data_pagamento",
        weighted(d, inflow() & ok).alias("_ni"),
        weight(inflow() & ok).alias("_di"),
        weighted(d, outflow() & ok).alias("_no"),
        weight(outflow() & ok).alias("_do"),
    )
    return g.select(
        "mes",
        ratio(F.col("_ni"), F.col("_di"), 1).alias("pmr"),
        ratio(F.col("_no"), F.col("_do"), 1).alias("pmp"),
    )


def collection_days_contractual(rows: DataFrame, max_days: int = MAX_DAYS) -> DataFrame:
    """Period days taken against contractual days per side; a missing due date counts as the actual days."""
    done = (inflow() & status_in([K.RECEIVED])) | (outflow() & status_in([K.PAID_OUT]))
    ok = done & F.col("data_pagamento").isNotNull() & F.col("data_emissao").isNotNull() & _clip(max_days)
    agreed = F.coalesce(F.datediff("data_vencimento", "data_emissao"), days_taken())
    always = F.lit(True)
    g = rows.filter(ok).groupBy("tipo").agg(
        weighted(days_taken(), always).alias("_r"),
        weighted(agreed, always).alias("_c"),
        weight(always).alias("_w"),
        F.count(F.lit(1)).alias("qtd"),
    )
    return (
        g.filter("_w > 0")
        .select(
            "tipo",
            F.round(F.col("_r") / F.col("_w")).cast("long").alias("dias_real"),
            F.round(F.col("_c") / F.col("_w")).cast("long").alias("dias_contratual"),
            "qtd",
        )
        .withColumn("diferenca", F.col("dias_real") - F.col("dias_contratual"))
    )


def overdue_receivables(rows: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Overdue receivables really past due on the as-of date, with ``dias``."""
    today = D.date_lit(as_of)
    late = rows.filter(inflow() & overdue() & (F.col("data_vencimento") < today))
    return late.withColumn("dias", F.datediff(today, F.col("data_vencimento")))


def aging_buckets(rows: DataFrame, as_of: dt.date | str) -> DataFrame:
    d = F.col("dias")
    band = (
        F.when(d <= 30, "1-30 dias").when(d <= 60, "31-60 dias").when(d <= 90, "61-90 dias").otherwise("90+ dias")
    )
    return (
        overdue_receivables(rows, as_of)
        .groupBy(band.alias("faixa"))
        .agg(money_sum("valor").alias("valor"), F.count(F.lit(1)).alias("qtd"))
    )


def pct_band(pct: Column) -> Column:
    return F.when(pct > 15, "vermelho").when(pct > 5, "amarelo").otherwise("verde")


def delinquency(rows: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Overdue total, its percent of the period's inflow, titles and colour band."""
    late = overdue() & (F.col("data_vencimento") < D.date_lit(as_of))
    g = cells(rows.filter(inflow()), F.coalesce(late, F.lit(False)).alias("_late")).agg(
        cell_sum(F.col("_late")).alias("total_atrasado"),
        cell_count(F.col("_late")).alias("titulos"),
        cell_sum().alias("_ent"),
    )
    pct = F.coalesce(F.col("total_atrasado") / F.nullif("_ent", F.lit(0.0)) * 100, F.lit(0.0))
    return g.select("total_atrasado", "titulos", F.round(pct, 1).alias("pct"), pct_band(pct).alias("faixa"))


def top_delinquents(rows: DataFrame, as_of: dt.date | str, k: int = 10) -> DataFrame:
    name = F.coalesce(F.nullif("cliente_nome", F.lit("")), F.lit(K.NO_NAME))
    return (
        overdue_receivables(rows, as_of)
        .groupBy(name.alias("cliente_nome"))
        .agg(
            money_sum("valor").alias("valor"),
            F.count(F.lit(1)).alias("qtd"),
            F.max("dias").cast("long").alias("max_dias"),
        )
        .orderBy(F.desc("valor"), "cliente_nome")
        .limit(k)
    )
