"""Budget: workbook cells to the statement table, and the actual-against-budget reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.money import money_sum, ratio, round_cents, to_number, variation_pct

FIRST_MONTH_COL = 4
ACTUAL_SHEET, BUDGET_SHEET = "Realizado", "BP"
LINE_MAP = "real_row INT, bp_row INT, label STRING, section STRING, level BIGINT, ordem INT"


class LineMapMismatch(ValueError):
    """Too many workbook labels disagree with the line map."""


def line_map(spark: SparkSession, lines=K.STATEMENT_LINES) -> DataFrame:
    return spark.createDataFrame([(*row, i) for i, row in enumerate(lines)], LINE_MAP)


def budget_from_cells(cells: DataFrame, lines: DataFrame, year: int) -> DataFrame:
    """Statement table: line x month with actual, budget, variation and the months that have actuals.

    Cells without a number and lines without a row count as 0. The cells are read
    once and keep only the rows of the line map, a constant of a few dozen rows.
    """
    month = F.col("col") - (FIRST_MONTH_COL - 1)
    value = F.round(to_number("value"), 2)
    wide = (
        cells.filter(month.between(1, 12))
        .join(_sheet_rows(lines), ["sheet", "row"])
        .groupBy("label", month.alias("m"))
        .agg(
            F.max(F.when(F.col("sheet") == ACTUAL_SHEET, value)).alias("_real"),
            F.max(F.when(F.col("sheet") == BUDGET_SHEET, value)).alias("_bp"),
        )
    )
    grid = lines.select("label", "section", "level", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    rows = grid.join(wide, ["label", "m"], "left").select(
        "label",
        "section",
        "level",
        F.format_string("%04d-%02d", F.lit(year), F.col("m")).alias("mes"),
        F.coalesce("_real", F.lit(0.0)).alias("valor_real"),
        F.coalesce("_bp", F.lit(0.0)).alias("valor_bp"),
    )
    gross = (F.col("label") == K.GROSS_REVENUE) & (F.col("valor_real") != 0)
    return rows.select(
        "*",
        variation_pct("valor_real", "valor_bp").alias("variacao_pct"),
        F.max(gross).over(Window.partitionBy("mes")).alias("mes_com_real"),
    )


def _sheet_rows(lines: DataFrame) -> DataFrame:
    """sheet, row, label of every mapped workbook line."""
    return lines.select(
        "label",
        F.explode(
            F.array(
                F.struct(F.lit(ACTUAL_SHEET).alias("sheet"), F.col("real_row").alias("row")),
                F.struct(F.lit(BUDGET_SHEET).alias("sheet"), F.col("bp_row").alias("row")),
            )
        ).alias("x"),
    ).select("label", "x.*")


def line_map_mismatches(cells: DataFrame, lines: DataFrame) -> DataFrame:
    """Labels (column 2, else 3) that neither contain nor are contained in the expected label."""
    text = F.trim("value")
    labels = (
        cells.filter(F.col("col").isin(2, 3) & (F.coalesce(text, F.lit("")) != ""))
        .groupBy("sheet", "row")
        .agg(F.min_by(text, F.col("col")).alias("encontrado"))
    )
    a, b = F.lower("label"), F.lower("encontrado")
    j = _sheet_rows(lines).join(labels, ["sheet", "row"])
    return j.filter(~a.contains(b) & ~b.contains(a)).select(
        "sheet", "row", F.col("label").alias("esperado"), "encontrado"
    )


def check_line_map(cells: DataFrame, lines: DataFrame, allowed: int = 3) -> int:
    """Number of mismatches; more than ``allowed`` stops the load."""
    n = line_map_mismatches(cells, lines).count()
    if n > allowed:
        raise LineMapMismatch(f"{n} labels do not match the line map")
    return n


def months_with_actuals(budget: DataFrame) -> DataFrame:
    return budget.filter((F.col("label") == K.GROSS_REVENUE) & (F.col("valor_real") != 0)).select("mes").distinct()


def line_order(label: Column, lines=K.STATEMENT_LINES) -> Column:
    """Report position of a line; unknown lines come last."""
    order = F.create_map(*[F.lit(x) for i, row in enumerate(lines) for x in (row[2], i)])
    return F.coalesce(F.try_element_at(order, label), F.lit(99))


def statement(budget: DataFrame) -> DataFrame:
    """One row per line in report order with maps month -> budget and month -> actual."""
    pair = lambda c: F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("mes", F.coalesce(c, F.lit(0.0)).alias("v"))))
    )
    return (
        budget.groupBy("label")
        .agg(
            F.min("section").alias("section"),
            F.min("level").alias("level"),
            pair("valor_bp").alias("bp"),
            pair("valor_real").alias("real"),
        )
        .withColumn("ordem", line_order(F.col("label")).cast("long"))
        .orderBy("ordem", "label")
    )


def statement_months(budget: DataFrame) -> DataFrame:
    """mes and whether it has actuals."""
    return budget.groupBy("mes").agg(F.max(F.coalesce("mes_com_real", F.lit(False))).alias("mes_com_real"))


def statement_pivot(budget: DataFrame, months: list[str]) -> DataFrame:
    """Actual per line and month as columns, in report order."""
    wide = budget.groupBy("label").pivot("mes", months).agg(money_sum("valor_real"))
    named = wide.select("label", *[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)).alias("m_" + m.replace("-", "_")) for m in months])
    return named.withColumn("ordem", line_order(F.col("label")).cast("long")).orderBy("ordem", "label")


def _in_months(budget: DataFrame, months: Iterable[str] | None) -> DataFrame:
    return budget if months is None else budget.filter(F.col("mes").isin(*months))


def line_totals(budget: DataFrame, months: Iterable[str] | None = None) -> DataFrame:
    """label, section, level, real, bp over the months (all if none given)."""
    return (
        _in_months(budget, months)
        .groupBy("label")
        .agg(
            F.min("section").alias("section"),
            F.min("level").alias("level"),
            money_sum("valor_real").alias("real"),
            money_sum("valor_bp").alias("bp"),
        )
    )


def budget_kpis(budget: DataFrame, months: Iterable[str] | None = None) -> DataFrame:
    """Revenue, EBITDA and net profit, actual and budget, with attainment, over one or several months."""
    b = _in_months(budget, months)
    line = lambda name: F.col("label") == name
    g = b.agg(
        money_sum("valor_real", line("Receita Bruta")).alias("receita_real"),
        money_sum("valor_bp", line("Receita Bruta")).alias("receita_bp"),
        money_sum("valor_real", line("EBITDA")).alias("ebitda_real"),
        money_sum("valor_bp", line("EBITDA")).alias("ebitda_bp"),
        money_sum("valor_real", line("Lucro Líquido")).alias("lucro_real"),
        money_sum("valor_bp", line("Lucro Líquido")).alias("lucro_bp"),
        F.count_distinct(F.when(F.col("mes_com_real"), F.col("mes"))).alias("meses_com_real"),
    )
    pct = lambda a, b: F.coalesce(ratio(F.col(a), F.col(b), 1, 100.0), F.lit(0.0))
    return g.withColumn("pct_receita", pct("receita_real", "receita_bp")).withColumn(
        "pct_ebitda", pct("ebitda_real", "ebitda_bp")
    )


def budget_series(budget: DataFrame, labels: Iterable[str] = ("Receita Bruta", "EBITDA")) -> DataFrame:
    return (
        budget.filter(F.col("label").isin(*labels))
        .groupBy("label", "mes")
        .agg(money_sum("valor_real").alias("real"), money_sum("valor_bp").alias("bp"))
    )


def accumulated(budget: DataFrame) -> DataFrame:
    """Running actual and budget per line within each year."""
    w = (
        Window.partitionBy("label", F.substring("mes", 1, 4))
        .orderBy("mes")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return budget.select(
        "label",
        "mes",
        round_cents(F.sum("valor_real").over(w)).alias("real_acum"),
        round_cents(F.sum("valor_bp").over(w)).alias("bp_acum"),
    )


def _position(label: Column, names: Iterable[str]) -> Column:
    order = F.create_map(*[F.lit(x) for i, n in enumerate(names, 1) for x in (n, i)])
    return F.try_element_at(order, label).cast("long")


def variance_waterfall(budget: DataFrame, months: Iterable[str] | None = None, lines=K.WATERFALL_LINES) -> DataFrame:
    """Actual minus budget of the main lines, then net profit, in whole units."""
    names = [*lines, K.NET_PROFIT]
    t = line_totals(budget, months).filter(F.col("label").isin(*names))
    return t.select(
        _position(F.col("label"), names).alias("ordem"),
        "label",
        F.round(round_cents(F.col("real") - F.col("bp"))).cast("long").alias("variacao"),
    ).orderBy("ordem")


def attainment(budget: DataFrame, months: Iterable[str] | None = None, lines=K.ATTAINMENT_LINES) -> DataFrame:
    """Actual as percent of budget with the 90/70 bands."""
    t = line_totals(budget, months).filter(F.col("label").isin(*lines))
    pct = F.coalesce(F.round(ratio(F.col("real"), F.col("bp"), None, 100.0)), F.lit(0.0)).cast("long")
    return t.select(
        _position(F.col("label"), lines).alias("ordem"), "label", pct.alias("pct"), attainment_band(pct).alias("faixa")
    ).orderBy("ordem")


def attainment_band(pct: Column) -> Column:
    return F.when(pct >= 90, "verde").when(pct >= 70, "amarelo").otherwise("vermelho")


def comparative(budget: DataFrame, months: Iterable[str] | None = None) -> DataFrame:
    """Actual, budget, variation and attainment per line in report order; all-zero lines are dropped."""
    t = line_totals(budget, months).filter((F.col("real") != 0) | (F.col("bp") != 0))
    real, bp = F.col("real"), F.col("bp")
    return t.select(
        line_order(F.col("label")).cast("long").alias("ordem"),
        "label",
        "section",
        "level",
        "real",
        "bp",
        round_cents(real - bp).alias("variacao"),
        variation_pct("real", "bp", 1).alias("variacao_pct"),
        ratio(real, bp, 0, 100.0).alias("atingimento_pct"),
    ).orderBy("ordem", "label")


def mini_statement(budget: DataFrame, lines=K.MINI_STATEMENT_LINES) -> DataFrame:
    """Main lines over the months with actuals; costs are good at or below budget, the rest at or above."""
    t = line_totals(budget.filter("mes_com_real"), None).filter(F.col("label").isin(*lines))
    cost = F.col("label").contains("Custo") | F.col("label").contains("Despesa")
    good = F.when(cost, F.col("real") <= F.col("bp")).otherwise(F.col("real") >= F.col("bp"))
    status = F.when(F.col("bp") == 0, "sem_orcado").when(good, "ok").otherwise("atencao")
    return t.select(
        _position(F.col("label"), lines).alias("ordem"),
        "label",
        "real",
        "bp",
        ratio(F.col("real"), F.col("bp"), 0, 100.0).alias("pct"),
        status.alias("situacao"),
    ).orderBy("ordem")


def mini_statement_from_ledger(kpis: DataFrame) -> DataFrame:
    """Three-line statement out of the period totals, for use without a budget."""
    return kpis.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("ordem"), F.lit("Receita Bruta").alias("label"), F.col("entrada").alias("real")),
                F.struct(F.lit(2).alias("ordem"), F.lit("Despesas Totais").alias("label"), (-F.col("saida")).alias("real")),
                F.struct(F.lit(3).alias("ordem"), F.lit("Resultado").alias("label"), F.col("resultado").alias("real")),
            )
        ).alias("r")
    ).select("r.*")


def statement_line(budget: DataFrame, label: str) -> DataFrame:
    """One line over the months with actuals."""
    return budget.filter((F.col("label") == label) & F.col("mes_com_real")).select(
        "mes",
        F.col("valor_real").alias("real"),
        F.col("valor_bp").alias("bp"),
        F.round("variacao_pct", 1).alias("var_pct"),
    ).orderBy("mes")


def headline_budget(budget: DataFrame) -> DataFrame:
    """Total lines (level 0) over the months with actuals."""
    return line_totals(budget.filter(F.col("mes_com_real") & (F.col("level") == 0))).select("label", "real", "bp")
