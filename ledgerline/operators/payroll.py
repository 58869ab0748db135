"""Payroll workbook: clean rows, monthly cost, headcount, demographics and projections.

Month sheets are people x month and may be large; everything keyed by month
alone is at most twelve rows per year, so ordered windows there are harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import payroll as P
from ledgerline.functions.money import cell_sum, cents, money_sum, ratio, to_number

FIRST_MONTH_COL = 2
SUMMARY_SHEET, CASH_SHEET = "RESUMO", "FLUXO DE CAIXA"
DONE = ("realizado", "andamento")

# Columns of a month sheet; bank columns (25 to 29) are never read.
SHEET_COLUMNS = {
    "nome": 2,
    "departamento": 3,
    "cargo": 4,
    "data_admissao": 5,
    "idade": 7,
    "tempo_casa": 8,
    "salario": 9,
    "comissao": 12,
    "bonus": 13,
    "rescisao": 14,
    "caju": 15,
    "vt": 16,
    "estac": 19,
    "clinica": 20,
    "gympass": 21,
    "custo_total": 24,
}
FIRST_PERSON_ROW = 4


def month_sheet(cells: DataFrame, months: dict[str, str]) -> DataFrame:
    """Cells of the month sheets to one row per sheet line. ``months``: sheet name -> 'yyyy-MM'."""
    names = F.create_map(*[F.lit(x) for kv in months.items() for x in kv])
    wanted = cells.filter(
        F.col("sheet").isin(*months)
        & (F.col("row") >= FIRST_PERSON_ROW)
        & F.col("col").isin(*SHEET_COLUMNS.values())
    )
    return (
        wanted.groupBy(F.try_element_at(names, F.col("sheet")).alias("mes"), "row")
        .agg(*[F.max(F.when(F.col("col") == i, F.col("value"))).alias(c) for c, i in SHEET_COLUMNS.items()])
        .drop("row")
    )


def payroll_rows(sheet: DataFrame, as_of: dt.date | str) -> DataFrame:
    """People x month: totals, department subtotals and rows without a salary are dropped."""
    name = F.trim("nome")
    person = (
        (F.coalesce(F.col("nome"), F.lit("")) != "")
        & ~P.is_total_row("nome")
        & ~P.is_subtotal_row("nome", "departamento", "cargo")
        & (to_number("salario") > 0)
    )
    n = P.number2
    benefits = n("caju") + n("vt") + n("estac") + n("clinica") + n("gympass")
    return sheet.filter(person).select(
        name.alias("nome"),
        F.trim(F.coalesce("departamento", F.lit(""))).alias("departamento"),
        F.trim(F.coalesce("cargo", F.lit(""))).alias("cargo"),
        F.col("data_admissao").try_cast("date").alias("data_admissao"),
        P.age("idade").cast("long").alias("idade"),
        n("tempo_casa").alias("tempo_casa_meses"),
        n("salario").alias("salario"),
        n("comissao").alias("comissao"),
        n("bonus").alias("bonus"),
        n("rescisao").alias("rescisao"),
        F.round(benefits, 2).alias("beneficios"),
        P.recurring_cost(n("custo_total"), n("rescisao")).alias("custo_total"),
        F.col("mes").alias("mes_referencia"),
        D.month_status("mes", as_of).alias("status"),
    )


# --- summary sheet -----------------------------------------------------------


def _summary_cells(cells: DataFrame, sheet: str, year: int) -> DataFrame:
    m = F.col("col") - (FIRST_MONTH_COL - 1)
    return cells.filter((F.col("sheet") == sheet) & m.between(1, 12)).select(
        "row", F.format_string("%04d-%02d", F.lit(year), m).alias("mes"), to_number("value").alias("valor")
    )


def rubric_cost(
    cells: DataFrame, year: int, sheet: str = SUMMARY_SHEET, rubrics=K.PAYROLL_RUBRICS
) -> DataFrame:
    """mes, rubrica, valor for every rubric and the stated 'total', every month of the year; empty cells are 0."""
    rows = {**{r: k for r, (k, _) in rubrics.items()}, K.PAYROLL_TOTAL_ROW: "total"}
    names = F.create_map(*[F.lit(x) for kv in rows.items() for x in kv])
    found = (
        _summary_cells(cells, sheet, year)
        .filter(F.col("row").isin(*rows))
        .groupBy("mes", F.try_element_at(names, F.col("row")).alias("rubrica"))
        .agg(F.round(F.max("valor"), 2).alias("valor"))
    )
    spark = cells.sparkSession
    grid = (
        spark.range(1, 13)
        .select(F.format_string("%04d-%02d", F.lit(year), F.col("id").cast("int")).alias("mes"))
        .withColumn("rubrica", F.explode(F.array(*[F.lit(k) for k in rows.values()])))
    )
    return grid.join(found, ["mes", "rubrica"], "left").select("mes", "rubrica", F.coalesce("valor", F.lit(0.0)).alias("valor"))


def drop_empty_series(cost: DataFrame) -> DataFrame:
    """Leaves out rubrics that are zero in every month."""
    used = cost.groupBy("rubrica").agg(F.max("valor").alias("_m")).filter("_m > 0").select("rubrica")
    return cost.join(used, "rubrica", "left_semi")


def headcount(cells: DataFrame, year: int, sheet: str = SUMMARY_SHEET) -> DataFrame:
    """One row per month: start, hires, leavers, end and turnover."""
    v = lambda row: F.max(F.when(F.col("row") == row, F.col("valor")))
    rows = {name: row for row, name in K.HEADCOUNT_ROWS.items()}
    count = lambda name: F.coalesce(v(rows[name]), F.lit(0.0)).cast("long").alias(name)
    g = _summary_cells(cells, sheet, year).filter(F.col("row").isin(*K.HEADCOUNT_ROWS)).groupBy("mes")
    return g.agg(
        *[count(c) for c in ("inicio", "admissoes", "saida_vol", "saida_inv", "final")],
        F.round(F.coalesce(v(rows["turnover"]), F.lit(0.0)), 4).alias("turnover"),
    )


def area_cost(cells: DataFrame, year: int, sheet: str = SUMMARY_SHEET) -> DataFrame:
    """mes, area, valor; area names stand in column 1. An empty cell counts as 0."""
    first, last = K.AREA_ROWS
    areas = cells.filter(
        (F.col("sheet") == sheet) & (F.col("col") == 1) & F.col("row").between(first, last)
        & (F.coalesce("value", F.lit("")) != "") & (F.col("value") != K.AREA_TOTAL_LABEL)
    ).select("row", F.col("value").alias("area"))
    found = _summary_cells(cells, sheet, year).filter(F.col("row").between(first, last))
    return areas.join(found, "row").select("mes", "area", F.coalesce(F.round("valor", 2), F.lit(0.0)).alias("valor"))


# --- gap filling -------------------------------------------------------------


def fill_zero_months(
    cells: DataFrame,
    value: str = "valor",
    key: list[str] | None = None,
    total: tuple[str, str] | None = None,
) -> DataFrame:
    """Months whose total is zero take over all cells of the last month that is not; leading zeros stay.

    ``key``: series that are filled independently. ``total``: (column, label) of
    a stated total to judge by, else the sum of the cells.
    """
    key = key or []
    judged = F.sum(F.when(F.col(total[0]) == total[1], F.col(value))) if total else F.sum(value)
    months = cells.groupBy(*key, "mes").agg(F.coalesce(judged, F.lit(0.0)).alias("_t"))
    w = Window.partitionBy(*key).orderBy("mes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    source = F.last(F.when(F.col("_t") != 0, F.col("mes")), ignorenulls=True).over(w)
    months = months.select(*key, F.col("mes").alias("_to"), F.coalesce(source, F.col("mes")).alias("mes"))
    return cells.join(months, [*key, "mes"]).withColumn("mes", F.col("_to")).select(*cells.columns)


def fill_missing_months(cells: DataFrame, calendar: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Absent months take over all cells of the last present month; months before the first stay absent.

    ``calendar``: the wanted ``mes`` values. A month is copied whole: what is
    absent in it stays absent in the copy.
    """
    key = key or []
    have = cells.select(*key, "mes").distinct().withColumn("_has", F.col("mes"))
    if key:
        wanted = cells.select(*key).distinct().withColumn("mes", F.explode(calendar.agg(F.sort_array(F.collect_set("mes"))).scalar()))
    else:
        wanted = calendar.select("mes")
    w = Window.partitionBy(*key).orderBy("mes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    source = F.last("_has", ignorenulls=True).over(w)
    plan = (
        wanted.join(have, [*key, "mes"], "left")
        .select(*key, F.col("mes").alias("_to"), source.alias("mes"))
        .filter("mes IS NOT NULL")
    )
    return cells.join(plan, [*key, "mes"]).withColumn("mes", F.col("_to")).select(*cells.columns)


# --- aggregates over people --------------------------------------------------


def demographics(sheet: DataFrame) -> DataFrame:
    """Mean age and tenure, headcount and cost per head by month and department; 'EMPRESA' is the whole month."""
    rows = sheet.filter((F.coalesce("departamento", F.lit("")) != "") & F.col("idade").try_cast("double").isNotNull())
    parts = rows.groupBy("mes", "departamento").agg(
        F.sum(to_number("idade")).alias("_idade"),
        F.sum(to_number("tempo_casa")).alias("_casa"),
        F.sum(cents(to_number("custo_total"))).alias("_c"),
        F.count(F.lit(1)).alias("_n"),
    )
    n = F.sum("_n")
    mean = lambda c: F.round(F.sum(c) / n, 1)
    g = parts.rollup("mes", "departamento").agg(
        F.grouping("mes").alias("_gm"),
        F.grouping("departamento").alias("_gd"),
        mean("_idade").alias("idade_media"),
        mean("_casa").alias("tempo_casa_medio"),
        n.alias("hc"),
        F.round(cell_sum() / n, 2).alias("custo_per_capita"),
    )
    return g.filter("_gm = 0").select(
        "mes",
        F.when(F.col("_gd") == 1, "EMPRESA").otherwise(F.col("departamento")).alias("area"),
        "idade_media",
        "tempo_casa_medio",
        "hc",
        "custo_per_capita",
    )


def salary_bands(sheet: DataFrame, rules=K.LEVEL_RULES, default: str = K.DEFAULT_LEVEL) -> DataFrame:
    """Lowest, mean and highest salary by role, level and area in the last month that has data."""
    rows = sheet.filter((F.coalesce("cargo", F.lit("")) != "") & (to_number("salario") > 0)).select(
        "mes",
        "cargo",
        P.seniority("cargo", rules, default).alias("nivel"),
        F.nullif("departamento", F.lit("")).alias("area"),
        to_number("salario").alias("salario"),
    )
    last = rows.agg(F.max("mes").alias("m")).scalar()
    rows = rows.filter(F.col("mes") == last)
    parts = rows.groupBy("cargo", "nivel", "area").agg(
        F.min("salario").alias("_min"),
        F.max("salario").alias("_max"),
        F.sum(cents("salario")).alias("_c"),
        F.count(F.lit(1)).alias("_n"),
    )
    sets = parts.groupingSets([["cargo"], ["nivel"], ["area"]], "cargo", "nivel", "area").agg(
        F.grouping_id().alias("_g"),
        F.min("_min").alias("minimo"),
        cell_sum().alias("_soma"),
        F.max("_max").alias("maximo"),
        F.sum("_n").alias("qtd"),
    )
    kind = F.when(F.col("_g") == 3, "cargo").when(F.col("_g") == 5, "nivel").otherwise("area")
    out = sets.select(
        kind.alias("dimensao"),
        F.coalesce("cargo", "nivel", "area").alias("nome"),
        F.round("minimo", 2).alias("minimo"),
        F.round(F.col("_soma") / F.col("qtd"), 2).alias("media"),
        F.round("maximo", 2).alias("maximo"),
        "qtd",
    )
    return out.filter("nome IS NOT NULL")


# --- recipes on the restricted table ----------------------------------------


def _month(rows: DataFrame, mes: str) -> DataFrame:
    return rows.filter(F.col("mes_referencia") == mes)


def person_lookup(rows: DataFrame, name: str, mes: str) -> DataFrame:
    return (
        _month(rows, mes)
        .filter(F.lower("nome").contains(name.lower()))
        .select("nome", "cargo", "departamento", "salario", "beneficios", "custo_total")
    )


def department_cost(rows: DataFrame, mes: str) -> DataFrame:
    return (
        _month(rows, mes)
        .groupBy("departamento")
        .agg(
            F.count(F.lit(1)).alias("qtd"),
            money_sum("custo_total").alias("custo"),
            F.round(money_sum("salario") / F.count(F.lit(1)), 2).alias("sal_medio"),
        )
    )


def top_salaries(rows: DataFrame, mes: str, k: int = 10) -> DataFrame:
    return (
        _month(rows, mes)
        .select("nome", "cargo", "departamento", "salario")
        .orderBy(F.desc("salario"), "nome")
        .limit(k)
    )


def severances(rows: DataFrame, mes: str) -> DataFrame:
    return _month(rows, mes).filter("rescisao > 0").select(
        "nome", "cargo", "departamento", F.round("rescisao", 2).alias("rescisao")
    )


def public_rows(demographic: DataFrame, bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What may leave the restricted dataset: aggregates by area, level and role, no names."""
    return (
        demographic.select("mes", "area", "idade_media", "tempo_casa_medio", "hc", "custo_per_capita"),
        bands.select("dimensao", "nome", "minimo", "media", "maximo", "qtd"),
    )


# --- reports on month series -------------------------------------------------


def _done(df: DataFrame, as_of) -> DataFrame:
    return df.filter(D.month_status("mes", as_of).isin(*DONE))


def ytd_composition(cost: DataFrame, as_of, rubrics=K.PAYROLL_RUBRICS) -> DataFrame:
    """Cost by rubric label over finished and running months, before any gap filling."""
    labels = F.create_map(*[F.lit(x) for k, label in rubrics.values() for x in (k, label)])
    g = (
        _done(cost, as_of)
        .filter(F.col("rubrica") != "total")
        .groupBy(F.try_element_at(labels, F.col("rubrica")).alias("rubrica"))
        .agg(money_sum("valor").alias("valor"))
    )
    return g.filter("valor > 0")


def projected_months(cost: DataFrame, as_of) -> DataFrame:
    """How many projected months carry a cost after filling."""
    hit = (D.month_status("mes", as_of) == "projecao") & (F.col("valor") > 0)
    return cost.filter("rubrica = 'total'").agg(F.count_if(hit).alias("meses_projetados"))


def _months(cost: DataFrame) -> DataFrame:
    """mes, total, rescisao, comissao as columns."""
    v = lambda r: F.coalesce(F.max(F.when(F.col("rubrica") == r, F.col("valor"))), F.lit(0.0)).alias(r)
    return cost.groupBy("mes").agg(v("total"), v("rescisao"), v("comissao"))


def hr_kpis(cost: DataFrame, hc: DataFrame, as_of) -> DataFrame:
    """Cost so far, current headcount, cost per head and month, turnover so far."""
    current = D.as_date(as_of).strftime("%Y-%m")
    money = _done(_months(cost), as_of).agg(
        money_sum("total").alias("custo_ytd"), F.count(F.lit(1)).alias("meses")
    )
    people = hc.agg(
        F.coalesce(F.max(F.when(F.col("mes") == current, F.col("final"))), F.lit(0)).alias("hc"),
        F.coalesce(
            F.sum(F.when(D.month_status("mes", as_of).isin(*DONE), F.round(F.col("turnover") * 10000).cast("long"))),
            F.lit(0),
        ).alias("_t"),
    )
    j = money.select("*", people.select(F.struct("hc", "_t")).scalar().alias("p")).select(
        "custo_ytd", "meses", F.col("p.hc").alias("hc_atual"), (F.col("p._t") / 10000.0).alias("turnover_ytd")
    )
    per_head = ratio(F.col("custo_ytd"), (F.col("hc_atual") * F.col("meses")).cast("double"), 2)
    return j.withColumn("custo_por_funcionario", F.coalesce(per_head, F.lit(0.0)))


def ytd_by_area(areas: DataFrame, as_of) -> DataFrame:
    return _done(areas, as_of).groupBy("area").agg(money_sum("valor").alias("valor")).orderBy(F.desc("valor"), "area")


def per_capita_ranking(demographic: DataFrame, mes: str) -> DataFrame:
    """Cost per head by area, dearest first, with the mean of the areas."""
    rows = demographic.filter((F.col("mes") == mes) & (F.col("area") != "EMPRESA") & (F.col("custo_per_capita") > 0))
    mean = rows.agg(F.round(money_sum("custo_per_capita") / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias("m"))
    return rows.select("area", "custo_per_capita", mean.scalar().alias("media")).orderBy(
        F.desc("custo_per_capita"), "area"
    )


def headcount_history(history: DataFrame, hc: DataFrame, current_year: int) -> DataFrame:
    """Year x month matrix of closing headcounts. ``history``: ano, mes_num, hc; ``hc`` holds the current year instead."""
    now = hc.select(
        F.substring("mes", 1, 4).cast("int").alias("ano"),
        F.substring("mes", 6, 2).cast("int").alias("mes_num"),
        F.col("final").cast("long").alias("hc"),
    )
    past = history.filter(F.col("ano") != current_year)
    every = past.select("ano", "mes_num", F.col("hc").cast("long").alias("hc")).unionByName(now)
    wide = every.groupBy("ano").pivot("mes_num", list(range(1, 13))).agg(F.max("hc"))
    cols = [F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(f"m{m:02d}") for m in range(1, 13)]
    out = wide.select("ano", *cols)
    peak = F.greatest(*[F.col(f"m{m:02d}") for m in range(1, 13)])
    drop = F.round((1 - F.col("m12") / F.nullif(peak, F.lit(0))) * 100).cast("long")
    return out.select("*", peak.alias("pico"), drop.alias("queda_pct"))


def headcount_bridge(hc: DataFrame, as_of) -> DataFrame:
    """Opening headcount plus hires minus leavers to the closing headcount, with floating-bar bases."""
    done = _done(hc, as_of)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = done.agg(
        F.coalesce(F.min_by("inicio", "mes"), F.lit(0)).alias("ini"),
        total("admissoes").alias("adm"),
        total("saida_vol").alias("vol"),
        total("saida_inv").alias("inv"),
        F.coalesce(F.max_by("final", "mes"), F.lit(0)).alias("fim"),
    )
    c = F.col
    zero = F.lit(0).cast("long")
    after_vol = c("ini") + c("adm") - c("vol")
    bar = lambda i, name, base, value: F.struct(
        F.lit(i).cast("long").alias("ordem"), F.lit(name).alias("etapa"), base.alias("base"), value.alias("valor")
    )
    return one.select(
        F.explode(
            F.array(
                bar(1, "inicio", zero, c("ini")),
                bar(2, "admissoes", c("ini"), c("adm")),
                bar(3, "saida_vol", after_vol, c("vol")),
                bar(4, "saida_inv", after_vol - c("inv"), c("inv")),
                bar(5, "final", zero, c("fim")),
            )
        ).alias("b")
    ).select("b.*")


def cost_scenarios(
    cost: DataFrame,
    as_of,
    expansion: float = K.SCENARIO_EXPANSION,
    reduction: float = K.SCENARIO_REDUCTION,
    one_off: float = K.SCENARIO_ONE_OFF,
) -> DataFrame:
    """Keep, grow and shrink per month, plus an 'ANO' row with the twelve-month totals."""
    months = _months(cost).select("mes", "total", D.month_status("mes", as_of).isin(*DONE).alias("feito"))
    done = F.col("feito")
    # twelve months fit one row: the mean and the first projected month are then plain columns
    one = months.agg(
        F.sort_array(F.collect_list(F.struct("mes", "total", "feito"))).alias("_meses"),
        F.coalesce(money_sum("total", done) / F.nullif(F.count_if(done), F.lit(0)), F.lit(0.0)).alias("_media"),
        F.min(F.when(~done, F.col("mes"))).alias("_primeiro"),
    )
    mean = F.col("_media")
    whole = lambda c: F.floor(c + 0.5)
    line = lambda mes, shrink, n: F.struct(
        mes.alias("mes"),
        whole(mean * n).alias("base"),
        whole((mean + expansion) * n).alias("expansao"),
        whole(shrink).alias("reducao"),
    )
    extra = lambda x: F.when(x.mes == F.col("_primeiro"), F.lit(float(one_off))).otherwise(F.lit(0.0))
    per_month = F.transform(
        "_meses", lambda x: line(x.mes, F.when(x.feito, x.total).otherwise(mean - reduction + extra(x)), 1)
    )
    year = F.array(line(F.lit("ANO"), (mean - reduction) * 12 + one_off, 12))
    return one.select(F.explode(F.concat(per_month, year)).alias("l")).select("l.*")


def department_headcount(demographic: DataFrame, months: list[str]) -> DataFrame:
    """Department x month headcount matrix."""
    rows = demographic.filter("area <> 'EMPRESA'")
    wide = rows.groupBy("area").pivot("mes", months).agg(F.sum("hc"))
    return wide.select(
        "area", *[F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias("m_" + m.replace("-", "_")) for m in months]
    )


def department_movement(demographic: DataFrame, first: str, last: str) -> DataFrame:
    """Departments whose headcount changed between two months."""
    at = lambda m: F.coalesce(F.max(F.when(F.col("mes") == m, F.col("hc"))), F.lit(0))
    g = demographic.filter("area <> 'EMPRESA'").groupBy("area").agg(at(first).alias("de"), at(last).alias("para"))
    return g.withColumn("variacao", F.col("para") - F.col("de")).filter("variacao <> 0")


def hr_insights(cost: DataFrame, as_of) -> DataFrame:
    """Variation of the last month, dearest month, severance and commission so far, last commission."""
    w = Window.orderBy("mes")
    rows = _done(_months(cost), as_of).withColumn("_prev", F.lag("total").over(w))
    return rows.agg(
        F.max_by(ratio(F.col("total") - F.col("_prev"), F.col("_prev"), 1, 100.0), F.col("mes")).alias("var_ultimo_mes_pct"),
        F.min_by("mes", F.struct(-F.col("total"), F.col("mes"))).alias("mes_mais_caro"),
        F.max("total").alias("valor_mais_caro"),
        money_sum("rescisao").alias("rescisao_ytd"),
        money_sum("comissao").alias("comissao_ytd"),
        F.max_by("comissao", "mes").alias("comissao_ultimo_mes"),
    )
