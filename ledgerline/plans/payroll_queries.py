"""Payroll and headcount reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import payroll as P
from ledgerline.operators import payroll as R
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import check, m, part
from ledgerline.plans.registry import query

AS_OF = I.PAYROLL_AS_OF
YTD = "mes <= '1999-07'"
MONTHS = D.year_months(AS_OF)


def _rows(s, sf):
    return R.payroll_rows(I.payroll_sheet(s, sf), AS_OF)


def _cost(s, sf):
    return R.rubric_cost(I.payroll_cells(s, sf, "rubrics"), 1999)


def _filled(s, sf):
    return R.fill_zero_months(_cost(s, sf), total=("rubrica", "total"))


def _hc(s, sf):
    return R.headcount(I.payroll_cells(s, sf, "headcount"), 1999)


def _areas(s, sf):
    return R.area_cost(I.payroll_cells(s, sf, "areas"), 1999)


def _demo(s, sf):
    return R.demographics(I.payroll_sheet(s, sf))


@query("payroll_clean_rows", check("SELECT * FROM folha", "folha"))
def _(s, sf):
    return _rows(s, sf)


LEVEL = """CASE WHEN lower(cargo) LIKE '%widget%' THEN 'Gerência' WHEN lower(cargo) LIKE '%bolt%' THEN 'Coordenação'
 WHEN regexp_matches(lower(cargo), 'ring|gear|rod') THEN 'Analista/Especialista' WHEN regexp_matches(lower(cargo), 'plate|anvil') THEN 'Assistente/Operacional'
 ELSE 'Analista/Especialista' END"""


@query("payroll_levels", check(f"SELECT cargo, {LEVEL} AS nivel, count(*) AS qtd FROM folha GROUP BY 1, 2", "folha"))
def _(s, sf):
    level = P.seniority("cargo", I.LEVEL_RULES).alias("nivel")
    return _rows(s, sf).groupBy("cargo", level).agg(F.count(F.lit(1)).alias("qtd"))


@query("payroll_status", check("SELECT mes_referencia AS mes, status, count(*) AS qtd FROM folha GROUP BY 1, 2", "folha"))
def _(s, sf):
    return _rows(s, sf).groupBy(F.col("mes_referencia").alias("mes"), "status").agg(F.count(F.lit(1)).alias("qtd"))


part("banda", f"SELECT *, {LEVEL} AS nivel FROM folha_raw WHERE cargo IS NOT NULL AND sal > 0 AND mes = (SELECT max(mes) FROM folha_raw WHERE cargo IS NOT NULL AND sal > 0)", "folha_raw")


@query(
    "salary_bands",
    check(
        " UNION ALL ".join(
            f"SELECT '{k}' AS dimensao, {c} AS nome, min(sal) AS minimo, round({m(None, 'sal')} / count(*), 2) AS media, max(sal) AS maximo, count(*) AS qtd FROM banda GROUP BY {c}"
            for k, c in (("cargo", "cargo"), ("nivel", "nivel"), ("area", "dept"))
        ),
        "banda",
    ),
)
def _(s, sf):
    return R.salary_bands(I.payroll_sheet(s, sf), I.LEVEL_RULES)


@query("demographics", check("SELECT * FROM demo", "demo"))
def _(s, sf):
    return _demo(s, sf)


# What may leave the restricted data, as the export writes it: aggregates without names.
@query("payroll_public_people", check("SELECT mes, area, idade_media, tempo_casa_medio, hc, custo_per_capita FROM demo", "demo"))
def _(s, sf):
    return R.public_rows(_demo(s, sf), R.salary_bands(I.payroll_sheet(s, sf), I.LEVEL_RULES))[0]


@query("payroll_monthly_cost", check("SELECT mes, rubrica, valor FROM custo WHERE rubrica <> 'treinamentos'", "custo"))
def _(s, sf):
    return R.drop_empty_series(_cost(s, sf))


CASH_KEYS = [k for k, _ in K.PAYROLL_CASH_RUBRICS.values()]
SUMMARY_KEYS = [k for k, _ in K.PAYROLL_RUBRICS.values()]


@query(
    "payroll_cash_flow",
    check(
        "SELECT mes, CASE rubrica "
        + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(SUMMARY_KEYS, CASH_KEYS))
        + " ELSE rubrica END AS rubrica, valor FROM custo_cheio",
        "custo_cheio",
    ),
)
def _(s, sf):
    cells = I.payroll_cells(s, sf, "rubrics", sheet=R.CASH_SHEET)
    cost = R.rubric_cost(cells, 1999, R.CASH_SHEET, K.PAYROLL_CASH_RUBRICS)
    return R.fill_zero_months(cost, total=("rubrica", "total"))


@query("payroll_cost_filled", check("SELECT * FROM custo_cheio", "custo_cheio"))
def _(s, sf):
    return _filled(s, sf)


@query("headcount", check("SELECT * FROM hc", "hc"))
def _(s, sf):
    return _hc(s, sf)


@query("area_cost", check("SELECT * FROM areas", "areas"))
def _(s, sf):
    return _areas(s, sf)


LABEL = "CASE rubrica " + " ".join(f"WHEN '{k}' THEN '{label}'" for k, label in K.PAYROLL_RUBRICS.values()) + " END"


@query(
    "ytd_composition",
    check(
        f"SELECT {LABEL} AS rubrica, {m()} AS valor FROM custo WHERE {YTD} AND rubrica <> 'total' GROUP BY 1 HAVING SUM(valor) > 0",
        "custo",
    ),
)
def _(s, sf):
    return R.ytd_composition(_cost(s, sf), AS_OF)


@query(
    "projected_months",
    check("SELECT count(*) AS meses_projetados FROM custo_cheio WHERE rubrica = 'total' AND valor > 0 AND mes > '1999-07'", "custo_cheio"),
)
def _(s, sf):
    return R.projected_months(_filled(s, sf), AS_OF)


@query(
    "fill_forward_zero",
    check(
        """SELECT nacao, mes, CASE WHEN (nacao + CAST(right(mes, 2) AS INTEGER)) % 5 <> 0 THEN valor
 ELSE COALESCE(last_value(CASE WHEN (nacao + CAST(right(mes, 2) AS INTEGER)) % 5 <> 0 THEN valor END IGNORE NULLS)
  OVER (PARTITION BY nacao ORDER BY mes ROWS UNBOUNDED PRECEDING), 0) END AS valor FROM nat""",
        "nat",
    ),
)
def _(s, sf):
    empty = (F.col("nacao") + F.substring("mes", 6, 2).cast("int")) % 5 == 0
    cells = I.nation_months(s, sf).withColumn("valor", F.when(empty, F.lit(0.0)).otherwise(F.col("valor")))
    return R.fill_zero_months(cells, key=["nacao"])


@query(
    "fill_forward_missing",
    check(
        """SELECT nacao, mes, v AS valor FROM (SELECT g.nacao, g.mes, last_value(n.valor IGNORE NULLS) OVER (PARTITION BY g.nacao ORDER BY g.mes ROWS UNBOUNDED PRECEDING) AS v
 FROM (SELECT * FROM (SELECT DISTINCT nacao FROM nat), (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS mes FROM orders)) g
 LEFT JOIN nat n ON n.nacao = g.nacao AND n.mes = g.mes) WHERE v IS NOT NULL""",
        "nat",
    ),
)
def _(s, sf):
    calendar = I.table(s, sf, "orders").select(D.month_start(F.to_date("o_orderdate")).alias("_m")).distinct()
    return R.fill_missing_months(
        I.nation_months(s, sf), calendar.select(D.month_text("_m").alias("mes")), key=["nacao"]
    )


# Every fourth month has no sheet at all; the month before is copied as a whole.
@query(
    "fill_month_copies",
    check(
        """SELECT nacao, mes, valor FROM nat WHERE CAST(right(mes, 2) AS INTEGER) % 4 <> 0
 UNION ALL SELECT nacao, left(mes, 5) || lpad(CAST(CAST(right(mes, 2) AS INTEGER) + 1 AS VARCHAR), 2, '0'), valor FROM nat
 WHERE CAST(right(mes, 2) AS INTEGER) % 4 = 3 AND left(mes, 5) || lpad(CAST(CAST(right(mes, 2) AS INTEGER) + 1 AS VARCHAR), 2, '0') IN (SELECT mes FROM nat)""",
        "nat",
    ),
)
def _(s, sf):
    cells = I.nation_months(s, sf)
    present = cells.filter(F.substring("mes", 6, 2).cast("int") % 4 != 0)
    return R.fill_missing_months(present, cells.select("mes").distinct())


part(
    "ponte",
    f"""SELECT arg_min(inicio, mes) AS i, CAST(sum(admissoes) AS BIGINT) AS a, CAST(sum(saida_vol) AS BIGINT) AS v, CAST(sum(saida_inv) AS BIGINT) AS n,
 arg_max(final, mes) AS f FROM hc WHERE {YTD}""",
    "hc",
)


@query(
    "headcount_bridge",
    check(
        """SELECT 1::BIGINT AS ordem, 'inicio' AS etapa, 0::BIGINT AS base, i AS valor FROM ponte UNION ALL SELECT 2, 'admissoes', i, a FROM ponte
 UNION ALL SELECT 3, 'saida_vol', i + a - v, v FROM ponte UNION ALL SELECT 4, 'saida_inv', i + a - v - n, n FROM ponte UNION ALL SELECT 5, 'final', 0, f FROM ponte""",
        "ponte",
    ),
)
def _(s, sf):
    return R.headcount_bridge(_hc(s, sf), AS_OF)


part("media", f"SELECT {m()} / count(*) AS x FROM custo_cheio WHERE rubrica = 'total' AND {YTD}", "custo_cheio")


@query(
    "cost_scenarios",
    check(
        f"""SELECT mes, CAST(floor(x + 0.5) AS BIGINT) AS base, CAST(floor(x + 16000 + 0.5) AS BIGINT) AS expansao,
 CAST(floor(CASE WHEN {YTD} THEN valor WHEN mes = '1999-08' THEN x - 23000 + 30000 ELSE x - 23000 END + 0.5) AS BIGINT) AS reducao
 FROM custo_cheio, media WHERE rubrica = 'total'
 UNION ALL SELECT 'ANO', CAST(floor(x * 12 + 0.5) AS BIGINT), CAST(floor((x + 16000) * 12 + 0.5) AS BIGINT), CAST(floor((x - 23000) * 12 + 30000 + 0.5) AS BIGINT) FROM media""",
        "custo_cheio",
        "media",
    ),
)
def _(s, sf):
    return R.cost_scenarios(_filled(s, sf), AS_OF)


@query(
    "hr_kpis",
    check(
        f"""SELECT *, round(custo_ytd / (hc_atual * meses), 2) AS custo_por_funcionario FROM (SELECT c.v AS custo_ytd, c.n AS meses, h.f AS hc_atual, h.t AS turnover_ytd
 FROM (SELECT {m()} AS v, count(*) AS n FROM custo_cheio WHERE rubrica = 'total' AND {YTD}) c,
 (SELECT max(CASE WHEN mes = '1999-07' THEN final END) AS f, CAST(sum(CASE WHEN {YTD} THEN CAST(round(turnover * 10000) AS BIGINT) END) AS DOUBLE) / 10000 AS t FROM hc) h)""",
        "custo_cheio",
        "hc",
    ),
)
def _(s, sf):
    return R.hr_kpis(_filled(s, sf), _hc(s, sf), AS_OF)


@query("ytd_by_area", check(f"SELECT area, {m()} AS valor FROM areas WHERE {YTD} GROUP BY 1", "areas"))
def _(s, sf):
    return R.ytd_by_area(_areas(s, sf), AS_OF)


@query(
    "per_capita_ranking",
    check(
        f"""SELECT area, custo_per_capita, (SELECT round({m(None, 'custo_per_capita')} / count(*), 2) FROM demo WHERE mes = '1999-07' AND area <> 'EMPRESA') AS media
 FROM demo WHERE mes = '1999-07' AND area <> 'EMPRESA'""",
        "demo",
    ),
)
def _(s, sf):
    return R.per_capita_ranking(_demo(s, sf), "1999-07")


@query(
    "headcount_history",
    check(
        f"""SELECT *, CAST(round((1 - m12::DOUBLE / pico) * 100) AS BIGINT) AS queda_pct FROM (SELECT *, greatest({', '.join(f'm{i:02d}' for i in range(1, 13))}) AS pico FROM (
 SELECT ano, {', '.join(f'COALESCE(max(CASE WHEN mm = {i} THEN n END), 0) AS m{i:02d}' for i in range(1, 13))} FROM (
 SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, month(o_orderdate) AS mm, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1999 GROUP BY 1, 2  -- the current year comes from hc
 UNION ALL SELECT 1999, CAST(right(mes, 2) AS INTEGER), final FROM hc) GROUP BY 1))""",
        "hc",
    ),
)
def _(s, sf):
    return R.headcount_history(I.headcount_history(s, sf), _hc(s, sf), 1999)


@query(
    "department_headcount",
    check(
        "SELECT area, "
        + ", ".join(f"CAST(sum(CASE WHEN mes = '{x}' THEN hc ELSE 0 END) AS BIGINT) AS m_{x.replace('-', '_')}" for x in MONTHS)
        + " FROM demo WHERE area <> 'EMPRESA' GROUP BY 1",
        "demo",
    ),
)
def _(s, sf):
    return R.department_headcount(_demo(s, sf), MONTHS)


@query(
    "department_movement",
    check(
        """SELECT *, para - de AS variacao FROM (SELECT area, COALESCE(max(CASE WHEN mes = '1999-01' THEN hc END), 0) AS de, COALESCE(max(CASE WHEN mes = '1999-07' THEN hc END), 0) AS para
 FROM demo WHERE area <> 'EMPRESA' GROUP BY 1) WHERE para <> de""",
        "demo",
    ),
)
def _(s, sf):
    return R.department_movement(_demo(s, sf), "1999-01", "1999-07")


part(
    "mc",
    f"""SELECT mes, max(CASE WHEN rubrica = 'total' THEN valor END) AS total, max(CASE WHEN rubrica = 'rescisao' THEN valor END) AS rescisao,
 max(CASE WHEN rubrica = 'comissao' THEN valor END) AS comissao FROM custo_cheio WHERE {YTD} GROUP BY 1""",
    "custo_cheio",
)


@query(
    "hr_insights",
    check(
        f"""SELECT (SELECT round((b.total - a.total) * 100 / a.total, 1) FROM mc a, mc b WHERE a.mes = '1999-06' AND b.mes = '1999-07') AS var_ultimo_mes_pct,
 (SELECT mes FROM mc ORDER BY total DESC, mes LIMIT 1) AS mes_mais_caro, max(total) AS valor_mais_caro, {m(None, 'rescisao')} AS rescisao_ytd,
 {m(None, 'comissao')} AS comissao_ytd, (SELECT comissao FROM mc WHERE mes = '1999-07') AS comissao_ultimo_mes FROM mc""",
        "mc",
    ),
)
def _(s, sf):
    return R.hr_insights(_filled(s, sf), AS_OF)


@query(
    "payroll_department_cost",
    check(
        f"""SELECT departamento, count(*) AS qtd, {m(None, 'custo_total')} AS custo, round({m(None, 'salario')} / count(*), 2) AS sal_medio
 FROM folha WHERE mes_referencia = '1999-07' GROUP BY 1""",
        "folha",
    ),
)
def _(s, sf):
    return R.department_cost(_rows(s, sf), "1999-07")


@query(
    "payroll_person",
    check(
        "SELECT nome, cargo, departamento, salario, beneficios, custo_total FROM folha WHERE mes_referencia = '1999-07' AND lower(nome) LIKE '%func 1%'",
        "folha",
    ),
)
def _(s, sf):
    return R.person_lookup(_rows(s, sf), "Func 1", "1999-07")


@query(
    "payroll_top_salaries",
    check(
        "SELECT nome, cargo, departamento, salario FROM folha WHERE mes_referencia = '1999-07' ORDER BY salario DESC, nome LIMIT 10",
        "folha",
    ),
)
def _(s, sf):
    return R.top_salaries(_rows(s, sf), "1999-07")


@query(
    "payroll_severances",
    check(
        "SELECT nome, cargo, departamento, rescisao FROM folha WHERE mes_referencia = '1999-07' AND rescisao > 0", "folha"
    ),
)
def _(s, sf):
    return R.severances(_rows(s, sf), "1999-07")
