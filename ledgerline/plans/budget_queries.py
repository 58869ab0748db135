"""Budget reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.money import variation_pct
from ledgerline.operators import budget as G
from ledgerline.operators import flows
from ledgerline.operators.rows import cash_rows
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import FACTOR, GROSS, LINE, NET, SECTION, check, d, m, part
from ledgerline.plans.registry import query

ORDER = """CASE label WHEN 'Receita Bruta' THEN 0 WHEN 'Impostos' THEN 6 WHEN 'Custos Operacionais' THEN 12 WHEN 'Despesas Gerais e Adm' THEN 17
 WHEN 'EBITDA' THEN 24 WHEN 'Lucro Líquido' THEN 27 END::BIGINT"""
YTD = [f"1999-{i:02d}" for i in range(1, 13)]
IN_YTD = "mes LIKE '1999-%'"
PCT = "CASE WHEN {b} <> 0 THEN round(({r} - {b}) / abs({b}) * 100, {n}) END"


def tot(where: str = "TRUE") -> str:
    return f"SELECT label, min(section) AS section, CAST(min(level) AS BIGINT) AS level, {m(None, 'valor_real')} AS real, {m(None, 'valor_bp')} AS bp FROM bud WHERE {where} GROUP BY 1"


part("bud_ano", tot(IN_YTD), "bud")
part("bud_real", tot("mes_com_real"), "bud")
part("bud_tudo", tot(), "bud")


@query("budget_variance", check(f"SELECT label, mes, valor_real, valor_bp, {PCT.format(r='valor_real', b='valor_bp', n=2)} AS variacao_pct FROM bud", "bud"))
def _(s, sf):
    return I.budget(s, sf).select(
        "label", "mes", "valor_real", "valor_bp", variation_pct("valor_real", "valor_bp").alias("variacao_pct")
    )


part(
    "celulas",
    f"""SELECT label, section, mm, CAST((net + 50) // 100 AS DOUBLE) / 100 AS r, CAST((gross * f + 50) // 100 AS DOUBLE) / 100 AS b FROM (
 SELECT {LINE} AS label, {SECTION} AS section, month(l_shipdate) AS mm, {NET} AS net, {GROSS} AS gross, min({FACTOR}) AS f
 FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3)""",
)


@query(
    "budget_from_cells",
    check(
        f"""SELECT g.label, g.section, CAST(g.level AS BIGINT) AS level, '1999-' || lpad(CAST(i AS VARCHAR), 2, '0') AS mes, r2 AS valor_real, b2 AS valor_bp,
 {PCT.format(r='r2', b='b2', n=2)} AS variacao_pct, i < 10 AS mes_com_real FROM (
 SELECT x.label, x.section, x.level, i, COALESCE(CASE WHEN x.label = 'EBITDA' AND i = 5 THEN 0 WHEN x.label = 'Receita Bruta' AND i >= 10 THEN 0 ELSE r END, 0) AS r2,
  COALESCE(b, 0) AS b2 FROM (VALUES ('Receita Bruta','receita',0),('SK','receita',2),('BK','receita',2),('RT','receita',2),('Aditivo','receita',2),('Vendas RP','receita',2),
  ('Impostos','impostos',0),('ICMS','impostos',2),('Crédito de ICMS','impostos',2),('ISS','impostos',2),('PIS/COFINS','impostos',2),('Receita Líquida','receita_liq',0),
  ('Custos Operacionais','custos',0),('Comissões Externas','custos',2),('Comissões Internas','custos',2),('Obras (Total)','custos',1),('Margem de Contribuição','margem',0),
  ('Despesas Gerais e Adm','sga',0),('Salários e Encargos','sga',1),('Despesas Administrativas','sga',1),('Despesas Comerciais','sga',1),('Despesas com Imóvel','sga',1),
  ('Despesas com Veículos','sga',1),('Despesas com Diretoria','sga',1),('EBITDA','ebitda',0),('Receitas/Despesas Financeiras','financeiro',1),('IRPJ/CSLL','impostos_renda',0),
  ('Lucro Líquido','ll',0)) x(label, section, level) CROSS JOIN range(1, 13) t(i) LEFT JOIN celulas c ON c.label = x.label AND c.mm = i) g""",
        "celulas",
    ),
)
def _(s, sf):
    return G.budget_from_cells(I.budget_cells(s, sf), G.line_map(s), 1999)


@query(
    "line_map_mismatches",
    check(
        """SELECT DISTINCT sheet, CAST(linha AS INTEGER) AS row, 'Custos Operacionais' AS esperado, achado AS encontrado
 FROM part, (VALUES ('Realizado', 44, 'Outra linha'), ('BP', 44, 'Outra linha total')) v(sheet, linha, achado) WHERE p_type = 'MEDIUM'"""
    ),
)
def _(s, sf):
    return G.line_map_mismatches(I.budget_cells(s, sf), G.line_map(s))


@query(
    "months_with_actuals",
    check("SELECT DISTINCT mes FROM bud WHERE label = 'Receita Bruta' AND valor_real <> 0", "bud"),
)
def _(s, sf):
    return G.months_with_actuals(I.budget(s, sf))


@query(
    "statement_order",
    check(f"SELECT label, section, CAST(level AS BIGINT) AS level, {ORDER} AS ordem, meses FROM (SELECT label, min(section) AS section, min(level) AS level, count(*) AS meses FROM bud GROUP BY 1)", "bud"),
)
def _(s, sf):
    return G.statement(I.budget(s, sf)).select(
        "label", "section", "level", "ordem", F.size(F.map_keys("real")).cast("long").alias("meses")
    )


@query("statement_months", check("SELECT mes, bool_or(mes_com_real) AS mes_com_real FROM bud GROUP BY 1", "bud"))
def _(s, sf):
    return G.statement_months(I.budget(s, sf))


@query(
    "statement_pivot",
    check(
        "SELECT label, "
        + ", ".join(m(f"mes = '{x}'", "valor_real") + f" AS m_{x.replace('-', '_')}" for x in I.budget_months())
        + f", {ORDER} AS ordem FROM bud GROUP BY label",
        "bud",
    ),
)
def _(s, sf):
    return G.statement_pivot(I.budget(s, sf), I.budget_months())


@query(
    "statement_line",
    check(
        f"""SELECT mes, valor_real AS real, valor_bp AS bp, round({PCT.format(r='valor_real', b='valor_bp', n=2)}, 1) AS var_pct
 FROM bud WHERE label = 'EBITDA' AND mes_com_real""",
        "bud",
    ),
)
def _(s, sf):
    rows = I.budget(s, sf).withColumn("variacao_pct", variation_pct("valor_real", "valor_bp"))
    return G.statement_line(rows, "EBITDA")


@query(
    "budget_accumulated",
    check(
        """SELECT label, mes, CAST(SUM(CAST(valor_real AS DECIMAL(18,2))) OVER w AS DOUBLE) AS real_acum, CAST(SUM(CAST(valor_bp AS DECIMAL(18,2))) OVER w AS DOUBLE) AS bp_acum
 FROM bud WINDOW w AS (PARTITION BY label, left(mes, 4) ORDER BY mes)""",
        "bud",
    ),
)
def _(s, sf):
    return G.accumulated(I.budget(s, sf))


def kpi_sql(where: str) -> str:
    line = lambda n, v: m(f"label = '{n}'", v)
    return f"""SELECT *, CASE WHEN receita_bp <> 0 THEN round(receita_real * 100 / receita_bp, 1) ELSE 0 END AS pct_receita,
 CASE WHEN ebitda_bp <> 0 THEN round(ebitda_real * 100 / ebitda_bp, 1) ELSE 0 END AS pct_ebitda FROM (SELECT
 {line('Receita Bruta', 'valor_real')} AS receita_real, {line('Receita Bruta', 'valor_bp')} AS receita_bp, {line('EBITDA', 'valor_real')} AS ebitda_real,
 {line('EBITDA', 'valor_bp')} AS ebitda_bp, {line('Lucro Líquido', 'valor_real')} AS lucro_real, {line('Lucro Líquido', 'valor_bp')} AS lucro_bp,
 count(DISTINCT CASE WHEN mes_com_real THEN mes END) AS meses_com_real FROM bud WHERE {where})"""


@query("budget_kpis_ytd", check(kpi_sql(IN_YTD), "bud"))
def _(s, sf):
    return G.budget_kpis(I.budget(s, sf), YTD)


@query("budget_kpis_month", check(kpi_sql("mes = '1999-12'"), "bud"))
def _(s, sf):
    return G.budget_kpis(I.budget(s, sf), ["1999-12"])


@query(
    "budget_series",
    check(
        f"SELECT label, mes, {m(None, 'valor_real')} AS real, {m(None, 'valor_bp')} AS bp FROM bud WHERE label IN ('Receita Bruta', 'EBITDA') GROUP BY 1, 2",
        "bud",
    ),
)
def _(s, sf):
    return G.budget_series(I.budget(s, sf))


@query(
    "budget_waterfall",
    check(
        f"""SELECT CASE label WHEN 'Receita Bruta' THEN 1 WHEN 'Impostos' THEN 2 WHEN 'Custos Operacionais' THEN 3 WHEN 'Despesas Gerais e Adm' THEN 4 ELSE 7 END::BIGINT AS ordem,
 label, CAST(round({d('real', 'bp')}) AS BIGINT) AS variacao FROM bud_ano WHERE label <> 'EBITDA'""",
        "bud_ano",
    ),
)
def _(s, sf):
    return G.variance_waterfall(I.budget(s, sf), YTD)


@query(
    "budget_attainment",
    check(
        """SELECT *, CASE WHEN pct >= 90 THEN 'verde' WHEN pct >= 70 THEN 'amarelo' ELSE 'vermelho' END AS faixa FROM (
 SELECT CASE label WHEN 'Receita Bruta' THEN 1 WHEN 'Custos Operacionais' THEN 3 WHEN 'Despesas Gerais e Adm' THEN 5 WHEN 'EBITDA' THEN 6 ELSE 7 END::BIGINT AS ordem,
 label, CAST(CASE WHEN bp <> 0 THEN round(real * 100 / bp) ELSE 0 END AS BIGINT) AS pct FROM bud_ano WHERE label <> 'Impostos')""",
        "bud_ano",
    ),
)
def _(s, sf):
    return G.attainment(I.budget(s, sf), YTD)


@query(
    "budget_comparative",
    check(
        f"""SELECT {ORDER} AS ordem, label, section, level, real, bp, {d('real', 'bp')} AS variacao, {PCT.format(r='real', b='bp', n=1)} AS variacao_pct,
 CASE WHEN bp <> 0 THEN round(real * 100 / bp, 0) END AS atingimento_pct FROM bud_tudo WHERE real <> 0 OR bp <> 0""",
        "bud_tudo",
    ),
)
def _(s, sf):
    return G.comparative(I.budget(s, sf))


@query(
    "mini_statement",
    check(
        """SELECT CASE label WHEN 'Receita Bruta' THEN 1 WHEN 'Custos Operacionais' THEN 2 WHEN 'Despesas Gerais e Adm' THEN 3 WHEN 'EBITDA' THEN 4 ELSE 5 END::BIGINT AS ordem,
 label, real, bp, CASE WHEN bp <> 0 THEN round(real * 100 / bp, 0) END AS pct,
 CASE WHEN bp = 0 THEN 'sem_orcado' WHEN label LIKE '%Custo%' OR label LIKE '%Despesa%' THEN CASE WHEN real <= bp THEN 'ok' ELSE 'atencao' END
  WHEN real >= bp THEN 'ok' ELSE 'atencao' END AS situacao FROM bud_real WHERE label <> 'Impostos'""",
        "bud_real",
    ),
)
def _(s, sf):
    return G.mini_statement(I.budget(s, sf))


@query(
    "mini_statement_ledger",
    check(
        f"""SELECT 1 AS ordem, 'Receita Bruta' AS label, entrada AS real FROM kpi UNION ALL SELECT 2, 'Despesas Totais', -saida FROM kpi
 UNION ALL SELECT 3, 'Resultado', {d('entrada', 'saida')} FROM kpi""",
        "kpi",
    ),
)
def _(s, sf):
    return G.mini_statement_from_ledger(flows.period_kpis(cash_rows(I.ledger(s, sf))))


@query("snapshot_budget", check("SELECT label, real, bp FROM bud_real WHERE level = 0", "bud_real"))
def _(s, sf):
    return G.headline_budget(I.budget(s, sf))
