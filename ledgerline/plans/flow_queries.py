"""Cash and accrual reports over the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import balances as B
from ledgerline.operators import flows, margins, overview, terms
from ledgerline.operators.rows import accrual_rows, cash_rows
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import DONE, ENT, LATE, PAID, SAI, check, d, m, part, ym
from ledgerline.plans.registry import query

DE, ATE = I.PERIOD
IN_CASH = f"data BETWEEN DATE '{DE}' AND DATE '{ATE}'"
IN_ACC = f"data_vencimento BETWEEN DATE '{DE}' AND DATE '{ATE}'"
TODAY = f"DATE '{I.AS_OF}'"


@query(
    "cash_flow_monthly",
    check(
        f"""SELECT {ym('data_pagamento')} AS mes, {m(ENT + " AND status = 'RECEBIDO'")} AS entradas,
 {m(SAI + " AND status = 'PAGO'")} AS saidas FROM L WHERE data_pagamento IS NOT NULL GROUP BY 1""",
        "L",
    ),
)
def _(s, sf):
    return flows.monthly_cash_flow(I.ledger(s, sf))


@query(
    "ledger_status_totals",
    check(f"SELECT tipo, status, {m()} AS total, count(*) AS qtd FROM L GROUP BY 1, 2", "L"),
)
def _(s, sf):
    return flows.status_totals(I.ledger(s, sf))


KPI_SQL = f"""SELECT {m(ENT)} AS entrada, {m(SAI)} AS saida, {m(ENT + ' AND ' + DONE)} AS recebido, {m(SAI + ' AND ' + DONE)} AS pago,
 {m(ENT + ' AND NOT ' + DONE)} AS a_receber, {m(SAI + ' AND NOT ' + DONE)} AS a_pagar,
 {m(ENT + ' AND ' + LATE)} AS vencido_receber, {m(SAI + ' AND ' + LATE)} AS vencido_pagar,
 {m(ENT + " AND status IN ('A VENCER','VENCE HOJE')")} AS a_vencer_receber,
 {m(SAI + " AND status IN ('A VENCER','VENCE HOJE')")} AS a_vencer_pagar,
 count(*) FILTER ({ENT}) AS qtd_entradas, count(*) FILTER ({SAI}) AS qtd_saidas FROM L"""
part("kpi", KPI_SQL, "L")
part("kpi_periodo", KPI_SQL + " WHERE " + IN_CASH, "L")


@query(
    "period_kpis_cash",
    check(
        f"""SELECT *, {d('entrada', 'saida')} AS resultado, {d('recebido', 'pago')} AS resultado_realizado,
 {d('a_receber', 'a_pagar')} AS resultado_a_realizar, round({d('entrada', 'saida')} * 100 / entrada, 1) AS margem_pct FROM kpi_periodo""",
        "kpi_periodo",
    ),
)
def _(s, sf):
    return flows.period_kpis(cash_rows(I.ledger(s, sf), DE, ATE))


@query(
    "period_kpis_accrual",
    check(
        f"""SELECT a.*, k.a_receber, k.a_pagar, k.vencido_receber, k.vencido_pagar, {d('a.entrada', 'a.saida')} AS resultado
 FROM (SELECT {m(ENT)} AS entrada, {m(SAI)} AS saida, count(*) FILTER ({ENT}) AS qtd_entradas, count(*) FILTER ({SAI}) AS qtd_saidas
  FROM ACC WHERE {IN_ACC}) a, kpi_periodo k""",
        "ACC",
        "kpi_periodo",
    ),
)
def _(s, sf):
    return flows.accrual_kpis(I.ledger(s, sf), DE, ATE)


@query(
    "in_out_by_month",
    check(f"SELECT mes, entrada, saida, {d('entrada', 'saida')} AS resultado FROM mes_caixa", "mes_caixa"),
)
def _(s, sf):
    return flows.in_out_by_month(cash_rows(I.ledger(s, sf)))


@query(
    "in_out_by_month_accrual",
    check(f"SELECT mes, receita AS entrada, saida, {d('receita', 'saida')} AS resultado FROM mes_acc", "mes_acc"),
)
def _(s, sf):
    return flows.in_out_by_month(accrual_rows(I.ledger(s, sf)), "data_vencimento")


@query(
    "by_category",
    check(
        f"SELECT categoria_codigo AS categoria, min(categoria_nome) AS nome, {m(ENT)} AS entrada, {m(SAI)} AS saida FROM L GROUP BY 1",
        "L",
    ),
)
def _(s, sf):
    return flows.in_out_by_category(cash_rows(I.ledger(s, sf, "category")))


PROJ = f"""SELECT projeto_id, min(projeto_nome) AS projeto_nome, {m(ENT)} AS entrada, {m(SAI)} AS saida,
 {m(ENT + ' AND NOT fd')} AS ent_sk, {m(ENT + ' AND fd')} AS ent_fd, {m(SAI + ' AND NOT fd')} AS sai_sk, {m(SAI + ' AND fd')} AS sai_fd"""
part("proj", PROJ + " FROM L WHERE projeto_id IS NOT NULL GROUP BY 1", "L")
part("proj_acc", PROJ + " FROM ACC WHERE projeto_id IS NOT NULL GROUP BY 1", "ACC")


@query("by_project", check("SELECT * FROM proj", "proj"))
def _(s, sf):
    return flows.in_out_by_project(cash_rows(I.ledger(s, sf, "project", "direct")))


@query(
    "by_client",
    check(f"SELECT cliente_nome, {m()} AS entrada FROM L WHERE {ENT} AND cliente_nome <> '' GROUP BY 1", "L"),
)
def _(s, sf):
    return flows.inflow_by_client(cash_rows(I.ledger(s, sf, "client")))


part("grp", f"SELECT tipo, L.grupo, COALESCE(min(n.nome), L.grupo) AS nome, {m()} AS valor FROM L LEFT JOIN names_of_groups n ON n.grupo = L.grupo GROUP BY 1, 2", "L", "names_of_groups")


@query("by_group", check("SELECT * FROM grp", "grp"))
def _(s, sf):
    return flows.totals_by_group(cash_rows(I.ledger(s, sf, "category")), I.categories(s, sf))


@query(
    "group_month_matrix",
    check(
        f"""SELECT c.grupo, COALESCE(n.nome, c.grupo) AS nome, c.mes, c.valor, t.total AS total_grupo, t.ordem, x.entrada AS receita_mes, x.saida AS saida_mes
 FROM (SELECT grupo, {ym('data')} AS mes, {m()} AS valor FROM L WHERE {SAI} GROUP BY 1, 2) c
 JOIN (SELECT grupo, {m()} AS total, row_number() OVER (ORDER BY SUM(CAST(valor AS DECIMAL(18,2))) DESC, grupo) AS ordem FROM L WHERE {SAI} GROUP BY 1) t ON t.grupo = c.grupo
 JOIN mes_caixa x ON x.mes = c.mes LEFT JOIN names_of_groups n ON n.grupo = c.grupo""",
        "L",
        "mes_caixa",
        "names_of_groups",
    ),
)
def _(s, sf):
    return flows.group_month_matrix(cash_rows(I.ledger(s, sf, "category")), I.categories(s, sf))


@query(
    "group_month_matrix_accrual",
    check(
        f"""SELECT c.grupo, COALESCE(n.nome, c.grupo) AS nome, c.mes, c.valor, t.total AS total_grupo, t.ordem, x.receita AS receita_mes, x.saida AS saida_mes
 FROM fin c JOIN (SELECT grupo, {m()} AS total, row_number() OVER (ORDER BY SUM(CAST(valor AS DECIMAL(18,2))) DESC, grupo) AS ordem FROM ACC WHERE {SAI} GROUP BY 1) t ON t.grupo = c.grupo
 JOIN mes_acc x ON x.mes = c.mes LEFT JOIN names_of_groups n ON n.grupo = c.grupo""",
        "fin",
        "mes_acc",
        "names_of_groups",
    ),
)
def _(s, sf):
    return flows.group_month_matrix(
        accrual_rows(I.ledger(s, sf, "category")), I.categories(s, sf), "data_vencimento"
    )


@query(
    "fd_sk_monthly",
    check(
        f"""SELECT {ym('data')} AS mes, {m(ENT + ' AND NOT fd')} AS ent_sk, {m(ENT + ' AND fd')} AS ent_fd,
 {m(SAI + ' AND NOT fd')} AS sai_sk, {m(SAI + ' AND fd')} AS sai_fd FROM L GROUP BY 1""",
        "L",
    ),
)
def _(s, sf):
    return flows.modality_by_month(cash_rows(I.ledger(s, sf, "direct")))


@query(
    "fd_sk_settled",
    check(
        f"""SELECT {ym('data_pagamento')} AS mes, CASE WHEN fd THEN 'FD' ELSE 'SK' END AS modalidade, {m()} AS total, count(*) AS qtd
 FROM L WHERE {PAID} GROUP BY 1, 2""",
        "L",
    ),
)
def _(s, sf):
    return flows.modality_totals(I.ledger(s, sf, "direct"))


@query(
    "top_groups",
    check(
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY valor DESC, grupo) AS posicao FROM grp) WHERE posicao <= 8",
        "grp",
    ),
)
def _(s, sf):
    return flows.top_groups(cash_rows(I.ledger(s, sf, "category")), I.categories(s, sf))


@query(
    "outflow_composition",
    check(
        f"""SELECT a.grupo, COALESCE(min(n.nome), a.grupo) AS nome, {m()} AS valor FROM ACC a LEFT JOIN names_of_groups n ON n.grupo = a.grupo
 WHERE {SAI} GROUP BY 1 HAVING SUM(valor) > 0 ORDER BY valor DESC, a.grupo LIMIT 10""",
        "ACC",
        "names_of_groups",
    ),
)
def _(s, sf):
    return flows.outflow_composition(accrual_rows(I.ledger(s, sf, "category")), I.categories(s, sf))


@query(
    "cash_flow_rollup",
    check(
        f"""SELECT CAST(CASE g WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS nivel, x.grupo, categoria,
 CASE g WHEN 0 THEN nome_cat WHEN 1 THEN COALESCE(n.nome, x.grupo) ELSE 'TOTAL' END AS nome,
 {d('ed', 'sd')} AS realizado, {d('eo', 'so')} AS a_realizar, {d('e', 's')} AS total FROM (
 SELECT grouping(grupo, categoria_codigo) AS g, grupo, categoria_codigo AS categoria, min(categoria_nome) AS nome_cat,
 {m(ENT + ' AND ' + DONE)} AS ed, {m(SAI + ' AND ' + DONE)} AS sd, {m(ENT + ' AND NOT ' + DONE)} AS eo, {m(SAI + ' AND NOT ' + DONE)} AS so,
 {m(ENT)} AS e, {m(SAI)} AS s FROM L GROUP BY ROLLUP (grupo, categoria_codigo)) x LEFT JOIN names_of_groups n ON n.grupo = x.grupo""",
        "L",
        "names_of_groups",
    ),
)
def _(s, sf):
    return flows.cash_flow_table(cash_rows(I.ledger(s, sf, "category")), I.categories(s, sf))


@query(
    "cash_flow_cube_month",
    check(
        f"""SELECT CASE WHEN grouping(grupo) = 1 THEN 'TOTAL' ELSE grupo END AS grupo, CASE WHEN grouping(mes) = 1 THEN 'TOTAL' ELSE mes END AS mes,
 {d(m(ENT), m(SAI))} AS saldo FROM (SELECT *, {ym('data')} AS mes FROM L) GROUP BY CUBE (grupo, mes)""",
        "L",
    ),
)
def _(s, sf):
    return flows.cash_flow_cube(cash_rows(I.ledger(s, sf, "category")))


@query(
    "cash_flow_pivot",
    check(
        "SELECT grupo, "
        + ", ".join(
            f"{d(m(ENT + f''' AND {ym('data')} = '{x}' '''), m(SAI + f''' AND {ym('data')} = '{x}' '''))} AS \"{x}\""
            for x in I.ledger_months()
        )
        + " FROM L GROUP BY 1",
        "L",
    ),
)
def _(s, sf):
    cells = flows.cash_flow_cube(cash_rows(I.ledger(s, sf, "category"))).filter("grupo <> 'TOTAL' AND mes <> 'TOTAL'")
    return flows.pivot_months(cells, "grupo", "saldo", I.ledger_months())


@query(
    "cash_cumulative",
    check(
        f"""SELECT mes, entrada, saida, {d('entrada', 'saida')} AS resultado,
 CAST(SUM(CAST(entrada AS DECIMAL(28,2)) - CAST(saida AS DECIMAL(28,2))) OVER (ORDER BY mes) AS DOUBLE) AS acumulado FROM mes_caixa""",
        "mes_caixa",
    ),
)
def _(s, sf):
    return flows.running_result(flows.in_out_by_month(cash_rows(I.ledger(s, sf))))


@query(
    "project_cumulative",
    check(
        f"""SELECT mes, e AS entrada, s AS saida, {d('e', 's')} AS resultado,
 CAST(SUM(CAST(e AS DECIMAL(28,2)) - CAST(s AS DECIMAL(28,2))) OVER (ORDER BY mes) AS DOUBLE) AS acumulado
 FROM (SELECT {ym('data')} AS mes, {m(ENT)} AS e, {m(SAI)} AS s FROM L WHERE projeto_id = 5 GROUP BY 1)""",
        "L",
    ),
)
def _(s, sf):
    return flows.running_result(flows.in_out_by_month(cash_rows(I.ledger(s, sf, "project"), project=5)))


@query(
    "month_over_month",
    check(
        """SELECT mes, entrada, anterior, CASE WHEN anterior > 0 THEN round((entrada - anterior) * 100 / anterior, 1) END AS variacao_pct
 FROM (SELECT mes, entrada, lag(entrada) OVER (ORDER BY mes) AS anterior FROM mes_caixa)""",
        "mes_caixa",
    ),
)
def _(s, sf):
    return flows.month_over_month(flows.in_out_by_month(cash_rows(I.ledger(s, sf))))


@query(
    "runway_base",
    check(
        f"SELECT count(*) AS meses, round({m(None, 'saida')} / count(*), 2) AS media FROM (SELECT * FROM mes_caixa ORDER BY mes DESC LIMIT 3)",
        "mes_caixa",
    ),
)
def _(s, sf):
    return flows.last_months_mean(flows.in_out_by_month(cash_rows(I.ledger(s, sf))))


# --- margins -----------------------------------------------------------------

BUCKET = "CASE WHEN grupo = '2.01' THEN 'direto' WHEN grupo IN ('2.02','2.03','2.04','2.10') THEN 'sga' ELSE 'outros' END"


@query(
    "cost_buckets",
    check(
        f"""SELECT CASE WHEN {ENT} THEN 'receita' ELSE {BUCKET} END AS tipo_custo, {m(DONE)} AS realizado, {m('NOT ' + DONE)} AS em_aberto
 FROM L GROUP BY 1""",
        "L",
    ),
)
def _(s, sf):
    return margins.cost_buckets(cash_rows(I.ledger(s, sf, "category")))


@query(
    "maturity_split",
    check(
        f"SELECT tipo, {m('''status IN ('A VENCER','VENCE HOJE')''')} AS a_vencer, {m(LATE)} AS atrasado FROM L GROUP BY 1",
        "L",
    ),
)
def _(s, sf):
    return margins.maturity_split(cash_rows(I.ledger(s, sf)))


part("top2", f"SELECT grupo, {m()} AS v, row_number() OVER (ORDER BY SUM(CAST(valor AS DECIMAL(18,2))) DESC, grupo) AS n FROM ACC WHERE {SAI} GROUP BY 1", "ACC")


@query(
    "financial_kpis",
    check(
        f"""SELECT entrada, saida, qtd_entradas, qtd_saidas, {d('entrada', 'saida')} AS resultado, round({d('entrada', 'saida')} * 100 / entrada, 1) AS margem_pct,
 a.grupo AS grupo_1, a.v AS valor_1, round(a.v * 100 / entrada, 1) AS pct_1, b.grupo AS grupo_2, b.v AS valor_2, round(b.v * 100 / entrada, 1) AS pct_2
 FROM (SELECT {m(ENT)} AS entrada, {m(SAI)} AS saida, count(*) FILTER ({ENT}) AS qtd_entradas, count(*) FILTER ({SAI}) AS qtd_saidas FROM ACC)
 JOIN top2 a ON a.n = 1 JOIN top2 b ON b.n = 2""",
        "ACC",
        "top2",
    ),
)
def _(s, sf):
    return margins.financial_kpis(accrual_rows(I.ledger(s, sf, "category")))


part("outros", f"SELECT grupo, row_number() OVER (ORDER BY SUM(CAST(valor AS DECIMAL(18,2))) DESC, grupo) AS n FROM ACC WHERE {SAI} AND grupo NOT IN ('2.01','2.02','2.03','2.04','2.10') GROUP BY 1", "ACC")


@query(
    "monthly_cost_mix",
    check(
        f"""SELECT 'receita' AS serie, mes, receita AS valor FROM (SELECT {ym('data_vencimento')} AS mes, {m()} AS receita FROM ACC WHERE {ENT} GROUP BY 1)
 UNION ALL SELECT {BUCKET}, mes, {m()} FROM fin WHERE {BUCKET} <> 'outros' GROUP BY 1, 2
 UNION ALL SELECT fin.grupo, mes, valor FROM fin JOIN outros o ON o.grupo = fin.grupo AND o.n <= 4""",
        "ACC",
        "fin",
        "outros",
    ),
)
def _(s, sf):
    return margins.monthly_cost_mix(accrual_rows(I.ledger(s, sf, "category")))


@query(
    "sga_pct_revenue",
    check(
        f"""SELECT serie, x.mes, CASE WHEN receita > 0 THEN round(x.valor * 100 / receita, 2) ELSE 0 END AS pct FROM (
 SELECT 'sga' AS serie, mes, {m()} AS valor FROM fin WHERE {BUCKET} = 'sga' GROUP BY 2
 UNION ALL SELECT fin.grupo, mes, valor FROM fin JOIN outros o ON o.grupo = fin.grupo AND o.n <= 5) x JOIN mes_acc a ON a.mes = x.mes""",
        "fin",
        "outros",
        "mes_acc",
    ),
)
def _(s, sf):
    return margins.cost_pct_of_revenue(accrual_rows(I.ledger(s, sf, "category")))


@query("result_monthly", check(f"SELECT mes, {d('receita', 'saida')} AS resultado FROM mes_acc", "mes_acc"))
def _(s, sf):
    return margins.monthly_result(accrual_rows(I.ledger(s, sf)))


GROUPS = ["2.01", "2.02", "2.03", "2.04", "2.05", "2.10"]


@query(
    "month_group_table",
    check(
        f"""SELECT mes, receita, {', '.join('g_' + g.replace('.', '_') for g in GROUPS)}, {d('receita', 'despesa')} AS resultado,
 CASE WHEN receita > 0 THEN round({d('receita', 'despesa')} * 100 / receita, 1) ELSE 0 END AS margem_pct FROM (
 SELECT CASE WHEN grouping(mes) = 1 THEN 'TOTAL' ELSE mes END AS mes, {m(ENT)} AS receita,
 {', '.join(m(f"{SAI} AND grupo = '{g}'") + ' AS g_' + g.replace('.', '_') for g in GROUPS)}, {m(SAI)} AS despesa
 FROM (SELECT *, {ym('data_vencimento')} AS mes FROM ACC) GROUP BY ROLLUP (mes))""",
        "ACC",
    ),
)
def _(s, sf):
    return margins.month_group_table(accrual_rows(I.ledger(s, sf, "category")), GROUPS)


# --- projects ----------------------------------------------------------------


def _projects(s, sf):
    return flows.in_out_by_project(accrual_rows(I.ledger(s, sf, "project", "direct")))


MARGIN = f"CASE WHEN entrada > 0 THEN round({d('entrada', 'saida')} * 100 / entrada, 1) WHEN saida > 0 THEN -100 ELSE 0 END"


@query(
    "project_detail",
    check(f"SELECT *, {d('entrada', 'saida')} AS resultado, {MARGIN} AS margem_pct FROM proj_acc", "proj_acc"),
)
def _(s, sf):
    return margins.project_detail(_projects(s, sf))


@query(
    "project_totals",
    check(
        f"""SELECT *, {d('receita', 'despesa')} AS resultado FROM (SELECT count(*) AS projetos, {m(None, 'entrada')} AS receita, {m(None, 'saida')} AS despesa FROM proj_acc)""",
        "proj_acc",
    ),
)
def _(s, sf):
    return margins.project_totals(_projects(s, sf))


@query(
    "project_points",
    check(
        """SELECT projeto_id, projeto_nome, entrada AS receita, saida AS despesa, round((entrada - saida) / entrada * 100, 1) AS margem_pct,
 CASE WHEN (entrada - saida) / entrada * 100 >= 20 THEN 'verde' WHEN (entrada - saida) / entrada * 100 >= 0 THEN 'amarelo' ELSE 'vermelho' END AS faixa,
 CAST(6 + round(entrada / (SELECT greatest(max(entrada), 1) FROM proj_acc WHERE entrada >= 70000) * 12) AS BIGINT) AS raio
 FROM proj_acc WHERE entrada >= 70000 AND projeto_nome NOT LIKE 'SK %'""",
        "proj_acc",
    ),
)
def _(s, sf):
    return margins.project_points(_projects(s, sf))


@query(
    "project_search",
    check(
        f"SELECT *, {d('entrada', 'saida')} AS resultado, {MARGIN} AS margem_pct FROM proj_acc WHERE lower(projeto_nome) LIKE '%sk projeto%'",
        "proj_acc",
    ),
)
def _(s, sf):
    return margins.project_detail(_projects(s, sf), search="SK Projeto")


@query(
    "top_projects",
    check("SELECT projeto_nome, entrada FROM proj_acc WHERE entrada > 0 ORDER BY entrada DESC, projeto_nome LIMIT 10", "proj_acc"),
)
def _(s, sf):
    return margins.top_by(_projects(s, sf), "projeto_nome", "entrada")


@query(
    "top_project_costs",
    check("SELECT projeto_nome, saida FROM proj_acc WHERE saida > 0 ORDER BY saida DESC, projeto_nome LIMIT 10", "proj_acc"),
)
def _(s, sf):
    return margins.top_by(_projects(s, sf), "projeto_nome", "saida")


@query(
    "top_clients",
    check(f"SELECT cliente_nome, {m()} AS entrada FROM ACC WHERE {ENT} GROUP BY 1 ORDER BY entrada DESC, cliente_nome LIMIT 10", "ACC"),
)
def _(s, sf):
    return margins.top_by(flows.inflow_by_client(accrual_rows(I.ledger(s, sf, "client"))), "cliente_nome", "entrada")


# Few distinct counts, many ties: the key decides.
@query(
    "top_k_ties",
    check(
        """SELECT usuario, qtd FROM (SELECT user_id AS usuario, CAST(count(DISTINCT event_type) AS DOUBLE) AS qtd FROM events GROUP BY 1)
 ORDER BY qtd DESC, usuario LIMIT 10"""
    ),
)
def _(s, sf):
    seen = I.table(s, sf, "events").select("user_id", "event_type").distinct()
    users = seen.groupBy(F.col("user_id").alias("usuario")).agg(F.count(F.lit(1)).cast("double").alias("qtd"))
    return margins.top_by(users, "usuario", "qtd")


part(
    "fdp",
    f"""SELECT projeto_id, min(projeto_nome) AS projeto_nome, {m(ENT)} AS rec_fd, {m(SAI)} AS desp_fd FROM L WHERE fd AND projeto_id IS NOT NULL GROUP BY 1""",
    "L",
)


def _fd(s, sf):
    return margins.direct_billing_balance(cash_rows(I.ledger(s, sf, "project", "direct")))


@query(
    "fd_reconciliation",
    check(
        f"""SELECT *, {d('rec_fd', 'desp_fd')} AS diferenca FROM fdp WHERE abs({d('rec_fd', 'desp_fd')}) > 100
 ORDER BY abs({d('rec_fd', 'desp_fd')}) DESC, projeto_id LIMIT 20""",
        "fdp",
    ),
)
def _(s, sf):
    return margins.direct_billing_unbalanced(_fd(s, sf))


@query(
    "fd_reconciliation_totals",
    check(
        f"""SELECT *, {d('receita_fd', 'despesa_fd')} AS saldo_fd FROM (SELECT count(*) AS projetos, count(*) FILTER (abs({d('rec_fd', 'desp_fd')}) <= 100) AS equilibrados,
 {m(None, 'rec_fd')} AS receita_fd, {m(None, 'desp_fd')} AS despesa_fd FROM fdp)""",
        "fdp",
    ),
)
def _(s, sf):
    return margins.direct_billing_totals(_fd(s, sf))


@query(
    "sales_kpis",
    check(
        f"""SELECT total, qtd, meses, round(total / qtd, 2) AS ticket_medio, round(total / meses, 2) AS media_mensal
 FROM (SELECT {m(ENT)} AS total, count(*) FILTER ({ENT}) AS qtd, count(DISTINCT {ym('data_vencimento')}) AS meses FROM ACC)""",
        "ACC",
    ),
)
def _(s, sf):
    return margins.sales_kpis(accrual_rows(I.ledger(s, sf)))


# --- days, aging -------------------------------------------------------------

DAYS = "data_pagamento - data_emissao"
W = lambda t, x: f"SUM(CASE WHEN {t} AND {DAYS} BETWEEN 0 AND 120 THEN {x} END)"
MONEY = "CAST(valor AS DECIMAL(18,2))"


@query(
    "pmr_pmp_monthly",
    check(
        f"""SELECT {ym('data_pagamento')} AS mes,
 round(CAST({W(ENT, f'({DAYS}) * {MONEY}')} AS DOUBLE) / CAST({W(ENT, MONEY)} AS DOUBLE), 1) AS pmr,
 round(CAST({W(SAI, f'({DAYS}) * {MONEY}')} AS DOUBLE) / CAST({W(SAI, MONEY)} AS DOUBLE), 1) AS pmp
 FROM L WHERE {PAID} AND data_pagamento >= {TODAY} - INTERVAL 12 MONTH AND data_pagamento < {TODAY} GROUP BY 1""",
        "L",
    ),
)
def _(s, sf):
    return terms.collection_days_by_month(I.ledger(s, sf), I.AS_OF)


@query(
    "pmr_pmp_contractual",
    check(
        f"""SELECT *, dias_real - dias_contratual AS diferenca FROM (SELECT tipo,
 CAST(round(CAST(SUM(({DAYS}) * {MONEY}) AS DOUBLE) / CAST(SUM({MONEY}) AS DOUBLE)) AS BIGINT) AS dias_real,
 CAST(round(CAST(SUM((data_vencimento - data_emissao) * {MONEY}) AS DOUBLE) / CAST(SUM({MONEY}) AS DOUBLE)) AS BIGINT) AS dias_contratual,
 count(*) AS qtd FROM L WHERE {PAID} AND {DAYS} BETWEEN 0 AND 120 GROUP BY 1)""",
        "L",
    ),
)
def _(s, sf):
    return terms.collection_days_contractual(cash_rows(I.ledger(s, sf)))


part("tarde", f"SELECT *, {TODAY} - data_vencimento AS dias FROM L WHERE {ENT} AND {LATE} AND data_vencimento < {TODAY}", "L")


@query(
    "aging_buckets",
    check(
        f"""SELECT CASE WHEN dias <= 30 THEN '1-30 dias' WHEN dias <= 60 THEN '31-60 dias' WHEN dias <= 90 THEN '61-90 dias' ELSE '90+ dias' END AS faixa,
 {m()} AS valor, count(*) AS qtd FROM tarde GROUP BY 1""",
        "tarde",
    ),
)
def _(s, sf):
    return terms.aging_buckets(cash_rows(I.ledger(s, sf)), I.AS_OF)


@query(
    "delinquency_kpi",
    check(
        f"""SELECT t.v AS total_atrasado, t.n AS titulos, round(t.v / e.v * 100, 1) AS pct,
 CASE WHEN t.v / e.v * 100 > 15 THEN 'vermelho' WHEN t.v / e.v * 100 > 5 THEN 'amarelo' ELSE 'verde' END AS faixa
 FROM (SELECT {m()} AS v, count(*) AS n FROM tarde) t, (SELECT {m(ENT)} AS v FROM L) e""",
        "tarde",
    ),
)
def _(s, sf):
    return terms.delinquency(cash_rows(I.ledger(s, sf)), I.AS_OF)


@query(
    "top_delinquents",
    check(
        f"""SELECT cliente_nome, {m()} AS valor, count(*) AS qtd, CAST(max(dias) AS BIGINT) AS max_dias FROM tarde GROUP BY 1
 ORDER BY valor DESC, cliente_nome LIMIT 10""",
        "tarde",
    ),
)
def _(s, sf):
    return terms.top_delinquents(cash_rows(I.ledger(s, sf, "client")), I.AS_OF)


# --- balances and overview ---------------------------------------------------


@query(
    "balance_by_account",
    check(
        f"""SELECT conta_id, conta_nome, CASE conta_tipo WHEN 'CC' THEN 'Conta Corrente' WHEN 'CR' THEN 'Cartão' WHEN 'CG' THEN 'Garantida'
 WHEN 'CA' THEN 'Aplicação' WHEN 'CX' THEN 'Caixa' ELSE conta_tipo END AS tipo, saldo, saldo_conciliado, {d('saldo', 'saldo_conciliado')} AS diferenca
 FROM saldos WHERE saldo <> 0""",
        "saldos",
    ),
)
def _(s, sf):
    return B.balance_list(I.balances(s, sf))


@query(
    "balance_total",
    check(
        f"""SELECT {m(None, 'saldo')} AS saldo_total, count(*) FILTER (saldo <> 0) AS contas,
 count(*) FILTER (CAST(saldo AS DECIMAL(18,2)) <> CAST(saldo_conciliado AS DECIMAL(18,2))) AS contas_nao_conciliadas FROM saldos""",
        "saldos",
    ),
)
def _(s, sf):
    return B.balance_total(I.balances(s, sf))


@query(
    "balance_asof_month",
    check(
        f"""SELECT {ym('mes_fim')} AS mes, 'Conta ' || conta AS conta_nome, saldo FROM hist
 WHERE mes_fim = (SELECT max(mes_fim) FROM hist WHERE mes_fim <= last_day({TODAY})) AND saldo <> 0""",
        "hist",
    ),
)
def _(s, sf):
    return B.month_end_balances(I.latest_balances(s, sf), I.AS_OF)


# Every month end of the orders and the same day two years earlier, so that some lie before an account's first balance.
part("fins", "SELECT DISTINCT unnest([mes_fim, last_day(CAST(mes_fim - INTERVAL 24 MONTH AS DATE))]) AS fim FROM hist", "hist")


@query(
    "balance_asof_months",
    check(
        """SELECT p.fim, p.conta AS conta_id, 'Conta ' || p.conta AS conta_nome, coalesce(h.mes_fim, n.mes_fim) AS data_referencia, coalesce(h.saldo, n.saldo) AS saldo
 FROM (SELECT DISTINCT conta, fim FROM hist, fins) p ASOF LEFT JOIN hist h ON h.conta = p.conta AND h.mes_fim <= p.fim
 JOIN (SELECT conta, max(mes_fim) AS mes_fim, arg_max(saldo, mes_fim) AS saldo FROM hist GROUP BY conta) n ON n.conta = p.conta""",
        "hist",
        "fins",
    ),
)
def _(s, sf):
    history = I.latest_balances(s, sf)
    days = history.select(F.explode(F.array("data_referencia", F.last_day(F.add_months("data_referencia", -24)))).alias("fim"))
    return B.balances_asof(history, days.distinct())


@query(
    "balance_curve",
    check(
        f"""SELECT {ym('mes_fim')} AS mes, {m(None, 'saldo')} AS saldo FROM hist WHERE conta <> 7 AND {ym('mes_fim')} <> '2000-01' GROUP BY 1
 UNION ALL SELECT '2000-01', {m(None, 'saldo')} FROM saldos""",
        "hist",
        "saldos",
    ),
)
def _(s, sf):
    # "conta 7" also matches no other of the 25 accounts
    return B.balance_curve(I.latest_balances(s, sf), I.balances(s, sf), I.AS_OF, excluded="Conta 7")


@query(
    "forecast_balance",
    check(
        f"""SELECT a_receber, a_pagar, t AS saldo_total, round(t + a_receber - a_pagar, 2) AS previsao
 FROM kpi_periodo, (SELECT {m(None, 'saldo')} AS t FROM saldos)""",
        "kpi_periodo",
        "saldos",
    ),
)
def _(s, sf):
    return B.forecast(flows.period_kpis(cash_rows(I.ledger(s, sf), DE, ATE)), I.balances(s, sf))


def _values(s, sf, months=None):
    months = overview.regime_months(I.ledger(s, sf)) if months is None else months
    return overview.overview_values(months, I.balances(s, sf), I.latest_balances(s, sf), I.AS_OF)


part("acc_total", f"SELECT {m(ENT)} AS e, {m(SAI)} AS s FROM ACC", "ACC")
part(
    "visao",
    f"""SELECT '2000-01' AS mes_atual, c.entrada AS receita_mes, p.entrada AS receita_mes_ant, c.saida AS despesa_mes,
 round((c.entrada - p.entrada) * 100 / p.entrada, 0) AS var_receita_pct, {d('a.e', 'a.s')} AS resultado, round({d('a.e', 'a.s')} * 100 / a.e, 1) AS margem_pct,
 t.vencido AS vencido_receber, t.vencido * 100 / t.entrada AS inad, sb.v AS saldo_total, sb.v / u.media AS caixa, h.v AS saldo_anterior,
 round((sb.v - h.v) * 100 / abs(h.v), 0) AS var_saldo_pct
 FROM (SELECT * FROM mes_caixa WHERE mes = '2000-01') c, (SELECT * FROM mes_caixa WHERE mes = '1999-12') p, acc_total a,
 (SELECT {m(None, 'entrada')} AS entrada, {m(None, 'vencido')} AS vencido FROM mes_caixa) t, (SELECT {m(None, 'saldo')} AS v FROM saldos) sb,
 (SELECT {m(None, 'saida')} / count(*) AS media FROM (SELECT saida FROM mes_caixa ORDER BY mes DESC LIMIT 3)) u,
 (SELECT {m(None, 'saldo')} AS v FROM hist WHERE mes_fim = (SELECT DISTINCT mes_fim FROM hist ORDER BY 1 DESC LIMIT 1 OFFSET 1)) h""",
    "mes_caixa",
    "acc_total",
    "saldos",
    "hist",
)


@query(
    "overview_kpis",
    check(
        """SELECT * EXCLUDE (inad, caixa), round(inad, 1) AS inadimplencia_pct,
 CASE WHEN inad > 15 THEN 'vermelho' WHEN inad > 5 THEN 'amarelo' ELSE 'verde' END AS faixa_inadimplencia, round(caixa, 1) AS meses_caixa,
 CASE WHEN caixa >= 6 THEN 'verde' WHEN caixa >= 3 THEN 'amarelo' ELSE 'vermelho' END AS faixa_caixa FROM visao""",
        "visao",
    ),
)
def _(s, sf):
    return overview.overview_kpis(_values(s, sf))


@query(
    "overview_series",
    check(
        f"""SELECT mes, entrada, saida, CAST(SUM(CAST(entrada AS DECIMAL(28,2)) - CAST(saida AS DECIMAL(28,2))) OVER (ORDER BY mes) AS DOUBLE) AS acumulado,
 CASE WHEN receita > 0 THEN round((receita - sd) / receita * 100) ELSE 0 END AS margem_pct FROM (
 SELECT c.mes, c.entrada, c.saida, COALESCE(a.receita, c.entrada) AS receita, CASE WHEN a.mes IS NULL THEN c.saida ELSE a.saida END AS sd
 FROM mes_caixa c LEFT JOIN mes_acc a ON a.mes = c.mes WHERE c.mes <= '2000-01' ORDER BY c.mes DESC LIMIT 6)""",
        "mes_caixa",
        "mes_acc",
    ),
)
def _(s, sf):
    return overview.overview_series(overview.regime_months(I.ledger(s, sf)), I.AS_OF)


@query(
    "alerts",
    check(
        f"""SELECT * FROM (
 SELECT 1::BIGINT AS prioridade, 'vermelho' AS classe, 'inadimplencia' AS regra, vencido_receber AS valor, inad AS referencia FROM visao WHERE inad > 10
 UNION ALL SELECT 2, 'vermelho', 'caixa', caixa, saldo_total FROM visao WHERE caixa < 4
 UNION ALL SELECT 3, 'amarelo', 'receita', receita_mes, receita_mes_ant FROM visao WHERE receita_mes_ant > 0 AND receita_mes < receita_mes_ant * 0.8
 UNION ALL SELECT 4, 'amarelo', 'projetos_negativos', count(*)::DOUBLE, 50000 FROM proj WHERE entrada > 50000 AND entrada < saida HAVING count(*) > 0
 UNION ALL SELECT 5, 'verde', 'orcamento', r, b FROM (SELECT {m(None, 'valor_real')} AS r, {m(None, 'valor_bp')} AS b FROM bud WHERE label = 'Receita Bruta' AND mes_com_real) WHERE b > 0 AND r > b * 1.1
 ) ORDER BY prioridade LIMIT 4""",
        "visao",
        "proj",
        "bud",
    ),
)
def _(s, sf):
    g = overview.month_cells(I.ledger(s, sf, "project"), "projeto_id")
    return overview.alerts(_values(s, sf, overview.months_of(g)), overview.projects_of(g), I.budget(s, sf))
