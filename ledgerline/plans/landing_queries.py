"""Landed records to clean tables, sales orders and clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import money as M
from ledgerline.functions import text as T
from ledgerline.operators import normalize, sales
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import PART_CODE, WORKDAY, check, d, m, part, ym
from ledgerline.plans.registry import query
from ledgerline.sources import document

IGN = "(conta IS NULL OR conta <> 24)"
part(
    "raw",
    f"""SELECT o_orderkey AS id, 'entrada' AS tipo, o_totalprice AS valor,
 CASE o_orderstatus WHEN 'F' THEN 'RECEBIDO' WHEN 'O' THEN 'A VENCER' WHEN 'P' THEN 'ATRASADO' END AS status,
 CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS data_vencimento, CAST(o_orderdate AS DATE) AS data_emissao,
 CASE WHEN o_orderkey % 10 <> 0 THEN {WORKDAY.format('CAST(o_orderdate AS DATE) + 30')} END AS prev,
 CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INTEGER) END AS mov,
 CAST(o_orderkey AS VARCHAR) AS numero_documento, NULL AS fiscal, '1.01.0' || left(o_orderpriority, 1) AS categoria_codigo,
 o_custkey % 500 AS projeto_id, o_custkey AS cliente_id, c_nationkey AS conta FROM orders LEFT JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT -(l_orderkey * 10 + l_linenumber), 'saida', l_extendedprice, CASE WHEN l_linestatus = 'F' THEN 'PAGO' WHEN l_returnflag = 'R' THEN 'ATRASADO'
  WHEN l_returnflag = 'A' THEN 'A VENCER' WHEN l_returnflag = 'N' THEN 'VENCE HOJE' END, CAST(l_shipdate AS DATE) + 45, CAST(l_shipdate AS DATE),
 {WORKDAY.format('CAST(l_shipdate AS DATE) + 45')}, NULL,
 CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'FD NF ' || l_orderkey ELSE l_orderkey || '/' || l_linenumber END,
 CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN 'fd ' || l_orderkey END, {PART_CODE}, NULL, l_suppkey + 1000000000, s_nationkey
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
part(
    "clean_titles",
    f"""SELECT *, COALESCE(prev, data_vencimento) AS data_previsao,
 CASE WHEN status IN ('PAGO','RECEBIDO') THEN COALESCE(mov, prev) END AS data_pagamento FROM raw WHERE {IGN}""",
    "raw",
)

DIRECT = "CASE WHEN tipo = 'entrada' THEN categoria_codigo = '1.01.03' ELSE numero_documento ILIKE '%fd%' OR COALESCE(fiscal, '') ILIKE '%fd%' END"
LEDGER_SQL = f"""SELECT t.id, tipo, valor, status, data_vencimento, data_emissao, data_pagamento, data_previsao, numero_documento, categoria_codigo,
 CASE WHEN tipo = 'entrada' THEN CASE categoria_codigo WHEN '1.01.03' THEN 'Faturamento Direto' ELSE categoria_codigo END ELSE (CASE categoria_codigo WHEN '2.01.01' THEN 'ECONOMY' WHEN '2.02.01' THEN 'STANDARD' WHEN '2.03.01' THEN 'MEDIUM'
  WHEN '2.04.01' THEN 'SMALL' WHEN '2.10.01' THEN 'LARGE' WHEN '2.05.01' THEN 'PROMO' END) END AS categoria_nome,
 regexp_extract(categoria_codigo, '^[^.]*\\.[^.]*') AS categoria_grupo, projeto_id,
 CASE WHEN projeto_id IS NULL OR projeto_id % 50 = 0 THEN 'Sem projeto' WHEN projeto_id % 7 = 0 THEN 'SK Projeto ' || projeto_id ELSE 'Projeto ' || projeto_id END AS projeto_nome,
 cliente_id, CASE WHEN tipo = 'saida' THEN s_name WHEN cliente_id = 0 OR cliente_id % 25 = 0 THEN '' WHEN cliente_id % 5 = 0 THEN c_name || ' SA' ELSE c_name END AS cliente_nome,
 CAST(conta AS BIGINT) AS conta_corrente_id, {DIRECT} AS is_faturamento_direto, CASE WHEN {DIRECT} THEN 'FD' ELSE 'SK' END AS modalidade
 FROM clean_titles t LEFT JOIN customer ON tipo = 'entrada' AND c_custkey = cliente_id LEFT JOIN supplier ON tipo = 'saida' AND s_suppkey = cliente_id - 1000000000"""


def _client_names(s, sf):
    return normalize.client_names(I.landed_twice(I.raw_clients(s, sf, suppliers=True), "nome_fantasia", "velho"))


# Customer 0 has no usable id and every 25th customer has neither name. Every lookup record has
# an older one with another name; direct billing comes by category for inflows, by document else.
@query("ledger_build", check(LEDGER_SQL, "clean_titles"))
def _(s, sf):
    return normalize.build_ledger(
        I.raw_receivables(s, sf),
        I.raw_payables(s, sf),
        normalize.clean_categories(I.landed_twice(I.raw_categories(s, sf).unionByName(I.inflow_categories(s, sf)), "descricao", "0.1 - velho")),
        normalize.clean_projects(I.landed_twice(I.raw_projects(s, sf), "nome", "velho")),
        _client_names(s, sf),
        normalize.payment_dates(I.raw_movements(s, sf)),
        I.IGNORED,
    )


@query(
    "normalize_titles",
    check(
        """SELECT id, tipo, valor, status, data_vencimento, data_emissao, data_previsao, numero_documento, categoria_codigo, projeto_id, cliente_id,
 CAST(conta AS BIGINT) AS conta_corrente_id FROM clean_titles""",
        "clean_titles",
    ),
)
def _(s, sf):
    both = normalize.type_titles(I.raw_receivables(s, sf), K.INFLOW, I.IGNORED).unionByName(
        normalize.type_titles(I.raw_payables(s, sf), K.OUTFLOW, I.IGNORED)
    )
    return both.drop("_previsao", "_fiscal")


@query(
    "payment_dates",
    check(
        """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INTEGER) AS data_movimento
 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 17 <> 0 AND o_orderkey <> 0"""
    ),
)
def _(s, sf):
    return normalize.payment_dates(I.raw_movements(s, sf))


@query(
    "categories_clean",
    check(
        f"""SELECT DISTINCT c AS codigo, p_type AS nome, regexp_extract(c, '^[^.]*\\.[^.]*') AS grupo FROM (SELECT p_type, {PART_CODE} AS c FROM part)
 UNION ALL SELECT grupo, nome, grupo FROM names_of_groups""",
        "names_of_groups",
    ),
)
def _(s, sf):
    return I.categories(s, sf)


@query(
    "missing_categories",
    check(
        """SELECT DISTINCT '1.01.0' || left(o_orderpriority, 1) AS codigo FROM orders LEFT JOIN customer ON c_custkey = o_custkey
 UNION SELECT '1.01' UNION SELECT '2.05' FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_type = 'PROMO'
 UNION SELECT '2.10' FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_type = 'LARGE'"""
    ),
)
def _(s, sf):
    used = I.raw_receivables(s, sf).select("codigo_categoria").unionByName(I.raw_payables(s, sf).select("codigo_categoria"))
    return normalize.missing_categories(used, I.categories(s, sf))


# The document's ledger rows: texts instead of dates and NULLs.
@query(
    "document_ledger",
    check(
        """SELECT id, valor, tipo, status, strftime(data, '%d/%m/%Y') AS data, strftime(data_vencimento, '%d/%m/%Y') AS data_vencimento,
 coalesce(strftime(data_pagamento, '%d/%m/%Y'), '') AS data_pagamento, strftime(data_previsao, '%d/%m/%Y') AS data_previsao, strftime(data_emissao, '%d/%m/%Y') AS data_emissao,
 categoria_codigo AS categoria, categoria_nome, projeto_id AS projeto, projeto_nome, cliente_nome, fd AS is_fd, CASE WHEN fd THEN 'FD' ELSE 'SK' END AS modalidade FROM L""",
        "L",
    ),
)
def _(s, sf):
    return document.ledger_block(I.ledger(s, sf, "category", "direct", "project", "client"))


@query(
    "document_balances",
    check(
        f"""SELECT conta_id AS id, conta_nome AS nome, conta_tipo AS tipo, saldo, saldo_conciliado, {d('saldo', 'saldo_conciliado')} AS diferenca,
 strftime(DATE '{I.AS_OF}' - 1, '%d/%m/%Y') AS data FROM saldos""",
        "saldos",
    ),
)
def _(s, sf):
    return document.balance_block(I.balances(s, sf))


@query("normalize_clients", check("SELECT * FROM cli", "cli"))
def _(s, sf):
    return I.clients(s, sf)


@query(
    "active_projects",
    check(
        """SELECT projeto_id AS id, CASE WHEN projeto_id % 7 = 0 THEN 'SK Projeto ' || projeto_id ELSE 'Projeto ' || projeto_id END AS nome
 FROM (SELECT DISTINCT c_custkey % 500 AS projeto_id FROM customer) WHERE projeto_id % 50 <> 0 AND projeto_id IN (SELECT o_custkey % 500 FROM orders)"""
    ),
)
def _(s, sf):
    used = I.ledger(s, sf, "project").select(F.col("projeto_id").alias("id"))
    return normalize.clean_projects(I.raw_projects(s, sf)).join(used, "id", "left_semi")


@query(
    "order_items_outer",
    check("SELECT * FROM items", "items"),
)
def _(s, sf):
    return I.order_items(s, sf)


@query(
    "normalize_orders",
    check("SELECT pedido_id, valor_mercadorias, etapa, data_previsao FROM pedidos", "pedidos"),
)
def _(s, sf):
    return sales.order_headers(I.order_items(s, sf))


@query(
    "sales_summary",
    check(
        f"""SELECT *, round(total_vendas / quantidade_pedidos, 2) AS ticket_medio FROM (SELECT {m(None, 'valor_mercadorias')} AS total_vendas, count(*) AS quantidade_pedidos FROM pedidos)""",
        "pedidos",
    ),
)
def _(s, sf):
    return sales.sales_summary(I.order_items(s, sf))


@query(
    "sales_by_month",
    check(
        f"SELECT {ym('data_previsao')} AS mes, {m(None, 'valor_mercadorias')} AS valor, count(*) AS qtd FROM pedidos WHERE data_previsao IS NOT NULL GROUP BY 1",
        "pedidos",
    ),
)
def _(s, sf):
    return sales.sales_by_month(I.order_items(s, sf))


@query("sales_by_stage", check("SELECT etapa, count(*) AS qtd FROM pedidos GROUP BY 1", "pedidos"))
def _(s, sf):
    return sales.sales_by_stage(I.order_items(s, sf))


@query(
    "top_products",
    check(
        f"""SELECT COALESCE(produto_descricao, 'Sem nome') AS produto, SUM(COALESCE(produto_quantidade, 0)) AS qtd, {m(None, 'produto_valor_total')} AS valor
 FROM items GROUP BY 1 ORDER BY valor DESC, produto LIMIT 10""",
        "items",
    ),
)
def _(s, sf):
    return sales.top_products(I.order_items(s, sf))


@query(
    "client_summary",
    check(
        """SELECT count(*) AS total_clientes, count(*) FILTER (ativo) AS ativos, count(*) FILTER (NOT ativo) AS inativos,
 count(*) FILTER (pessoa_fisica) AS pessoa_fisica, count(*) FILTER (NOT pessoa_fisica) AS pessoa_juridica FROM cli""",
        "cli",
    ),
)
def _(s, sf):
    return sales.client_summary(I.clients(s, sf))


@query(
    "clients_by_state",
    check("SELECT COALESCE(estado, 'N/I') AS estado, count(*) AS qtd FROM cli GROUP BY 1 ORDER BY qtd DESC, estado LIMIT 15", "cli"),
)
def _(s, sf):
    return sales.clients_by_state(I.clients(s, sf))


@query(
    "new_clients_monthly",
    check(
        f"SELECT {ym('data_cadastro')} AS mes, count(*) AS qtd FROM cli WHERE data_cadastro >= DATE '1996-01-01' GROUP BY 1",
        "cli",
    ),
)
def _(s, sf):
    return sales.new_clients_by_month(I.clients(s, sf), since_year=1996)


@query(
    "new_clients_last_12",
    check(
        f"SELECT {ym('data_cadastro')} AS mes, count(*) AS qtd FROM cli WHERE data_cadastro >= DATE '1995-01-01' GROUP BY 1 ORDER BY mes DESC LIMIT 12",
        "cli",
    ),
)
def _(s, sf):
    return sales.new_clients_by_month(I.clients(s, sf), since_year=1995, last=12)


@query(
    "period_presets",
    check(
        """SELECT DISTINCT dia, unnest(['mes','tri','ano','ytd','padrao']) AS preset,
 unnest([date_trunc('month', dia), date_trunc('quarter', dia), date_trunc('year', dia), date_trunc('year', dia), date_trunc('month', dia) - INTERVAL 6 MONTH]::DATE[]) AS de,
 unnest([last_day(dia), last_day(CAST(date_trunc('quarter', dia) + INTERVAL 2 MONTH AS DATE)), last_day(CAST(date_trunc('year', dia) + INTERVAL 11 MONTH AS DATE)), dia,
  date_trunc('month', dia) + INTERVAL 6 MONTH]::DATE[]) AS ate
 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dia FROM orders)"""
    ),
)
def _(s, sf):
    days = I.table(s, sf, "orders").select(F.to_date("o_orderdate").alias("dia")).distinct()
    return days.select("dia", F.explode(D.period_columns("dia")).alias("p")).select("dia", "p.*")


@query(
    "money_labels",
    check(
        """SELECT o_orderkey AS id, 'R$ ' || replace(replace(replace(format('{:,.2f}', o_totalprice), ',', 'X'), '.', ','), 'X', '.') AS valor_br,
 strftime(o_orderdate, '%d/%m/%Y') AS data_br, strftime(o_orderdate, '%Y-%m-%d') AS data_iso,
 CASE month(o_orderdate) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Fev' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Abr' WHEN 5 THEN 'Mai' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul'
  WHEN 8 THEN 'Ago' WHEN 9 THEN 'Set' WHEN 10 THEN 'Out' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dez' END || '/' || strftime(o_orderdate, '%y') AS mes_nome FROM orders"""
    ),
)
def _(s, sf):
    day = F.to_date("o_orderdate")
    return I.table(s, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        M.display_brl("o_totalprice").alias("valor_br"),
        D.show_br(day).alias("data_br"),
        D.show_iso(day).alias("data_iso"),
        D.month_label(D.month_text(day)).alias("mes_nome"),
    )


@query(
    "category_search",
    check("SELECT DISTINCT p_type AS nome FROM part WHERE lower(p_type) LIKE '%econom%'"),
)
def _(s, sf):
    cats = I.categories(s, sf).select("nome").distinct()
    return cats.filter(T.contains_folded("nome", "écoNôm"))


@query(
    "rejected_numbers",
    check(
        """SELECT 'salario' AS coluna, count(*) FILTER (p_partkey % 23 <> 0 AND p_partkey % 29 = 0) AS rejeitados FROM part
 UNION ALL SELECT 'idade', count(*) FILTER (p_partkey % 31 = 0) FROM part UNION ALL SELECT 'tempo_casa', 0 FROM part WHERE p_partkey = 0"""
    ),
)
def _(s, sf):
    return normalize.rejected_numbers(I.payroll_sheet(s, sf), ["salario", "idade", "tempo_casa"])
