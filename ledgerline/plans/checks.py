"""Building blocks of the ANSI-SQL checks (run by DuckDB on the same tables).

The checks are written from the meaning of each report, not from the Spark
code: decimals instead of cents, plain joins and subqueries.
"""

from __future__ import annotations

PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, body: str, *needs: str) -> None:
    PARTS[name] = (needs, body)


def check(body: str, *needs: str) -> str:
    """SELECT with the CTEs it needs, in dependency order."""
    done: list[str] = []

    def add(n: str) -> None:
        if n in done:
            return
        for d in PARTS[n][0]:
            add(d)
        done.append(n)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in done)
    return (f"WITH {ctes}\n" if ctes else "") + body


def m(where: str | None = None, v: str = "valor") -> str:
    """Exact sum of an amount as DOUBLE, 0 when nothing matches."""
    x = f"CASE WHEN {where} THEN {v} END" if where else v
    return f"COALESCE(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE), 0)"


def d(a: str, b: str) -> str:
    """Difference of two exact amounts."""
    return f"CAST(CAST({a} AS DECIMAL(28,2)) - CAST({b} AS DECIMAL(28,2)) AS DOUBLE)"


def ym(c: str) -> str:
    return f"strftime({c}, '%Y-%m')"


ENT = "tipo = 'entrada'"
SAI = "tipo = 'saida'"
DONE = "status IN ('RECEBIDO','PAGO','LIQUIDADO','CANCELADO')"
OPEN = "status IN ('A VENCER','ATRASADO','VENCE HOJE')"
LATE = "status = 'ATRASADO'"
PAID = "status IN ('PAGO','RECEBIDO')"

PART_CODE = """CASE p_type WHEN 'ECONOMY' THEN '2.01.01' WHEN 'STANDARD' THEN '2.02.01' WHEN 'MEDIUM' THEN '2.03.01'
 WHEN 'SMALL' THEN '2.04.01' WHEN 'LARGE' THEN '2.10.01' WHEN 'PROMO' THEN '2.05.01' END"""
WORKDAY = "{0} + CASE dayofweek({0}) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END"

part(
    "titles",
    f"""SELECT o_orderkey AS id, 'entrada' AS tipo, o_totalprice AS valor,
 CASE o_orderstatus WHEN 'F' THEN 'RECEBIDO' WHEN 'O' THEN 'A VENCER' WHEN 'P' THEN 'ATRASADO' END AS status,
 CAST(o_orderdate AS DATE) AS data_emissao, CAST(o_orderdate AS DATE) + 30 AS data_vencimento,
 CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 150 AS INTEGER) END AS data_pagamento,
 CAST(o_orderkey AS VARCHAR) AS numero_documento, '1.01.0' || left(o_orderpriority, 1) AS categoria_codigo,
 CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Faturamento Direto' ELSE c_mktsegment END AS categoria_nome,
 c_mktsegment = 'MACHINERY' AS fd, NULLIF(o_custkey % 500, 0) AS projeto_id, c_name AS cliente_nome,
 c_nationkey AS conta
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
UNION ALL
SELECT NULL, 'saida', l_extendedprice,
 CASE WHEN l_linestatus = 'F' THEN 'PAGO' WHEN l_returnflag = 'R' THEN 'ATRASADO' WHEN l_returnflag = 'A' THEN 'A VENCER'
  WHEN l_returnflag = 'N' THEN 'VENCE HOJE' END,
 CAST(l_shipdate AS DATE), CAST(l_shipdate AS DATE) + 45,
 CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 150 AS INTEGER) END,
 CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'FD NF ' || l_orderkey ELSE l_orderkey || '/' || l_linenumber END,
 {PART_CODE}, p_type, l_returnflag = 'N' AND l_linenumber = 1, NULLIF(o_custkey % 500, 0), s_name, s_nationkey
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
 LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
part(
    "L",
    f"""SELECT *, {WORKDAY.format('data_vencimento')} AS data_previsao,
 regexp_extract(categoria_codigo, '^[^.]*\\.[^.]*') AS grupo,
 CASE WHEN status IN ('PAGO','RECEBIDO','LIQUIDADO') AND data_pagamento IS NOT NULL THEN data_pagamento
  ELSE {WORKDAY.format('data_vencimento')} END AS data,
 CASE WHEN projeto_id IS NULL THEN 'Sem projeto' WHEN projeto_id % 7 = 0 THEN 'SK Projeto ' || projeto_id
  ELSE 'Projeto ' || projeto_id END AS projeto_nome
FROM titles""",
    "titles",
)
part("ACC", "SELECT * FROM L WHERE status <> 'ATRASADO'", "L")
part(
    "names_of_groups",
    f"""SELECT DISTINCT regexp_extract(c, '^[^.]*\\.[^.]*') AS grupo,
 'Grupo ' || regexp_extract(c, '^[^.]*\\.[^.]*') AS nome FROM (SELECT {PART_CODE} AS c FROM part)
 WHERE c NOT LIKE '2.05%' AND c NOT LIKE '2.10%'""",
)
part(
    "saldos",
    """SELECT c_custkey AS conta_id, c_name AS conta_nome,
 CASE c_custkey % 6 WHEN 0 THEN 'CC' WHEN 1 THEN 'CR' WHEN 2 THEN 'CG' WHEN 3 THEN 'CA' WHEN 4 THEN 'CX' ELSE 'ZZ' END AS conta_tipo,
 CASE WHEN c_custkey % 43 = 0 OR c_custkey % 41 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS saldo,
 CASE WHEN c_custkey % 43 = 0 OR c_custkey % 41 = 0 THEN 0.0::DOUBLE WHEN c_custkey % 3 = 0
  THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) - 10.50 AS DOUBLE) ELSE c_acctbal END AS saldo_conciliado
FROM customer WHERE c_custkey <> 0 AND c_custkey <> 24""",
)
part(
    "hist",
    """SELECT conta, mes_fim, saldo FROM (SELECT o_custkey % 25 AS conta, last_day(CAST(o_orderdate AS DATE)) AS mes_fim,
 o_totalprice AS saldo, row_number() OVER (PARTITION BY o_custkey % 25, last_day(CAST(o_orderdate AS DATE))
 ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""",
)
part(
    "linhas_pedido",
    """SELECT o_orderkey AS pedido_id, o_totalprice AS valor_mercadorias,
 CASE left(o_orderpriority, 1) WHEN '1' THEN 'Em Aberto' WHEN '2' THEN 'Em Aprovação' WHEN '3' THEN 'Aprovado'
  WHEN '4' THEN 'Separar' ELSE '95' END AS etapa,
 CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_previsao,
 p_name AS produto_descricao, l_quantity AS produto_quantidade, l_extendedprice AS produto_valor_total, l_linenumber
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey""",
)
# Even lines come with a free sample.
part(
    "items",
    """SELECT * EXCLUDE (l_linenumber) FROM linhas_pedido UNION ALL SELECT pedido_id, valor_mercadorias, etapa, data_previsao, produto_descricao, 1.0::DOUBLE, 0.0::DOUBLE
 FROM linhas_pedido WHERE l_linenumber % 2 = 0""",
    "linhas_pedido",
)
part("pedidos", "SELECT DISTINCT pedido_id, valor_mercadorias, etapa, data_previsao FROM items", "items")
part(
    "cli",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS nome_fantasia,
 CASE WHEN c_custkey % 25 = 0 THEN '' ELSE c_name || ' SA' END AS razao_social,
 CASE WHEN c_nationkey <> 3 THEN n_name END AS estado, c_acctbal >= 0 AS ativo,
 c_mktsegment = 'HOUSEHOLD' AS pessoa_fisica, CAST(f.primeira AS DATE) AS data_cadastro
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
 LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS primeira FROM orders GROUP BY 1) f ON f.o_custkey = c_custkey
WHERE c_custkey <> 0""",
)
LINE = """CASE p_type WHEN 'ECONOMY' THEN 'Receita Bruta' WHEN 'STANDARD' THEN 'Impostos' WHEN 'MEDIUM' THEN 'Custos Operacionais'
 WHEN 'SMALL' THEN 'Despesas Gerais e Adm' WHEN 'LARGE' THEN 'EBITDA' WHEN 'PROMO' THEN 'Lucro Líquido' END"""
SECTION = """CASE p_type WHEN 'ECONOMY' THEN 'receita' WHEN 'STANDARD' THEN 'impostos' WHEN 'MEDIUM' THEN 'custos'
 WHEN 'SMALL' THEN 'sga' WHEN 'LARGE' THEN 'ebitda' WHEN 'PROMO' THEN 'll' END"""
FACTOR = """CASE p_type WHEN 'ECONOMY' THEN 95 WHEN 'STANDARD' THEN 120 WHEN 'MEDIUM' THEN 90 WHEN 'SMALL' THEN 150
 WHEN 'LARGE' THEN 80 WHEN 'PROMO' THEN 100 END"""
NET = """SUM(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))"""
GROSS = """SUM(CAST(round(l_extendedprice * 100) AS BIGINT))"""
part(
    "bud",
    f"""SELECT {LINE} AS label, {SECTION} AS section, CASE p_type WHEN 'STANDARD' THEN 1 ELSE 0 END AS level, mes,
 CAST((net + 50) // 100 AS DOUBLE) / 100 AS valor_real,
 CASE WHEN p_type = 'PROMO' AND mes LIKE '%-02' THEN 0 ELSE CAST((gross * ({FACTOR}) + 50) // 100 AS DOUBLE) / 100 END AS valor_bp,
 mes < '2000-01' AS mes_com_real
FROM (SELECT p_type, strftime(l_shipdate, '%Y-%m') AS mes, {NET} AS net, {GROSS} AS gross
 FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)""",
)
part(
    "fin",
    "SELECT grupo, strftime(data_vencimento, '%Y-%m') AS mes, " + m() + " AS valor FROM ACC WHERE tipo = 'saida' GROUP BY 1, 2",
    "ACC",
)
part(
    "mes_acc",
    f"SELECT strftime(data_vencimento, '%Y-%m') AS mes, {m(ENT)} AS receita, {m(SAI)} AS saida FROM ACC GROUP BY 1",
    "ACC",
)
part(
    "mes_caixa",
    f"SELECT strftime(data, '%Y-%m') AS mes, {m(ENT)} AS entrada, {m(SAI)} AS saida, {m(ENT + ' AND ' + LATE)} AS vencido FROM L GROUP BY 1",
    "L",
)
# Payroll sheet, already as numbers.
part(
    "folha_raw",
    """SELECT p_partkey AS k, '1999-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') AS mes, p_brand AS dept,
 CASE WHEN p_partkey % 51 = 0 OR p_partkey % 53 = 0 THEN NULL ELSE p_name END AS cargo,
 CASE WHEN p_partkey % 50 = 0 THEN 'Totais' WHEN p_partkey % 51 = 0 THEN upper(p_brand) WHEN p_partkey % 53 = 0 THEN 'COMERCIAL'
  WHEN p_partkey % 59 = 0 THEN NULL ELSE 'Func ' || p_partkey END AS nome,
 CASE WHEN p_partkey % 23 = 0 OR p_partkey % 29 = 0 THEN 0 ELSE p_retailprice END AS sal,
 CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 0 ELSE p_size END AS idade,
 CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 120 ELSE 0 END AS casa, p_size, p_retailprice,
 CASE WHEN p_partkey % 19 = 0 THEN 100.5 ELSE 0 END AS resc FROM part""",
)
part(
    "folha",
    """SELECT nome, dept AS departamento, COALESCE(cargo, '') AS cargo,
 CASE WHEN k % 4 <> 0 THEN DATE '1998-05-04' END AS data_admissao, CASE WHEN idade > 0 THEN CAST(idade AS BIGINT) END AS idade,
 CAST(casa AS DOUBLE) AS tempo_casa_meses, CAST(sal AS DOUBLE) AS salario, CAST(p_size AS DOUBLE) AS comissao, CAST(p_size * 2 AS DOUBLE) AS bonus,
 CAST(resc AS DOUBLE) AS rescisao, CAST(16.75 + p_size AS DOUBLE) AS beneficios,
 CAST(CAST(p_retailprice AS DECIMAL(18,2)) + 200 - CAST(resc AS DECIMAL(18,2)) AS DOUBLE) AS custo_total, mes AS mes_referencia,
 CASE WHEN mes < '1999-07' THEN 'realizado' WHEN mes = '1999-07' THEN 'andamento' ELSE 'projecao' END AS status
FROM folha_raw WHERE nome IS NOT NULL AND upper(nome) NOT IN ('TOTAIS', 'TOTAL') AND k % 51 <> 0 AND k % 53 <> 0 AND sal > 0""",
    "folha_raw",
)
part(
    "months12",
    "SELECT '1999-' || lpad(CAST(i AS VARCHAR), 2, '0') AS mes, i FROM range(1, 13) t(i)",
)
RUBRICS = ("salarios", "softwares", "beneficios", "comissao", "rescisao", "bonus", "impostos", "treinamentos", "decimo_terceiro")
# Lines of September and November are booked a month later, those of the seventh rubric on the eighth.
part(
    "linhas",
    """SELECT CASE WHEN month(l_shipdate) IN (9, 11) THEN month(l_shipdate) + 1 ELSE month(l_shipdate) END AS mm, l_suppkey, l_linenumber,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS c FROM lineitem""",
)
part(
    "custo",
    "SELECT mes, rubrica, COALESCE(v, 0) AS valor FROM (SELECT mes, i, unnest(["
    + ",".join(f"'{r}'" for r in (*RUBRICS, "total"))
    + f"""]) AS rubrica FROM months12) g LEFT JOIN (
 SELECT mm, COALESCE(rub, 'total') AS r, CAST(SUM(c) AS DOUBLE) AS v FROM (
  SELECT *, CASE l_suppkey % 9 {' '.join(f"WHEN {i} THEN '{RUBRICS[8] if i == 7 else r}'" for i, r in enumerate(RUBRICS))} END AS rub FROM linhas
 ) GROUP BY GROUPING SETS ((mm, rub), (mm))
) x ON x.mm = g.i AND x.r = g.rubrica""",
    "months12",
    "linhas",
)
# Gap filling: the two empty months take the month before.
part(
    "custo_cheio",
    "SELECT m.mes, c.rubrica, c.valor FROM months12 m JOIN custo c ON c.mes = CASE m.mes WHEN '1999-09' THEN '1999-08' WHEN '1999-11' THEN '1999-10' ELSE m.mes END",
    "months12",
    "custo",
)
part(
    "areas",
    """SELECT '1999-' || lpad(CAST(mm AS VARCHAR), 2, '0') AS mes, 'Area ' || l_linenumber AS area, CAST(SUM(c) AS DOUBLE) AS valor FROM linhas GROUP BY 1, 2
 UNION ALL SELECT DISTINCT unnest(['1999-09', '1999-11']), 'Area ' || l_linenumber, 0.0::DOUBLE FROM linhas""",
    "linhas",
)
part(
    "hc",
    """SELECT mes, inicio, admissoes, saida_vol, saida_inv, inicio + admissoes - saida_vol - saida_inv AS final,
 CAST((saida_vol + saida_inv) * 10000 // inicio AS DOUBLE) / 10000 AS turnover FROM (
 SELECT '1999-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mes, count(*) AS inicio,
 count(*) FILTER (o_orderstatus = 'F') AS admissoes, count(*) FILTER (o_orderstatus = 'P') AS saida_vol,
 count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS saida_inv FROM orders GROUP BY 1)""",
)
part(
    "demo",
    f"""SELECT mes, COALESCE(dept, 'EMPRESA') AS area, round(CAST(SUM(idade) AS DOUBLE) / count(*), 1) AS idade_media,
 round(CAST(SUM(casa) AS DOUBLE) / count(*), 1) AS tempo_casa_medio, count(*) AS hc,
 round({m(None, 'p_retailprice + 200')} / count(*), 2) AS custo_per_capita
FROM folha_raw WHERE idade IS NOT NULL GROUP BY GROUPING SETS ((mes, dept), (mes))""",
    "folha_raw",
)
part(
    "nat",
    f"SELECT c_nationkey AS nacao, strftime(o_orderdate, '%Y-%m') AS mes, {m(None, 'o_totalprice')} AS valor FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2",
)
part(
    "slog",
    """SELECT CAST(event_id AS VARCHAR) AS sync_id, ts AS started_at,
 CASE WHEN event_type <> 'view' THEN ts + to_seconds(floor(value)) END AS finished_at,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status FROM events""",
)
part("nomes", "SELECT DISTINCT p_name AS nome, 'projeto' AS tipo FROM part UNION ALL SELECT DISTINCT s_name, 'cliente' FROM supplier")
