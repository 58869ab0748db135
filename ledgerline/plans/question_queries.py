"""Fixed answers: analysis snapshot, recipes, name search, audit, chat."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import text as T
from ledgerline.operators import questions as Q
from ledgerline.operators import search
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import ENT, LATE, OPEN, PAID, SAI, check, d, m, part, ym
from ledgerline.plans.registry import query

AS_OF = I.AS_OF
TODAY = f"DATE '{AS_OF}'"
REC = f"{ENT} AND status = 'RECEBIDO'"
PAGO = f"{SAI} AND status = 'PAGO'"
MONTH = "{0} >= DATE '2000-01-01' AND {0} < DATE '2000-02-01'"
WEEK = "{0} BETWEEN DATE '1999-12-27' AND DATE '2000-01-02'"
# the year reports run on the day before, so that they cover a whole year
YEAR_END = "1999-12-31"
YEAR = "{0} BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"


@query(
    "snapshot_summary",
    check(
        f"""SELECT mes, receita, despesa, {d('receita', 'despesa')} AS resultado FROM (SELECT {ym('data_pagamento')} AS mes, {m(ENT)} AS receita, {m(SAI)} AS despesa
 FROM L WHERE {PAID} AND data_pagamento >= {TODAY} - INTERVAL 6 MONTH GROUP BY 1)""",
        "L",
    ),
)
def _(s, sf):
    return Q.settled_summary(I.ledger(s, sf), AS_OF)


@query(
    "snapshot_open",
    check(
        f"SELECT tipo, {m()} AS total, count(*) AS qtd, {m(LATE)} AS atrasado, count(*) FILTER ({LATE}) AS qtd_atrasado FROM L WHERE {OPEN} GROUP BY 1",
        "L",
    ),
)
def _(s, sf):
    return Q.open_totals(I.ledger(s, sf))


@query(
    "snapshot_top_expenses",
    check(
        f"""SELECT categoria_nome, {m()} AS total FROM L WHERE {PAGO} AND data_pagamento >= {TODAY} - INTERVAL 3 MONTH GROUP BY 1 ORDER BY total DESC, 1 LIMIT 10""",
        "L",
    ),
)
def _(s, sf):
    return Q.top_expense_categories(I.ledger(s, sf, "category"), AS_OF)


@query(
    "snapshot_top_clients",
    check(
        f"""SELECT cliente_nome, {m()} AS total FROM L WHERE {REC} AND data_pagamento >= {TODAY} - INTERVAL 3 MONTH GROUP BY 1 ORDER BY total DESC, 1 LIMIT 5""",
        "L",
    ),
)
def _(s, sf):
    return Q.top_revenue_clients(I.ledger(s, sf, "client"), AS_OF)


@query(
    "snapshot_margins",
    check(
        f"""SELECT * FROM (SELECT projeto_nome, {m(ENT)} AS receita, {m(SAI)} AS custo FROM L WHERE projeto_id IS NOT NULL AND {PAID}
 AND data_pagamento >= {TODAY} - INTERVAL 3 MONTH GROUP BY 1) WHERE receita > 0 OR custo > 0 ORDER BY receita DESC, projeto_nome LIMIT 10""",
        "L",
    ),
)
def _(s, sf):
    return Q.recent_project_margins(I.ledger(s, sf, "project"), AS_OF)


@query(
    "revenue_of_month",
    check(f"SELECT {m()} AS total_faturado, count(*) AS qtd FROM L WHERE {REC} AND {MONTH.format('data_pagamento')}", "L"),
)
def _(s, sf):
    return Q.revenue_of_month(I.ledger(s, sf), AS_OF)


def by_client(where: str, limit: int | None = 20, key: str = "cliente_nome") -> str:
    cut = f" ORDER BY total DESC, 1 LIMIT {limit}" if limit else ""
    return check(f"SELECT {key}, {m()} AS total, count(*) AS qtd FROM L WHERE {where} GROUP BY 1{cut}", "L")


@query("expected_receipts", by_client(f"{ENT} AND {OPEN} AND {MONTH.format('data_vencimento')}"))
def _(s, sf):
    return Q.expected_receipts(I.ledger(s, sf, "client"), AS_OF)


@query(
    "projects_by_emission",
    by_client(f"projeto_id IS NOT NULL AND {MONTH.format('data_emissao')}", None, "projeto_nome"),
)
def _(s, sf):
    return Q.projects_issued(I.ledger(s, sf, "project"), AS_OF)


@query("overdue_by_supplier", by_client(f"{SAI} AND {LATE}"))
def _(s, sf):
    return Q.overdue_by_supplier(I.ledger(s, sf, "client"))


@query(
    "supplier_open_items",
    check(
        f"""SELECT valor, status, strftime(data_vencimento, '%d/%m/%Y') AS vencimento, categoria_nome, data_vencimento, numero_documento
 FROM L WHERE {SAI} AND {OPEN} AND lower(cliente_nome) LIKE '%supplier%' AND cliente_nome LIKE '%0003%'""",
        "L",
    ),
)
def _(s, sf):
    return Q.supplier_open_items(I.ledger(s, sf, "client", "category"), ["supplier", "0003"])


@query(
    "project_margin",
    check(
        f"""SELECT *, {d('receita', 'custo')} AS margem FROM (SELECT projeto_nome, {m(ENT)} AS receita, {m(SAI)} AS custo FROM L WHERE projeto_id IS NOT NULL AND {PAID} GROUP BY 1)""",
        "L",
    ),
)
def _(s, sf):
    return Q.project_margin(I.ledger(s, sf, "project"))


@query(
    "due_next_30",
    check(
        f"SELECT id, cliente_nome, valor, data_vencimento, status FROM L WHERE {ENT} AND {OPEN} AND data_vencimento BETWEEN {TODAY} AND {TODAY} + 30",
        "L",
    ),
)
def _(s, sf):
    return Q.due_next_days(I.ledger(s, sf, "client"), AS_OF)


@query(
    "due_this_week",
    check(f"SELECT tipo, {m()} AS total, count(*) AS qtd FROM L WHERE {OPEN} AND {WEEK.format('data_previsao')} GROUP BY 1", "L"),
)
def _(s, sf):
    return Q.due_this_week(I.ledger(s, sf), AS_OF)


part(
    "forn",
    f"SELECT * FROM L WHERE {SAI} AND lower(cliente_nome) LIKE '%supplier%' AND cliente_nome LIKE '%0003%'",
    "L",
)
part("forn_mes", f"SELECT {ym('data_pagamento')} AS mes, {m()} AS total, count(*) AS qtd FROM forn WHERE status = 'PAGO' AND {YEAR.format('data_pagamento')} GROUP BY 1", "forn")


@query(
    "supplier_spend",
    check(
        f"""SELECT mes, total, qtd, mes = (SELECT mes FROM forn_mes ORDER BY total DESC, mes DESC LIMIT 1) AS mais_caro FROM forn_mes
 UNION ALL SELECT 'ANO', {m()}, count(*), FALSE FROM forn WHERE status = 'PAGO' AND {YEAR.format('data_pagamento')} HAVING count(*) > 0
 UNION ALL SELECT 'ABERTO', {m()}, count(*), FALSE FROM forn WHERE {OPEN} HAVING count(*) > 0""",
        "forn",
        "forn_mes",
    ),
)
def _(s, sf):
    return Q.supplier_spend(I.ledger(s, sf, "client"), ["supplier", "0003"], YEAR_END)


@query("top_suppliers", by_client(f"{PAGO} AND {YEAR.format('data_pagamento')}"))
def _(s, sf):
    return Q.top_suppliers(I.ledger(s, sf, "client"), YEAR_END)


@query(
    "loss_projects",
    check(
        f"""SELECT *, {d('entrada', 'saida')} AS resultado FROM (SELECT projeto_nome, {m(ENT)} AS entrada, {m(SAI)} AS saida FROM L WHERE projeto_id IS NOT NULL GROUP BY 1) WHERE saida > entrada""",
        "L",
    ),
)
def _(s, sf):
    return Q.loss_projects(I.ledger(s, sf, "project"))


@query(
    "project_result",
    check(
        f"SELECT *, {d('entrada', 'saida')} AS resultado FROM (SELECT {m(ENT)} AS entrada, {m(SAI)} AS saida FROM L WHERE projeto_nome LIKE '%12%' AND lower(projeto_nome) LIKE '%projeto%')",
        "L",
    ),
)
def _(s, sf):
    return Q.project_result(I.ledger(s, sf, "project"), ["12", "projeto"])


@query(
    "top_debtor",
    check(
        f"SELECT cliente_nome, {m()} AS total, {m(LATE)} AS vencido, count(*) AS qtd FROM L WHERE {ENT} AND {OPEN} GROUP BY 1 ORDER BY total DESC, 1 LIMIT 1",
        "L",
    ),
)
def _(s, sf):
    return Q.top_debtor(I.ledger(s, sf, "client"))


@query(
    "category_spend",
    check(
        f"SELECT {ym('data_pagamento')} AS mes, {m()} AS total, count(*) AS qtd FROM L WHERE {PAGO} AND {YEAR.format('data_pagamento')} AND categoria_nome = 'ECONOMY' GROUP BY 1",
        "L",
    ),
)
def _(s, sf):
    return Q.category_spend(I.ledger(s, sf, "category"), "econômy", YEAR_END)


@query(
    "month_vs_month",
    check(
        f"""SELECT *, {d('mes_2', 'mes_1')} AS diferenca, round({d('mes_2', 'mes_1')} / mes_1 * 100, 1) AS variacao_pct FROM (SELECT
 {m(REC + f" AND {ym('data_pagamento')} = '1999-11'")} AS mes_1, {m(REC + f" AND {ym('data_pagamento')} = '1999-12'")} AS mes_2 FROM L)""",
        "L",
    ),
)
def _(s, sf):
    return Q.month_vs_month(I.ledger(s, sf), "1999-11", "1999-12")


@query(
    "projects_with_revenue",
    by_client(f"{REC} AND projeto_id IS NOT NULL AND {MONTH.format('data_pagamento')}", None, "projeto_nome"),
)
def _(s, sf):
    return Q.projects_with_revenue(I.ledger(s, sf, "project"), AS_OF)


@query("clients_that_paid", by_client(f"{REC} AND {MONTH.format('data_pagamento')}", None))
def _(s, sf):
    return Q.clients_that_paid(I.ledger(s, sf, "client"), AS_OF)


@query(
    "issued_this_week",
    check(
        f"SELECT tipo, numero_documento, cliente_nome, data_emissao, valor FROM L WHERE {WEEK.format('data_emissao')}", "L"
    ),
)
def _(s, sf):
    return Q.issued_this_week(I.ledger(s, sf, "client"), AS_OF)


DIGEST = {
    "recebido": f"{REC} AND {MONTH.format('data_pagamento')}",
    "pago": f"{PAGO} AND {MONTH.format('data_pagamento')}",
    "a_receber": f"{ENT} AND {OPEN}",
    "a_pagar": f"{SAI} AND {OPEN}",
    "receber_atrasado": f"{ENT} AND {LATE}",
    "pagar_atrasado": f"{SAI} AND {LATE}",
}


@query(
    "month_digest",
    check(
        " UNION ALL ".join(f"SELECT '{k}' AS indicador, {m(w)} AS valor FROM L" for k, w in DIGEST.items())
        + f" UNION ALL SELECT 'saldo', {m(None, 'saldo')} FROM saldos",
        "L",
        "saldos",
    ),
)
def _(s, sf):
    return Q.month_digest(I.ledger(s, sf), I.balances(s, sf), AS_OF)


@query("ledger_check", check("SELECT count(*) AS linhas, max(data_emissao) AS ultima_emissao FROM L", "L"))
def _(s, sf):
    return Q.ledger_check(I.ledger(s, sf))


@query(
    "document_lookup",
    check("SELECT tipo, numero_documento, cliente_nome, valor, status, data_vencimento FROM L WHERE numero_documento = '98'", "L"),
)
def _(s, sf):
    cols = ["tipo", "numero_documento", "cliente_nome", "valor", "status", "data_vencimento"]
    return Q.by_document(I.ledger(s, sf, "client"), "98").select(*cols)


# --- search, audit, chat -----------------------------------------------------

STOP = ", ".join(f"'{w}'" for w in K.STOPWORDS)
part(
    "perguntas",
    """SELECT conv_id || ' ' || turn AS pergunta, CASE (conv_id + turn) % 5 WHEN 0 THEN 'Quanto ' || upper(a.p_name) || '?'
 WHEN 1 THEN split_part(a.p_name, ' ', 1) || ' e a ' || split_part(b.p_name, ' ', 2) || ' esse mês'
 WHEN 2 THEN 'Supplier ' || lpad(CAST(conv_id % 10 AS VARCHAR), 9, '0') WHEN 3 THEN 'total de ' || split_part(b.p_name, ' ', 2) ELSE text END AS texto
 FROM conversations JOIN part a ON a.p_partkey = (conv_id * 31 + turn) % 200 JOIN part b ON b.p_partkey = (conv_id * 17 + turn) % 200 WHERE role = 'user'""",
)
part(
    "palavras",
    f"""SELECT pergunta, list_filter(list_transform(list_filter(regexp_split_to_array(trim(lower(texto)), '\\s+'),
 lambda w: length(w) > 2 AND w NOT IN ({STOP})), lambda w: regexp_replace(w, '{T.TOKEN_CHARS}', '', 'g')), lambda w: w <> '') AS w FROM perguntas""",
    "perguntas",
)
part(
    "regras",
    """SELECT pergunta, 0 AS regra, w[:4] AS p FROM palavras WHERE len(w) > 0
 UNION ALL SELECT pergunta, i, [l[i]] FROM (SELECT pergunta, w, list_filter(w, lambda x: length(x) > 3)[:2] AS l FROM palavras), range(1, 3) t(i) WHERE i <= len(l) AND l <> w""",
    "palavras",
)
part(
    "achados",
    """SELECT pergunta, regra, tipo, nome FROM (SELECT r.pergunta, r.regra, n.tipo, n.nome, row_number() OVER (PARTITION BY r.pergunta, r.regra, n.tipo ORDER BY n.nome) AS k
 FROM regras r JOIN nomes n ON len(list_filter(r.p, lambda x: contains(lower(n.nome), x))) = len(r.p)) WHERE k <= CASE regra WHEN 0 THEN 10 ELSE 5 END""",
    "regras",
    "nomes",
)


@query("question_tokens", check("SELECT pergunta, array_to_string(w, ' ') AS palavras, len(w) AS qtd FROM palavras", "palavras"))
def _(s, sf):
    words = T.tokens("texto")
    return I.questions(s, sf).select("pergunta", F.concat_ws(" ", words).alias("palavras"), F.size(words).cast("long").alias("qtd"))


@query(
    "name_resolver",
    check(
        """SELECT pergunta, nome, tipo, posicao FROM (SELECT pergunta, nome, tipo, row_number() OVER (PARTITION BY pergunta ORDER BY CASE tipo WHEN 'projeto' THEN 0 ELSE 1 END, nome) AS posicao
 FROM (SELECT pergunta, nome, max(tipo) AS tipo FROM achados a WHERE regra = 0 OR NOT EXISTS (SELECT 1 FROM achados b WHERE b.pergunta = a.pergunta AND b.regra = 0) GROUP BY pergunta, nome))
 WHERE posicao <= 10""",
        "achados",
    ),
)
def _(s, sf):
    return search.resolve_questions(I.names(s, sf), I.questions(s, sf))


@query(
    "name_search",
    check("SELECT DISTINCT p_name AS nome FROM part WHERE lower(p_name) LIKE '%ri%' ORDER BY 1 LIMIT 20"),
)
def _(s, sf):
    return search.search_names(I.table(s, sf, "part").select(F.col("p_name").alias("nome")).distinct(), "nome", " RI ")


# What the eight logged texts must yield: (reason for a normal user, reason for an executive, strict, in order).
VERDICTS = (
    ("", "", True),
    ("not_select", "not_select", False),
    ("", "", False),
    ("restricted_table", "", True),
    ("foreign_dataset", "foreign_dataset", False),
    ("restricted_table", "", True),
    ("banned_word", "banned_word", False),
    ("", "", True),
)


@query(
    "query_audit",
    check(
        "SELECT *, motivo = '' AS permitido, motivo = '' AND consulta % 8 <> 2 AS estrito FROM (SELECT o_orderkey AS consulta, CASE o_orderkey % 8 "
        + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(I.QUERY_TEXTS))
        + " END || o_orderkey AS sql, o_custkey % 2 = 0 AS is_exec, CASE o_orderkey % 8 "
        + " ".join(f"WHEN {i} THEN CASE WHEN o_custkey % 2 = 0 THEN '{e}' ELSE '{n}' END" for i, (n, e, _) in enumerate(VERDICTS))
        + " END AS motivo FROM orders)"
    ),
)
def _(s, sf):
    return search.audit_queries(I.query_log(s, sf), "fin.")


@query(
    "chat_last10",
    check(
        """SELECT conv_id, turn, role, left(text, 500) AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n <= 10"""
    ),
)
def _(s, sf):
    return search.last_messages(I.table(s, sf, "conversations"))
