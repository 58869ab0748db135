"""Edge cases of the reports that the given tables do not reach."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import balances as B
from ledgerline.operators import budget as G
from ledgerline.operators import flows, margins, normalize, overview, questions, sales, search, terms
from ledgerline.operators import payroll as R
from ledgerline.operators.rows import accrual_rows, cash_rows

DAY = dt.date
LEDGER = """id BIGINT, tipo STRING, valor DOUBLE, status STRING, data_emissao DATE, data_vencimento DATE, data_previsao DATE,
 data_pagamento DATE, categoria_codigo STRING, categoria_nome STRING, projeto_id BIGINT, projeto_nome STRING,
 cliente_nome STRING, is_faturamento_direto BOOLEAN, numero_documento STRING"""


def title(tipo="entrada", valor=100.0, status="RECEBIDO", emi=DAY(2026, 1, 1), venc=DAY(2026, 1, 31), prev=None, pag=None,
          cat="1.01.01", nome="Venda", proj=1, pnome="Obra", cli="Ana", fd=False, doc="1", id=1):
    return (id, tipo, valor, status, emi, venc, prev or venc, pag, cat, nome, proj, pnome, cli, fd, doc)


@pytest.fixture()
def ledger(spark):
    return lambda *rows: spark.createDataFrame(list(rows), LEDGER)


def test_days_clip(ledger):
    emi = DAY(2026, 1, 1)
    pays = [DAY(2025, 12, 31), DAY(2026, 1, 1), DAY(2026, 5, 1), DAY(2026, 5, 2)]  # -1, 0, 120, 121 days
    rows = [title(valor=10.0, emi=emi, pag=p) for p in pays]
    got = {r.mes: r.pmr for r in terms.collection_days_by_month(ledger(*rows), "2026-12-01").collect()}
    assert got == {"2025-12": None, "2026-01": 0.0, "2026-05": 120.0}


def test_days_period_and_status(ledger):
    rows = [
        title(pag=DAY(2026, 2, 1)),
        title(pag=DAY(2026, 3, 1)),  # the as-of day itself is out
        title(pag=DAY(2025, 2, 28)),  # older than twelve months
        title(pag=DAY(2026, 2, 5), status="LIQUIDADO"),
        title(pag=DAY(2026, 2, 7), valor=0.0, tipo="saida", status="PAGO"),
    ]
    got = terms.collection_days_by_month(ledger(*rows), "2026-03-01").collect()
    assert [(r.mes, r.pmr, r.pmp) for r in got] == [("2026-02", 31.0, None)]


def test_contractual_without_due_date(ledger):
    rows = [title(pag=DAY(2026, 1, 11), venc=None, prev=DAY(2026, 1, 5))]
    got = terms.collection_days_contractual(cash_rows(ledger(*rows))).first()
    assert (got.dias_real, got.dias_contratual, got.diferenca, got.qtd) == (10, 10, 0, 1)


def test_aging_edges(ledger):
    today = DAY(2026, 4, 1)
    rows = [title(status="ATRASADO", venc=today - dt.timedelta(days=n), valor=float(n)) for n in (0, 1, 30, 31, 60, 61, 90, 91, 400)]
    got = {r.faixa: (r.valor, r.qtd) for r in terms.aging_buckets(cash_rows(ledger(*rows)), today).collect()}
    assert got == {"1-30 dias": (31.0, 2), "31-60 dias": (91.0, 2), "61-90 dias": (151.0, 2), "90+ dias": (491.0, 2)}


def test_nothing_overdue(ledger):
    k = terms.delinquency(cash_rows(ledger(title(tipo="saida"))), "2026-04-01").first()
    assert (k.total_atrasado, k.titulos, k.pct, k.faixa) == (0.0, 0, 0.0, "verde")


def test_accrual_leaves_out_overdue_and_undated(ledger):
    rows = [title(), title(status="ATRASADO"), title(venc=None, prev=DAY(2026, 1, 5)), title(status=None)]
    assert accrual_rows(ledger(*rows)).count() == 2
    assert cash_rows(ledger(*rows), "2026-01-31", "2026-01-31").count() == 3


def test_cancelled_counts_as_realised(ledger):
    k = flows.period_kpis(cash_rows(ledger(title(status="CANCELADO"), title(status="A VENCER", valor=7.0)))).first()
    assert (k.recebido, k.a_receber, k.a_vencer_receber) == (100.0, 7.0, 7.0)


def test_no_inflow_means_zero_margin(ledger):
    k = flows.period_kpis(cash_rows(ledger(title(tipo="saida")))).first()
    assert k.margem_pct == 0.0 and k.resultado == -100.0


def test_rollup_keeps_uncategorised(spark, ledger):
    cats = spark.createDataFrame([("1.01", "Receitas")], "codigo STRING, nome STRING")
    rows = [title(), title(cat=None, nome=None, valor=5.0), title(tipo="saida", cat="2.01.01", nome="Obra", valor=30.0, status="A VENCER")]
    got = {(r.nivel, r.grupo, r.categoria): (r.nome, r.realizado, r.a_realizar, r.total) for r in flows.cash_flow_table(cash_rows(ledger(*rows)), cats).collect()}
    assert got[(0, "N/I", "N/I")] == ("N/I", 5.0, 0.0, 5.0)
    assert got[(1, "1.01", None)] == ("Receitas", 100.0, 0.0, 100.0)
    assert got[(2, None, None)] == ("TOTAL", 105.0, -30.0, 75.0)


def test_running_result_and_variation(spark):
    m = spark.createDataFrame([("2026-01", 0.0, 5.0), ("2026-02", 10.0, 1.0), ("2026-04", 15.0, 0.0)], "mes STRING, entrada DOUBLE, saida DOUBLE")
    m = m.withColumn("resultado", F.col("entrada") - F.col("saida"))
    assert [r.acumulado for r in flows.running_result(m).orderBy("mes").collect()] == [-5.0, 4.0, 19.0]
    assert [r.variacao_pct for r in flows.month_over_month(m).orderBy("mes").collect()] == [None, None, 50.0]


def test_project_margin_of_pure_cost(spark):
    p = spark.createDataFrame([(1, "A", 0.0, 5.0), (2, "B", 10.0, 5.0), (3, "C", 0.0, 0.0)], "projeto_id INT, projeto_nome STRING, entrada DOUBLE, saida DOUBLE")
    assert {r.projeto_nome: r.margem_pct for r in margins.project_detail(p).collect()} == {"A": -100.0, "B": 50.0, "C": 0.0}


def test_project_points(spark):
    p = spark.createDataFrame(
        [(1, "A", 140000.0, 0.0), (2, "SK B", 280000.0, 0.0), (3, "C", 69999.0, 0.0), (4, "D", 70000.0, 77000.0)],
        "projeto_id INT, projeto_nome STRING, entrada DOUBLE, saida DOUBLE",
    )
    got = {r.projeto_id: (r.margem_pct, r.faixa, r.raio) for r in margins.project_points(p).collect()}
    assert got == {1: (100.0, "verde", 12), 4: (-10.0, "vermelho", 9)}


def overview_row(spark, ledger, rows, history=(), saldo=1000.0, as_of="2026-03-10"):
    balances = spark.createDataFrame([(1, saldo)], "conta_id INT, saldo DOUBLE")
    hist = spark.createDataFrame(list(history), "conta_nome STRING, data_referencia DATE, tipo STRING, saldo_atual DOUBLE")
    return overview.overview_values(overview.regime_months(ledger(*rows)), balances, hist, as_of)


def test_overview_current_month_rules(spark, ledger):
    feb = title(pag=DAY(2026, 2, 5), valor=100.0)
    may_cost = title(tipo="saida", status="PAGO", pag=DAY(2026, 5, 5), valor=50.0)
    got = overview_row(spark, ledger, [feb, may_cost]).first()
    assert got.mes_atual == "2026-02", "without rows in the as-of month, the last month with inflow"
    assert got.receita_mes_ant == 0.0 and got.var_receita_pct is None
    assert overview_row(spark, ledger, [may_cost]).first().mes_atual == "2026-05"
    got = overview_row(spark, ledger, [feb], [("a", DAY(2026, 1, 31), "mensal", 500.0), ("a", DAY(2026, 2, 28), "mensal", 800.0)]).first()
    assert got.meses_caixa == 99.0 and got.saldo_anterior == 500.0 and got.var_saldo_pct == 100.0


def test_alert_thresholds(spark, ledger):
    rows = [title(pag=DAY(2026, 3, 5), valor=100.0), title(status="ATRASADO", valor=12.0, venc=DAY(2026, 2, 10)),
            title(tipo="saida", status="PAGO", pag=DAY(2026, 3, 6), valor=900.0)]
    values = overview_row(spark, ledger, rows)
    none = spark.createDataFrame([], "projeto_id INT, entrada DOUBLE, saida DOUBLE")
    budget = spark.createDataFrame([("Receita Bruta", 121.0, 110.0, True)], "label STRING, valor_real DOUBLE, valor_bp DOUBLE, mes_com_real BOOLEAN")
    got = [r.regra for r in overview.alerts(values, none, budget).collect()]
    assert got == ["inadimplencia", "caixa"], "ten percent above budget is not yet an alert"
    more = spark.createDataFrame([(1, 50001.0, 60000.0)], "projeto_id INT, entrada DOUBLE, saida DOUBLE")
    assert [r.regra for r in overview.alerts(values, more, budget, k=3).collect()] == ["inadimplencia", "caixa", "projetos_negativos"]


def test_balance_month_fallback(spark):
    h = spark.createDataFrame([("a", DAY(2026, 2, 28), "mensal", 5.0), ("b", DAY(2026, 2, 28), "mensal", 0.0), ("a", DAY(2026, 3, 31), "mensal", 9.0)],
                              "conta_nome STRING, data_referencia DATE, tipo STRING, saldo_atual DOUBLE")
    pick = lambda d: [(r.mes, r.saldo) for r in B.month_end_balances(h, d).collect()]
    assert pick("2026-03-15") == [("2026-03", 9.0)]
    assert pick("2026-02-10") == [("2026-02", 5.0)]
    assert pick("2020-01-01") == [("2026-03", 9.0)]


def test_sales_without_orders(spark):
    items = spark.createDataFrame([], "pedido_id BIGINT, valor_mercadorias DOUBLE, etapa STRING, data_previsao DATE")
    assert tuple(sales.sales_summary(items).first()) == (0.0, 0, 0.0)


def test_order_items_keep_empty_orders(spark):
    schema = """cabecalho STRUCT<codigo_pedido: BIGINT, etapa: STRING, data_previsao: STRING>, total_pedido STRUCT<valor_mercadorias: DOUBLE>,
     det ARRAY<STRUCT<produto: STRUCT<descricao: STRING, quantidade: DOUBLE, valor_total: DOUBLE>>>"""
    rows = [((1, "10", "01/02/2026"), (5.0,), []), ((2, "60", ""), (None,), None), ((3, "77", None), (9.0,), [((None, None, 4.0),), (("x", 2.0, None),)])]
    got = normalize.order_items(spark.createDataFrame(rows, schema)).orderBy("pedido_id", "produto_descricao").collect()
    assert [tuple(r) for r in got] == [
        (1, 5.0, "Em Aberto", DAY(2026, 2, 1), None, None, None),
        (2, 0.0, "Faturado", None, None, None, None),
        (3, 9.0, "77", None, "Sem nome", 0.0, 4.0),
        (3, 9.0, "77", None, "x", 2.0, 0.0),
    ]


def test_last_movement_wins(spark):
    rows = [((1, "01/01/2026"), 1, 0), ((1, "05/01/2026"), 2, 0), ((1, "abc"), 3, 0), ((0, "01/01/2026"), 1, 1), ((2, ""), 1, 2), ((1, "02/01/2026"), 1, 9)]
    df = spark.createDataFrame(rows, "detalhes STRUCT<nCodTitulo: BIGINT, dDtPagamento: STRING>, _page BIGINT, _pos INT")
    assert [tuple(r) for r in normalize.payment_dates(df).collect()] == [(1, DAY(2026, 1, 5))]


def test_name_resolver(spark):
    names = spark.createDataFrame(
        [("Nex | One 1513", "projeto"), ("Nex One 99", "projeto"), ("Kairos", "cliente"), ("Kairos", "projeto"), ("One Ltda", "cliente")], "nome STRING, tipo STRING"
    )
    ask = lambda q: [(r.nome, r.tipo) for r in search.resolve_names(names, q).collect()]
    assert ask("quanto gastei nex") == []
    assert ask("nex one 1513") == [("Nex | One 1513", "projeto")]
    assert ask("kairos") == [("Kairos", "projeto")], "one entry per name, projects first"
    assert ask("kairos foo 1513") == [("Kairos", "projeto"), ("Nex | One 1513", "projeto")], "falls back to the long words"
    assert ask("qual o total") == []


def test_digest_and_week(spark, ledger):
    rows = [title(status="A VENCER", prev=DAY(2026, 3, 9)), title(status="A VENCER", prev=DAY(2026, 3, 15)), title(status="A VENCER", prev=DAY(2026, 3, 16))]
    got = questions.due_this_week(ledger(*rows), "2026-03-11").first()
    assert (got.tipo, got.total, got.qtd) == ("entrada", 200.0, 2)


# --- budget ------------------------------------------------------------------


def cells(spark, rows):
    return spark.createDataFrame(rows, "sheet STRING, row INT, col INT, value STRING")


def test_line_map_check(spark):
    lines = G.line_map(spark)
    good = [(sheet, row, 2, f" {label.upper()} (R$)") for real, bp, label, *_ in __import__("ledgerline.constants", fromlist=["x"]).STATEMENT_LINES
            for sheet, row in (("Realizado", real), ("BP", bp)) if row]
    assert G.check_line_map(cells(spark, good), lines) == 0
    bad = cells(spark, [(s, r, c, "ERRADO") for s, r, c, _ in good])
    assert G.line_map_mismatches(bad, lines).count() == len(good)
    with pytest.raises(G.LineMapMismatch):
        G.check_line_map(bad, lines)
    third = cells(spark, [("BP", 26, 2, None), ("BP", 26, 3, "Outra"), ("BP", 35, 2, ""), ("Realizado", 35, 3, "impostos")])
    assert G.check_line_map(third, lines) == 1


def test_budget_cells(spark):
    df = cells(spark, [("Realizado", 26, 4, "10.006"), ("BP", 26, 4, "8"), ("Realizado", 26, 5, "n/d"), ("BP", 29, 15, "3"), ("BP", 26, 16, "99")])
    got = {(r.label, r.mes): r for r in G.budget_from_cells(df, G.line_map(spark), 2026).collect()}
    assert len(got) == 28 * 12
    jan = got[("Receita Bruta", "2026-01")]
    assert (jan.valor_real, jan.valor_bp, jan.variacao_pct, jan.mes_com_real) == (10.01, 8.0, 25.12, True)
    assert got[("Receita Bruta", "2026-02")].mes_com_real is False and got[("BK", "2026-12")].valor_bp == 3.0
    assert got[("SK", "2026-01")].mes_com_real is True and got[("SK", "2026-01")].variacao_pct is None


# --- payroll -----------------------------------------------------------------


def month_cells(values):
    return [(m, k, v) for m, row in values.items() for k, v in row.items()]


def fill_zero_model(data):
    out, last = {}, None
    for m in sorted(data):
        if sum(data[m].values()) != 0:
            last = m
        out[m] = data[last] if last and sum(data[m].values()) == 0 else data[m]
    return out


def fill_missing_model(data, months):
    out, last = {}, None
    for m in sorted(months):
        last = m if m in data else last
        if last:
            out[m] = data[last]
    return out


MONTHS = [f"2026-{i:02d}" for i in range(1, 9)]
grid = st.dictionaries(st.sampled_from(MONTHS), st.dictionaries(st.sampled_from("abc"), st.sampled_from([0.0, 1.0, 2.5]), min_size=1), min_size=1)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(grid)
def test_gap_filling_against_model(spark, data):
    df = spark.createDataFrame(month_cells(data), "mes STRING, k STRING, valor DOUBLE")
    as_set = lambda rows: sorted((r.mes, r.k, r.valor) for r in rows)
    assert as_set(R.fill_zero_months(df).collect()) == sorted(month_cells(fill_zero_model(data)))
    cal = spark.createDataFrame([(m,) for m in MONTHS], "mes STRING")
    assert as_set(R.fill_missing_months(df, cal).collect()) == sorted(month_cells(fill_missing_model(data, MONTHS)))


def test_month_sheet_from_cells(spark):
    rows = [("Março 26", 4, 2, "Ana"), ("Março 26", 4, 9, "1000"), ("Março 26", 4, 27, "secret"), ("Março 26", 3, 2, "header"), ("Notes", 4, 2, "x")]
    got = R.month_sheet(cells(spark, rows), {"Março 26": "2026-03"}).collect()
    assert len(got) == 1 and got[0].mes == "2026-03" and got[0].nome == "Ana" and "secret" not in str(got)
    clean = R.payroll_rows(R.month_sheet(cells(spark, rows), {"Março 26": "2026-03"}), "2026-03-15").first()
    assert (clean.nome, clean.salario, clean.status, clean.idade) == ("Ana", 1000.0, "andamento", None)


def test_salary_bands_use_last_month_with_data(spark):
    schema = "mes STRING, cargo STRING, departamento STRING, salario STRING"
    df = spark.createDataFrame([("2026-01", "Analista", "A", "10"), ("2026-02", "Gerente", None, "30"), ("2026-02", "Gerente", "B", "50"), ("2026-03", "Gerente", "B", "0")], schema)
    got = {(r.dimensao, r.nome): (r.minimo, r.media, r.maximo, r.qtd) for r in R.salary_bands(df).collect()}
    assert got == {("cargo", "Gerente"): (30.0, 40.0, 50.0, 2), ("nivel", "Gerência"): (30.0, 40.0, 50.0, 2), ("area", "B"): (50.0, 50.0, 50.0, 1)}


def test_scenarios(spark):
    cost = spark.createDataFrame([(m, "total", v) for m, v in zip(MONTHS[:4], (100000.0, 120000.0, 1.0, 2.0))], "mes STRING, rubrica STRING, valor DOUBLE")
    got = {r.mes: (r.base, r.expansao, r.reducao) for r in R.cost_scenarios(cost, "2026-02-10").collect()}
    assert got["2026-01"] == (110000, 126000, 100000)
    assert got["2026-03"] == (110000, 126000, 117000) and got["2026-04"] == (110000, 126000, 87000)
    assert got["ANO"] == (1320000, 1512000, 1074000)


def test_resolver_of_many_questions_equals_the_single_one(spark):
    names = [("Nex One 1513", "projeto"), ("NEX TWO", "projeto"), ("Ana SA", "cliente"), ("nex one", "cliente"), ("Nex One 1513", "cliente"), ("R1", "projeto"), (None, "projeto")]
    names += [(f"Obra {i:02d} Brooklin", "projeto") for i in range(14)] + [(f"brooklin {i}", "cliente") for i in range(12)]
    names = spark.createDataFrame(names, "nome STRING, tipo STRING")
    asked = ["nex one 1513", "Quanto gastei no projeto nex one?", "hub brooklin 1305", "brooklin", "xyz nada", "", None, "quanto", "a#1x ana", "r$1 r$1$", "zzz nex"]
    df = spark.createDataFrame(list(enumerate(asked)) + [(99, "brooklin")], "pergunta INT, texto STRING")
    got = {}
    for r in search.resolve_questions(names, df).orderBy("pergunta", "posicao").collect():
        got.setdefault(r.pergunta, []).append((r.nome, r.tipo))
    for i, q in enumerate(asked):
        want = [(r.nome, r.tipo) for r in search.resolve_names(names.filter("nome is not null"), q or "").collect()]
        assert got.get(i, []) == want, q
    assert got[99] == got[3] and len(got[3]) == 10


def test_balances_asof(spark):
    import datetime as dt

    day = dt.date
    rows = [(1, "a", day(2026, 1, 31), "mensal", 1.0), (1, "a", day(2026, 3, 31), "mensal", 3.0), (2, "b", day(2026, 2, 28), "mensal", 7.0), (1, "a", day(2026, 2, 5), "diario", 99.0)]
    history = spark.createDataFrame(rows, "conta_id BIGINT, conta_nome STRING, data_referencia DATE, tipo STRING, saldo_atual DOUBLE")
    ends = spark.createDataFrame([(day(2025, 12, 31),), (day(2026, 2, 28),), (day(2026, 4, 30),)], "fim DATE")
    from ledgerline.operators import balances

    got = {(r.conta_id, r.fim.month): (r.data_referencia, r.saldo) for r in balances.balances_asof(history, ends).collect()}
    assert got == {
        (1, 12): (day(2026, 3, 31), 3.0), (1, 2): (day(2026, 1, 31), 1.0), (1, 4): (day(2026, 3, 31), 3.0),
        (2, 12): (day(2026, 2, 28), 7.0), (2, 2): (day(2026, 2, 28), 7.0), (2, 4): (day(2026, 2, 28), 7.0),
    }
