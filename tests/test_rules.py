"""Scalar rules, case by case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import money as M
from ledgerline.functions import payroll as P
from ledgerline.functions import text as T
from ledgerline.operators import search

DAY = dt.date


def ask(spark, schema, rows, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i INT, {schema}")
    return [r[0] for r in df.orderBy("_i").select(expr).collect()]


def test_parse_date(spark):
    cases = ["15/03/2026", "01/01/2026", "31/12/2025", "5/3/2026", "", None, "2026-03-15", "03/15/2026", "abc"]
    want = [DAY(2026, 3, 15), DAY(2026, 1, 1), DAY(2025, 12, 31), DAY(2026, 3, 5)] + [None] * 5
    assert ask(spark, "c STRING", [(c,) for c in cases], D.parse_br("c")) == want


def test_parse_date_prefix(spark):
    rows = [("15/03/2026 10:20",), ("15/03/2026",), (None,), ("",)]
    assert ask(spark, "c STRING", rows, D.parse_br_prefix("c")) == [DAY(2026, 3, 15)] * 2 + [None] * 2


def test_strip_prefix(spark):
    cases = {
        "4.01.010 - Marcenaria": "Marcenaria",
        "2.01.03 - Mão de Obra": "Mão de Obra",
        "Marcenaria": "Marcenaria",
        "": "",
        "1.01 - ": "",
        "1.01 - <Disponível>": "<Disponível>",
        "10 - Ten": "10 - Ten",
    }
    assert ask(spark, "c STRING", [(c,) for c in cases], T.strip_code_prefix("c")) == list(cases.values())


def test_category_group(spark):
    rows = [("4.01.010",), ("2.01",), ("1",), ("",), (None,)]
    assert ask(spark, "c STRING", rows, T.category_group("c")) == ["4.01", "2.01", "1", None, None]


def test_status(spark):
    rows = [("Pago",), ("recebido",), ("A Vencer",), ("ATRASADO",), ("",), (None,)]
    assert ask(spark, "c STRING", rows, T.status_code("c")) == ["PAGO", "RECEBIDO", "A VENCER", "ATRASADO", "", ""]


def test_direct_outflow(spark):
    rows = [
        ("FD NF 77.182", None, True),
        ("000077971/1", None, False),
        ("fd 123", "", True),
        ("", "Fd NFS 9", True),
        (None, "abc FD xyz", True),
        (None, None, False),
        ("", "", False),
    ]
    got = ask(spark, "doc STRING, nf STRING, want BOOLEAN", rows, T.is_direct_outflow("doc", "nf"))
    assert got == [r[2] for r in rows]


def test_direct_inflow(spark):
    rows = [("Faturamento Direto",), ("FATURAMENTO DIRETO - X",), ("Marcenaria",), ("",), (None,)]
    assert ask(spark, "c STRING", rows, T.is_direct_inflow("c")) == [True, True, False, False, False]


def test_modality_falls_back_to_flag(spark):
    rows = [("FD", False), ("SK", True), (None, True), ("", False), (None, None)]
    got = ask(spark, "m STRING, f BOOLEAN", rows, T.modality_or_flag("m", "f"))
    assert got == ["FD", "SK", "FD", "SK", "SK"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [("12.5",), ("",), (None,), ("abc",), ("-3",)]
        assert ask(spark, "c STRING", rows, M.to_number("c")) == [12.5, 0.0, 0.0, 0.0, -3.0]
        assert ask(spark, "c STRING", rows, F.coalesce(M.is_reject("c"), F.lit(False))) == [False, False, False, True, False]
        assert ask(spark, "a DOUBLE, b DOUBLE", [(1.0, 0.0), (1.0, 4.0), (None, 2.0)], M.ratio(F.col("a"), F.col("b"))) == [None, 0.25, None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cents_round_half_away(spark):
    rows = [(0.125,), (-0.125,), (10.5,), (None,), (0.0,), (1234567.89,)]
    assert ask(spark, "v DOUBLE", rows, M.cents("v")) == [13, -13, 1050, None, 0, 123456789]


def test_money_sum_is_exact(spark):
    df = spark.range(0, 300000).select((F.lit(0.1)).alias("v"))
    assert df.agg(M.money_sum("v").alias("s")).first()[0] == 30000.0
    assert df.agg(M.money_sum("v", F.col("v") > 1).alias("s")).first()[0] == 0.0


def test_cash_date(spark):
    pay, prev, due = DAY(2026, 3, 20), DAY(2026, 3, 16), DAY(2026, 3, 14)
    rows = [
        ("PAGO", pay, prev, due, pay),
        ("RECEBIDO", pay, prev, due, pay),
        ("LIQUIDADO", pay, prev, due, pay),
        ("A VENCER", None, prev, due, prev),
        ("A VENCER", None, None, due, due),
        ("CANCELADO", pay, prev, due, prev),
        ("PAGO", None, prev, due, prev),
        ("ATRASADO", None, None, None, None),
        (None, pay, prev, due, prev),
    ]
    schema = "status STRING, data_pagamento DATE, data_previsao DATE, data_vencimento DATE, want DATE"
    assert ask(spark, schema, rows, D.cash_date()) == [r[4] for r in rows]


def test_date_text(spark):
    rows = [(DAY(2026, 3, 15),), (None,)]
    assert ask(spark, "d DATE", rows, D.show_br("d")) == ["15/03/2026", ""]
    assert ask(spark, "d DATE", rows, D.show_iso("d")) == ["2026-03-15", ""]
    assert ask(spark, "m STRING", [("2026-03",)], D.month_label("m")) == ["Mar/26"]


def test_next_workday(spark):
    rows = [(DAY(2026, 3, 13),), (DAY(2026, 3, 14),), (DAY(2026, 3, 15),)]
    assert ask(spark, "d DATE", rows, D.next_workday("d")) == [DAY(2026, 3, 13), DAY(2026, 3, 16), DAY(2026, 3, 16)]


def test_account_filter(spark):
    rows = [(1,), (24,), (None,)]
    assert ask(spark, "a BIGINT", rows, T.keep_account("a", (24,))) == [True, False, True]
    assert ask(spark, "a BIGINT", rows, T.keep_account("a", (24,), keep_null=False)) == [True, False, False]


def test_maps(spark):
    assert ask(spark, "c STRING", [("10",), ("60",), ("99",), (None,)], T.order_stage("c")) == ["Em Aberto", "Faturado", "99", ""]
    assert ask(spark, "c STRING", [("CC",), ("XX",)], T.account_type("c")) == ["Conta Corrente", "XX"]


def test_flags_and_defaults(spark):
    assert ask(spark, "c STRING", [("S",), ("N",), (None,)], T.flag("c")) == [True, False, False]
    assert ask(spark, "c STRING", [("x",), ("",), (None,)], T.or_default("c", K.NOT_INFORMED)) == ["x", "N/I", "N/I"]


def test_variation(spark):
    rows = [(110.0, 100.0), (90.0, -100.0), (5.0, 0.0)]
    assert ask(spark, "r DOUBLE, b DOUBLE", rows, M.variation_pct("r", "b")) == [10.0, 190.0, None]


def test_display(spark):
    rows = [(1234.5,), (-0.5,), (1234567.0,)]
    assert ask(spark, "v DOUBLE", rows, M.display_brl("v")) == ["R$ 1.234,50", "-R$ 0,50", "R$ 1.234.567,00"]
    assert ask(spark, "v DOUBLE", [(2.5e6,), (-35400.0,), (12.0,)], M.display_short("v")) == ["R$ 2.5M", "-R$ 35K", "R$ 12,00"]


def test_month_status(spark):
    rows = [("2026-02",), ("2026-03",), ("2026-04",)]
    assert ask(spark, "m STRING", rows, D.month_status("m", "2026-03-15")) == ["realizado", "andamento", "projecao"]


def test_seniority(spark):
    cases = {
        "Gerente Comercial": "Gerência",
        "COORDENADOR de Obras": "Coordenação",
        "Orçamentista Jr": "Analista/Especialista",
        "Auxiliar": "Assistente/Operacional",
        "Sócio": "Analista/Especialista",
        "Assistente do Gerente": "Gerência",
    }
    assert ask(spark, "c STRING", [(c,) for c in cases], P.seniority("c")) == list(cases.values())


def test_subtotal_rows(spark):
    rows = [
        ("COMERCIAL", "COMERCIAL", None, True),
        ("Comercial ", "comercial", "", True),
        ("ARQUITETURA", None, " ", True),
        ("ANA LIMA", "Obras", None, False),
        ("Ana", "Obras", None, False),
        ("COMERCIAL", "COMERCIAL", "Analista", False),
    ]
    got = ask(spark, "n STRING, d STRING, r STRING, want BOOLEAN", rows, P.is_subtotal_row("n", "d", "r"))
    assert got == [r[3] for r in rows]


def test_accent_search(spark):
    rows = [("Mão de Obra",), ("MAO DE OBRA extra",), ("Aluguel",)]
    assert ask(spark, "c STRING", rows, T.contains_folded("c", "mao de obra")) == [True, True, False]


def test_tokens(spark):
    q = "Quanto gastei no projeto Nex-One 1513?"
    assert T.question_tokens(q) == ["gastei", "nexone", "1513"]
    assert ask(spark, "q STRING", [(q,), ("",)], T.tokens("q")) == [["gastei", "nexone", "1513"], []]


def test_all_words_in_any_order(spark):
    rows = [("One | Nex 1513",), ("nex one",), (None,)]
    assert ask(spark, "c STRING", rows, F.coalesce(T.contains_all("c", ["nex", "one", "1513"]), F.lit(False))) == [True, False, False]


def test_name_exclusion(spark):
    rows = [("Obra SK 12",), ("Skyline",), ("sk",)]
    assert ask(spark, "c STRING", rows, T.name_matches("c", r"\bsk\b")) == [True, False, True]


def test_query_audit(spark):
    rows = [
        ("SELECT * FROM fin.lancamentos", False, True, True),
        ("select 1 from fin.x", False, True, True),
        ("INSERT INTO fin.x VALUES (1)", False, False, False),
        ("DELETE FROM fin.x", False, False, False),
        ("SELECT 1 FROM fin.x ; DROP TABLE fin.x", False, False, False),
        ("SELECT 1 FROM fin.x ;DROP TABLE fin.x", False, True, False),
        ("UPDATE fin.x SET a = 1", False, False, False),
        ("SELECT * FROM other.x", False, False, False),
        ("SELECT * FROM fin.folha_funcionarios", False, False, False),
        ("SELECT * FROM fin.folha_funcionarios", True, True, True),
        (None, False, False, False),
    ]
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i INT, sql STRING, is_exec BOOLEAN")
    got = search.audit_queries(df, "fin.").orderBy("i").collect()
    # a banned word that touches punctuation passes the token rule and fails the strict one
    assert [(r.permitido, r.estrito) for r in got] == [(r[2], r[3]) for r in rows]


def test_periods(spark):
    df = spark.createDataFrame([(DAY(2026, 5, 20),)], "d DATE")
    got = {r.preset: (r.de, r.ate) for r in df.select(F.explode(D.period_columns("d")).alias("p")).select("p.*").collect()}
    assert got["mes"] == (DAY(2026, 5, 1), DAY(2026, 5, 31))
    assert got["tri"] == (DAY(2026, 4, 1), DAY(2026, 6, 30))
    assert got["ano"] == (DAY(2026, 1, 1), DAY(2026, 12, 31))
    assert got["ytd"] == (DAY(2026, 1, 1), DAY(2026, 5, 20))
    assert got["padrao"] == (DAY(2025, 11, 1), DAY(2026, 11, 1))


def test_line_map_is_complete():
    lines = K.STATEMENT_LINES
    assert len(lines) == 28 and lines[0][2] == "Receita Bruta" and lines[-1][2] == "Lucro Líquido"
    assert all(len(x) == 5 and x[4] in (0, 1, 2) for x in lines)
