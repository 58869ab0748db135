"""Shape of the physical plans."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from ledgerline.operators import flows, normalize, terms
from ledgerline.operators.rows import cash_rows
from ledgerline.plans import inputs as I

SF = "/root/testdata/sf0.001"
DAY = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_no_cross_join_and_no_sort_aggregate_over_rows(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a keyed sort aggregate is fine over cells (another aggregate or window below), not over scanned rows
    for block in re.findall(r"SortAggregate\(key=\[[^\]]+\], functions=\[partial.*?(?=FileScan|\Z)", text, re.S):
        assert "HashAggregate" in block or "Window" in block, block[:500]


def test_stored_ledger_prunes_and_pushes_down(spark, tmp_path):
    I.ledger(spark, SF, "category", "project", "direct", "client").write.parquet(str(tmp_path / "l"))
    stored = spark.read.parquet(str(tmp_path / "l"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(terms.aging_buckets(cash_rows(stored), I.AS_OF))
    assert "EqualTo(tipo,entrada)" in text and "LessThan(data_vencimento,2000-01-01)" in text and "EqualTo(status,ATRASADO)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "cliente_nome" not in schema and "categoria_nome" not in schema
    text = plan(flows.period_kpis(cash_rows(stored, "1999-07-01", "2000-07-01")))
    assert "Or(" in text and "GreaterThanOrEqual(data_pagamento,1999-07-01)" in text
    assert text.count("FileScan") == 1 and "numero_documento" not in text


def test_latest_and_last_n_limit_before_the_shuffle(spark):
    for name in ("latest_history", "chat_last10", "sync_latest_events"):
        text = plan(entry.queries()[name](spark, SF))
        final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
        assert final < text.index("Exchange") < partial, name


def test_questions_are_looked_up_by_equality(spark):
    from ledgerline.operators import search
    from ledgerline.plans import inputs as I

    df = search.resolve_questions(I.names(spark, "/root/testdata/sf0.001"), I.questions(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_alerts_derive_the_ledger_once(spark):
    """Months and projects share the exchange of one cell table."""
    df = entry.queries()["alerts"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def landed(spark, n):
    """Receivables and payables of n rows each, their lookups and payments; a title without an id and one without a client."""
    cols = "codigo_lancamento BIGINT, valor_documento DOUBLE, status_titulo STRING, data_vencimento STRING, data_emissao STRING, data_previsao STRING, numero_documento STRING"
    rest = ", codigo_categoria STRING, codigo_projeto BIGINT, codigo_cliente_fornecedor BIGINT, id_conta_corrente BIGINT"
    row = lambda i, *doc: (i, 10.0, "Pago", "05/01/2026", "01/01/2026", "" if i == 1 else "06/01/2026", *doc, "1.1", 7, i, 1)
    receivables = [row(i, "fd") for i in range(n)] + [(None, *row(1, "x")[1:]), (*row(2, "x")[:9], None, 1)]
    payables = [row(-i - 1, "x", "FD 1" if i % 2 else None) for i in range(n)]
    return (
        spark.createDataFrame(receivables, cols + rest),
        spark.createDataFrame(payables, cols + ", numero_documento_fiscal STRING" + rest),
        spark.createDataFrame([("1.1", "Obra", "1.1")], "codigo STRING, nome STRING, grupo STRING"),
        spark.createDataFrame([(7, "P7")], "id BIGINT, nome STRING"),
        spark.createDataFrame([(i, f"C{i}") for i in range(1, n)], "id BIGINT, nome STRING"),
        spark.createDataFrame([(2, DAY(2026, 1, 9)), (-1, DAY(2026, 1, 8))], "id BIGINT, data_movimento DATE"),
    )


def test_payments_and_clients_never_pass_the_driver(spark):
    """What the ledger moves grows no faster than its input: however short they are, payments and clients meet the titles by a shuffle."""
    df = normalize.build_ledger(*landed(spark, 4), ())
    df.collect()
    text = plan(df).partition("Initial Plan")[0]
    assert "Final Plan" in text
    joins = {key: kind for kind, key in re.findall(r"(\w+Join) \[[^\n]*?\], \[(\w+)#\d+L?\], LeftOuter", text)}
    assert joins == {"id": "SortMergeJoin", "_cli": "SortMergeJoin", "categoria_codigo": "BroadcastHashJoin", "_prj": "BroadcastHashJoin"}
    # neither names nor what other columns tell move with the titles
    moved = re.findall(r"Exchange hashpartitioning\([^\n]*\n[^\n]*Project \[([^\n]*valor#[^\n]*)\]|Exchange hashpartitioning\([^\n]*\n[^\n]*Union\n[^\n]*Project \[([^\n]*valor#[^\n]*)\]", text)
    assert len(moved) == 2
    for columns in map("".join, moved):
        assert not {"tipo", "data_previsao", "_categoria", "_projeto"} & set(re.findall(r"(\w+)#\d+L?(?:,|$)", columns)), columns


def test_ledger_after_two_shuffles(spark):
    got = normalize.build_ledger(*landed(spark, 4), ()).select(
        "id", "tipo", "data_pagamento", "data_previsao", "cliente_nome", "categoria_nome", "projeto_nome", "is_faturamento_direto"
    )
    sixth, fifth = DAY(2026, 1, 6), DAY(2026, 1, 5)
    tail = ("Obra", "P7")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [
            (0, "entrada", sixth, sixth, "", *tail, False),
            (1, "entrada", None, fifth, "C1", *tail, False),
            (2, "entrada", DAY(2026, 1, 9), sixth, "C2", *tail, False),
            (2, "entrada", DAY(2026, 1, 9), sixth, "", *tail, False),
            (3, "entrada", sixth, sixth, "C3", *tail, False),
            (None, "entrada", None, fifth, "C1", *tail, False),
            (-1, "saida", DAY(2026, 1, 8), sixth, "", *tail, False),
            (-2, "saida", sixth, sixth, "", *tail, True),
            (-3, "saida", sixth, sixth, "", *tail, False),
            (-4, "saida", sixth, sixth, "", *tail, True),
        ],
        key=repr,
    )
