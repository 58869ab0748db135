"""Whole batch runs against a table store."""

import datetime as dt
from dataclasses import replace

import pytest

from ledgerline import schemas
from ledgerline.operators import health
from ledgerline.sources import sync, tables

DAY1, DAY2 = dt.datetime(2026, 3, 2, 5), dt.datetime(2026, 3, 3, 5)


def frame(spark, entity, rows, extra=""):
    return spark.createDataFrame(rows, schemas.RAW[entity] + extra)


def landed(spark, receivables, balance=10.0):
    rec = [(i, v, s, "10/03/2026", "01/02/2026", None, f"NF {i}", "1.01.01", 7, 5, acc) for i, v, s, acc in receivables]
    return sync.Landed(
        receivables=frame(spark, "receivables", rec),
        payables=frame(spark, "payables", [(100, 30.0, "Pago", "10/03/2026", "01/02/2026", "12/03/2026", "1", "FD 1", "9.99", None, 6, None)]),
        movements=frame(spark, "movements", [((1, "20/02/2026"), 1, 0)], ", _page BIGINT, _pos INT"),
        categories=frame(spark, "categories", [("1.01.01", "1.01.01 - Venda"), ("1.02", "<Disponível>")]),
        projects=frame(spark, "projects", [(7, "Obra"), (8, "")]),
        clients=frame(spark, "clients", [(5, "", "Ana SA", "SP", "N", "S", ("01/02/2024 10:00",)), (0, "x", None, None, None, None, None)]),
        accounts=frame(spark, "accounts", [(1, "Banco", "CC", None), (24, "Fora", "CC", None)]),
        statements=spark.createDataFrame([(1, balance, 8.0)], "conta_id BIGINT, saldo DOUBLE, saldo_conciliado DOUBLE"),
        points=spark.createDataFrame(
            [(1, "Banco", dt.date(2026, 2, 28), "mensal", balance, 8.0)],
            "conta_id BIGINT, conta_nome STRING, data_referencia DATE, tipo STRING, saldo DOUBLE, saldo_conciliado DOUBLE",
        ),
        orders=frame(spark, "orders", [((1, "60", "01/03/2026"), (9.0,), [])]),
    )


def test_two_runs_and_a_failed_one(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "wh"))
    store.ensure_schema()
    first = landed(spark, [(1, 10.0, "Recebido", 1), (2, 20.0, "A Vencer", None), (3, 5.0, "Atrasado", 24), (4, 1.0, "A Vencer", 1)])
    counts = sync.run_sync(store, first, "r1", DAY1, DAY1 + dt.timedelta(minutes=2), ignored=(24,))
    assert counts["lancamentos"] == {"inserted": 4, "updated": 0, "deleted": 0, "unchanged": 0}
    rows = {r.id: r for r in store.read("lancamentos", role="exec").collect()}
    assert set(rows) == {1, 2, 4, 100}, "titles of ignored accounts are left out, titles without an account stay"
    one = rows[1]
    assert (one.data_pagamento, one.data_previsao, one.categoria_nome, one.projeto_nome, one.cliente_nome) == (
        dt.date(2026, 2, 20), dt.date(2026, 3, 10), "Venda", "Obra", "Ana SA",
    )
    paid = rows[100]
    assert (paid.data_pagamento, paid.modalidade, paid.projeto_nome, paid.categoria_nome) == (dt.date(2026, 3, 12), "FD", "Sem projeto", "9.99")
    assert [(r.conta_id, r.diferenca) for r in store.read("saldos_bancarios", role="exec").collect()] == [(1, 2.0)]
    assert store.read("historico_saldos", role="exec").first().label == "Feb/26"

    second = landed(spark, [(1, 10.0, "Recebido", 1), (2, 25.0, "A Vencer", None), (9, 3.0, "A Vencer", 1)], balance=50.0)
    counts = sync.run_sync(store, second, "r2", DAY2, DAY2 + dt.timedelta(minutes=1), ignored=(24,))
    assert counts["lancamentos"] == {"inserted": 1, "updated": 1, "deleted": 1, "unchanged": 2}
    stamps = {r.id: r.sync_timestamp for r in store.read("lancamentos", role="exec").collect()}
    assert stamps == {1: DAY1, 2: DAY2, 9: DAY2, 100: DAY1}
    assert store.read("historico_saldos", role="exec").count() == 2 and store.read("saldos_bancarios", role="exec").first().saldo == 50.0

    twice = replace(second, receivables=second.receivables.unionByName(second.receivables))
    with pytest.raises(Exception, match="duplicate id"):
        sync.run_sync(store, twice, "r3", DAY2, DAY2, ignored=(24,))
    assert store.read("lancamentos", role="exec").count() == 4 and store.read("historico_saldos", role="exec").count() == 2
    none = replace(first, receivables=first.receivables.limit(0), payables=first.payables.limit(0), accounts=first.accounts.limit(0))
    with pytest.raises(tables.EmptySource):
        sync.run_sync(store, none, "r4", DAY2, DAY2)

    log = {r.sync_id: r for r in health.latest_events(store.read("sync_log", role="exec")).collect()}
    assert {k: v.status for k, v in log.items()} == {"r1": "success", "r2": "success", "r3": "failed", "r4": "failed"}
    assert log["r2"].lancamentos_count == 2 and log["r2"].duration_seconds == 60 and "duplicate" in log["r3"].error_message
