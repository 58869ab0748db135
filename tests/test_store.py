"""The table store: partial merges, appends, retention, one publish a run, views, loads, backfill."""

import datetime as dt
import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline import schemas
from ledgerline.operators import budget as B
from ledgerline.operators import maintenance as M
from ledgerline.sources import sync, tables
from ledgerline.streaming import tables as streams
from test_sync import DAY1, DAY2, landed

NOW = dt.datetime(2026, 3, 1, 8)


@pytest.fixture()
def store(spark, tmp_path):
    return tables.TableStore(spark, str(tmp_path / "wh"))


def files(store, table):
    base = Path(store.root) / table
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in base.rglob("*.parquet")}


def titles(spark, rows, stamp=NOW):
    """Ledger rows from (id, amount, due date)."""
    df = spark.createDataFrame(rows, "id BIGINT, valor DOUBLE, data_vencimento DATE")
    return df.withColumns({"tipo": F.lit("saida"), "sync_timestamp": F.lit(stamp), "sync_date": F.lit(stamp.date())})


def ledger(store):
    return {r.id: (r.valor, r.data_vencimento, r.sync_timestamp) for r in store.read("lancamentos").collect()}


def apply(store, source):
    folders, counts = sync.merge_table(store, "lancamentos", source)
    if folders is not None:
        store.publish({"lancamentos": folders})
    return counts


def test_a_merge_rewrites_only_the_months_that_change(spark, store):
    rnd = random.Random(1)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(900))
    rows = [(i, float(rnd.randrange(1000)), day()) for i in range(10_680)] + [(20_000 + i, 5.0, None) for i in range(20)]
    assert apply(store, titles(spark, rows)) == {"inserted": 10_700, "updated": 0, "deleted": 0, "unchanged": 0}
    before = files(store, "lancamentos")
    # 34 updates in February 2026, 23 inserts in March, as in a usual run
    feb = [r for r in rows if r[2] and (r[2].year, r[2].month) == (2026, 2)][:34]
    more = {r[0]: (r[0], r[1] + 1, r[2]) for r in feb}
    source = [more.get(r[0], r) for r in rows] + [(30_000 + i, 1.0, dt.date(2026, 3, 1 + i)) for i in range(23)]
    assert apply(store, titles(spark, source, DAY2)) == {"inserted": 23, "updated": 34, "deleted": 0, "unchanged": 10_666}
    after = files(store, "lancamentos")
    assert {k: after[k] for k in before} == before, "no file that was there is touched"
    months = {Path(k).parent.name for k in set(after) - set(before)}
    assert months == {"mes_particao=2026-02-01", "mes_particao=2026-03-01"}
    want = {r[0]: (r[1], r[2], DAY2 if r[0] in more or r[0] >= 30_000 else NOW) for r in source}
    assert ledger(store) == want


def test_rows_that_move_or_leave_a_month(spark, store):
    jan, feb, mar = dt.date(2026, 1, 9), dt.date(2026, 2, 9), dt.date(2026, 3, 9)
    apply(store, titles(spark, [(1, 1.0, jan), (2, 2.0, feb), (3, 3.0, None), (4, 4.0, mar)]))
    assert apply(store, titles(spark, [(1, 1.0, feb), (2, 2.0, feb), (3, 3.5, jan), (4, 4.0, mar)], DAY2)) == {"inserted": 0, "updated": 2, "deleted": 0, "unchanged": 2}
    assert ledger(store) == {1: (1.0, feb, DAY2), 2: (2.0, feb, NOW), 3: (3.5, jan, DAY2), 4: (4.0, mar, NOW)}
    assert [f.partition("/")[2] for f in store.state().folders["lancamentos"]] == ["mes_particao=2026-03-01", "mes_particao=2026-01-01", "mes_particao=2026-02-01"], "no folder for rows without a date is left"
    assert apply(store, titles(spark, [(2, 2.0, feb), (4, 4.0, mar)], DAY2))["deleted"] == 2
    state = store.state().number
    assert apply(store, titles(spark, [(2, 2.0, feb), (4, 4.0, mar)], DAY2))["unchanged"] == 2 and store.state().number == state
    assert apply(store, titles(spark, []))["deleted"] == 0 and set(ledger(store)) == {2, 4}
    plan = store.read("lancamentos", since=dt.date(2026, 3, 5))
    assert [r.id for r in plan.collect()] == [4] and len(plan.inputFiles()) == 1
    assert [r.id for r in store.read("lancamentos", until=dt.date(2026, 2, 28)).collect()] == [2]


def test_partial_merge_equals_the_whole_one(spark, store):
    rnd = random.Random(7)
    day = lambda: rnd.choice([None, *[dt.date(2026, m, rnd.randrange(1, 28)) for m in range(1, 7)]])
    rows = [(i, float(rnd.randrange(9)), day()) for i in range(300)]
    apply(store, titles(spark, rows))
    for _ in range(3):
        target = store.read("lancamentos")
        rows = [(i, v if rnd.random() < 0.9 else v + 1, d if rnd.random() < 0.95 else day()) for i, v, d in rows if rnd.random() < 0.95] + [(rnd.randrange(10**6, 10**9), 1.0, day()) for _ in range(5)]
        source = titles(spark, rows, DAY2)
        want = M.merge_snapshot(target, schemas.conform(source, "lancamentos"), "id", schemas.MERGE_RULES["lancamentos"]).collect()
        apply(store, source)
        assert sorted(map(str, store.read("lancamentos").collect())) == sorted(map(str, want))


def snapshot(spark, day, value, stamp=None):
    row = (1, "Conta", dt.date(2026, 2, 28), "Feb/26", value, value, 0.0, "mensal", stamp or dt.datetime.combine(day, dt.time(5)), day)
    return spark.createDataFrame([row], schemas.TABLES["historico_saldos"].schema)


def test_history_is_appended_and_retention_reads_nothing(spark, store):
    days = [dt.date(2025, 1, 31), dt.date(2025, 2, 1), dt.date(2026, 2, 28)]
    for n, day in enumerate(days):
        before = files(store, "historico_saldos")
        store.append("historico_saldos", snapshot(spark, day, float(n)))
        after = files(store, "historico_saldos")
        assert {k: after[k] for k in before} == before and len(after) == n + 1
    # a folder that can't be read: retention goes by names
    for p in (Path(store.root) / "historico_saldos").rglob("sync_date=2025-01-31/*.parquet"):
        p.write_bytes(b"unreadable")
    kept = store.retained("historico_saldos", store.state().folders["historico_saldos"], dt.date(2026, 3, 1))
    assert [f[-10:] for f in kept] == ["2025-02-01", "2026-02-28"]
    store.publish({"historico_saldos": kept})
    assert sorted(r.saldo_atual for r in store.read("historico_saldos").collect()) == [1.0, 2.0]
    assert store.vacuum(keep=1) == ["historico_saldos/lote=1"] and len(files(store, "historico_saldos")) == 2
    assert sorted(r.saldo_atual for r in store.read("historico_saldos").collect()) == [1.0, 2.0]
    with_days = store.read("historico_saldos", since=dt.date(2026, 1, 1))
    assert [r.saldo_atual for r in with_days.collect()] == [2.0] and len(with_days.inputFiles()) == 1


def test_months_before_agrees_with_spark(spark):
    rows = [(dt.date(2023, 12, 1) + dt.timedelta(days=37 * i), n) for i in range(24) for n in (0, 1, 2, 11, 12, 13, 25)]
    df = spark.createDataFrame(rows, "d DATE, n INT").select("d", "n", F.add_months("d", -F.col("n")).alias("m"))
    assert all(r.m == tables.months_before(r.d, r.n) for r in df.collect())


def test_a_crash_between_two_tables_leaves_the_old_run(spark, store, monkeypatch):
    store.ensure_schema()
    sync.run_sync(store, landed(spark, [(1, 10.0, "Recebido", 1)]), "r1", DAY1, DAY1, ignored=(24,))
    old = {t: sorted(map(str, store.read(t, role="exec").collect())) for t in schemas.TABLES if t != "sync_log"}
    second = landed(spark, [(1, 99.0, "Recebido", 1), (2, 1.0, "A Vencer", 1)], balance=77.0)
    write = store.write_version

    def crash(table, df):
        if table == "vendas_pedidos":
            raise OSError("lost")
        return write(table, df)

    monkeypatch.setattr(store, "write_version", crash)
    with pytest.raises(OSError):
        sync.run_sync(store, second, "r2", DAY2, DAY2, ignored=(24,))
    monkeypatch.undo()
    assert {t: sorted(map(str, store.read(t, role="exec").collect())) for t in old} == old
    held = store.state()
    sync.run_sync(store, second, "r3", DAY2, DAY2, ignored=(24,))
    assert store.read("lancamentos", state=held).count() == 2 and store.read("lancamentos").count() == 3, "a reader keeps the run it began with"
    log = [(r.sync_id, r.status) for r in store.read("sync_log").orderBy("sync_id", "status").collect()]
    assert log == [("r1", "running"), ("r1", "success"), ("r2", "failed"), ("r2", "running"), ("r3", "running"), ("r3", "success")]


def test_two_runs_at_once(spark, store):
    base = store.state()
    a, _ = store.write_version("projetos", spark.createDataFrame([(1, "a", NOW)], schemas.TABLES["projetos"].schema))
    store.append("sync_log", tables.log_start(spark, "x", NOW))
    store.publish({"projetos": a}, base=base)
    b, _ = store.write_version("projetos", spark.createDataFrame([(2, "b", NOW)], schemas.TABLES["projetos"].schema))
    with pytest.raises(tables.ConcurrentRun):
        store.publish({"projetos": b}, base=base)
    assert not store._create(tables.State(store.state().number, {}, {})), "a manifest is never replaced"
    assert [r.nome for r in store.read("projetos").collect()] == ["a"] and store.read("sync_log").count() == 1


def test_small_appends_are_put_together(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "LOG_FOLDERS", 3)
    for i in range(6):
        store.append("sync_log", tables.log_start(spark, str(i), NOW))
    assert len(store.state().folders["sync_log"]) <= 3 and {r.sync_id for r in store.read("sync_log").collect()} == set("012345")


def test_views_follow_the_publish(spark, store):
    store.ensure_schema()
    store.create_sql_tables("fin_views")
    try:
        assert spark.table("fin_views.lancamentos").count() == 0
        apply(store, titles(spark, [(1, 1.0, dt.date(2026, 1, 9)), (2, 2.0, None)]))
        store.append("historico_saldos", snapshot(spark, dt.date(2026, 3, 1), 1.0))
        store.create_sql_tables("fin_views")
        assert spark.table("fin_views.lancamentos").count() == 2
        apply(store, titles(spark, [(1, 1.0, dt.date(2026, 1, 9)), (2, 5.0, None), (3, 3.0, dt.date(2026, 2, 9))]))
        store.append("historico_saldos", snapshot(spark, dt.date(2026, 3, 1), 2.0, dt.datetime(2026, 3, 1, 9)))
        store.write_version("lancamentos", titles(spark, [(9, 9.0, dt.date(2026, 1, 9))]))  # nobody published this
        store.create_sql_tables("fin_views")
        got = spark.sql("SELECT id, valor FROM fin_views.lancamentos ORDER BY id").collect()
        assert [tuple(r) for r in got] == [(1, 1.0), (2, 5.0), (3, 3.0)]
        assert spark.table("fin_views.historico_saldos").count() == 2
        assert [r.saldo_atual for r in spark.table("fin_views.v_historico_saldos").collect()] == [2.0]
        types = dict(spark.table("fin_views.lancamentos").dtypes)
        assert types == {f.name: f.dataType.simpleString() for f in schemas.TABLES["lancamentos"].schema}
        assert "document amount" in {r.comment for r in spark.sql("DESCRIBE fin_views.lancamentos").collect()}
        seen = {r.viewName for r in spark.sql("SHOW VIEWS IN fin_views").collect()}
        assert not {"folha_funcionarios", "saldos_bancarios"} & seen
        assert spark.table("fin_views_restrito.folha_funcionarios").count() == 0
        with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
            spark.table("fin_views.folha_funcionarios")
    finally:
        for name in ("fin_views", "fin_views_restrito"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_the_source_runs_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    run = landed(spark, [(i, 1.0, "Recebido", 1) for i in range(1, 41)])
    run = replace(run, receivables=run.receivables.coalesce(1).mapInPandas(counted, run.receivables.schema))
    sync.run_sync(store, run, "r1", DAY1, DAY1, ignored=(24,))
    assert seen.value == 40
    sync.run_sync(store, run, "r2", DAY2, DAY2, ignored=(24,))
    assert seen.value == 80


def test_required_columns_publish_nothing(spark, store):
    bad = spark.createDataFrame([(1, None, NOW), (2, "b", NOW)], "id BIGINT, nome STRING, sync_timestamp TIMESTAMP")
    with pytest.raises(tables.MissingValue, match="projetos: NULL in nome"):
        store.replace("projetos", bad)
    assert store.read("projetos").count() == 0


def workbook(spark, wrong):
    cells = []
    for i, (real_row, bp_row, label, _, _) in enumerate(K.STATEMENT_LINES):
        for sheet, row in ((B.ACTUAL_SHEET, real_row), (B.BUDGET_SHEET, bp_row)):
            if row is not None:
                cells += [(sheet, row, 2, "ERRADO" if i < wrong else label)] + [(sheet, row, c, str(10 * i + c)) for c in range(4, 16)]
    return spark.createDataFrame(cells, "sheet STRING, row INT, col INT, value STRING")


def test_budget_is_loaded_by_a_run(spark, store):
    lines = B.line_map(spark)
    assert sync.load_budget(store, workbook(spark, 0), lines, 2026, NOW) == (336, 0)
    want = B.budget_from_cells(workbook(spark, 0), lines, 2026).select("label", "mes", "valor_real").collect()
    assert sorted(map(str, store.read("orcamento_dre").select("label", "mes", "valor_real").collect())) == sorted(map(str, want))
    before = store.state()
    n = B.line_map_mismatches(workbook(spark, 5), lines).count()
    with pytest.raises(B.LineMapMismatch):
        sync.load_budget(store, workbook(spark, 5), lines, 2027, NOW)
    assert store.state() == before and n > 3
    assert sync.load_budget(store, workbook(spark, 1), lines, 2027, NOW)[1] == B.line_map_mismatches(workbook(spark, 1), lines).count() == 2


def test_payroll_is_loaded_by_a_run(spark, store):
    columns = ", ".join(f"{c} STRING" for c in ("nome", "departamento", "cargo", "data_admissao", "idade", "tempo_casa", "salario", "comissao", "bonus", "rescisao", "caju", "vt", "estac", "clinica", "gympass", "custo_total", "mes"))
    person = ("Ana", "Obra", "Fiscal", "2020-01-05", "30", "12", "1000", "0", "0", "0", "1", "2", "3", "4", "5", "1500")
    assert sync.load_payroll(store, spark.createDataFrame([(*person, "2026-01")], columns), "2026-03-01") == 1
    with pytest.raises(tables.MissingValue, match="mes_referencia"):
        sync.load_payroll(store, spark.createDataFrame([(*person, None)], columns), "2026-03-01")
    got = store.read("folha_funcionarios", role="exec").first()
    assert (got.nome, got.beneficios, got.mes_referencia) == ("Ana", 15.0, "2026-01")
    with pytest.raises(tables.AccessDenied):
        store.read("folha_funcionarios")


def test_a_failed_backfill_goes_on_where_it_stopped(spark, store):
    accounts = spark.createDataFrame([(i, f"Conta {i}") for i in range(6)], "conta_id BIGINT, conta_nome STRING")
    fetched = []
    failing = [True]

    def fetch(points):
        if failing[0] and len(fetched) > 20:
            raise OSError("no answer")
        fetched.extend((r.conta_id, r.data_referencia, r.tipo) for r in points.collect())
        return points.withColumns({"saldo": F.lit(2.0), "saldo_conciliado": F.lit(1.5)})

    start = dt.datetime(2026, 3, 12, 5)
    with pytest.raises(OSError):
        sync.run_backfill(store, accounts, fetch, start)
    first = len(fetched)
    assert 20 < first == store.read("historico_saldos").count()
    failing[0] = False
    done = sync.run_backfill(store, accounts, fetch, start)
    wanted = 6 * (6 + 4)  # six month ends; days 1, 6, 11 and 12
    assert first + done == len(fetched) == len(set(fetched)) == wanted == store.read("historico_saldos").count()
    assert sync.run_backfill(store, accounts, fetch, start) == 0
    assert sync.run_backfill(store, accounts, fetch, dt.datetime(2026, 3, 12, 12)) == 6 * 4, "a new run fetches the days again, not the month ends"


def test_snapshots_in_parts(spark, store, tmp_path):
    schema = "id BIGINT, nome STRING, sync_timestamp TIMESTAMP, n INT, rows INT"
    arrive = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.stream_merges(stream, store, "projetos", str(tmp_path / "cp"), "n", "rows").awaitTermination()
        return sorted(r.nome for r in store.read("projetos").collect()), store.version("projetos")

    arrive([(1, "a", NOW, 1, 2)])
    assert run() == ([], None), "half a snapshot is not published"
    arrive([(2, "b", NOW, 1, 2), (3, "z", NOW, 3, 1)])
    assert run() == (["a", "b"], 1), "snapshot 3 waits for 2"
    arrive([(2, "bb", NOW, 2, 1)])
    assert run() == (["z"], 3)
    assert not [n for n in store._names(f"{store.root}/_chegada/projetos") if n.startswith("_snap=")], "staged rows are gone"
    arrive([(4, "late", NOW, 3, 2)])
    with pytest.raises(Exception, match="after it was published"):
        run()
