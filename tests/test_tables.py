"""Stored tables, run log, access, landed pages, document, streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import health, maintenance
from ledgerline.plans import inputs as I
from ledgerline.sources import document, raw, tables
from ledgerline.streaming import tables as streams

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2026, 3, 1, 8)


@pytest.fixture()
def store(spark, tmp_path):
    return tables.TableStore(spark, str(tmp_path / "wh"))


def projects(spark, rows):
    return spark.createDataFrame([(i, n, NOW) for i, n in rows], schemas.TABLES["projetos"].schema)


def test_replace_and_read(spark, store):
    assert store.replace("projetos", projects(spark, [(1, "a"), (2, "b")])) == 2
    assert store.replace("projetos", projects(spark, [(3, "c")])) == 1
    assert [r.id for r in store.read("projetos", role="exec").collect()] == [3]


def test_empty_replace_keeps_the_table(spark, store):
    store.replace("projetos", projects(spark, [(1, "a")]))
    assert store.replace("projetos", schemas.empty(spark, "projetos")) == 0
    assert store.read("projetos", role="exec").count() == 1


def test_unpublished_version_is_invisible(spark, store):
    store.replace("projetos", projects(spark, [(1, "a")]))
    v, n = store.write_version("projetos", projects(spark, [(9, "z")]))
    assert n == 1 and [r.id for r in store.read("projetos", role="exec").collect()] == [1]
    store.publish({"projetos": v})
    assert [r.id for r in store.read("projetos", role="exec").collect()] == [9]


def test_append_history_and_partitions(spark, store):
    def snap(day, value):
        row = (1, "Conta", dt.date(2026, 2, 28), "Feb/26", value, value, 0.0, "mensal", dt.datetime(2026, 3, day), dt.date(2026, 3, day))
        return spark.createDataFrame([row], schemas.TABLES["historico_saldos"].schema)

    assert store.append("historico_saldos", snap(1, 10.0)) == 1
    assert store.append("historico_saldos", snap(2, 20.0)) == 1
    history = store.read("historico_saldos", role="exec")
    assert history.count() == 2
    assert [r.saldo_atual for r in maintenance.latest_history(history).collect()] == [20.0]
    plan = tables.within_retention(history, "2027-04-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sync_date" in plan


def test_ensure_schema(spark, store):
    assert set(store.ensure_schema()) == set(schemas.TABLES)
    assert store.ensure_schema() == []
    assert store.read("lancamentos", role="exec").schema.names == schemas.TABLES["lancamentos"].columns
    assert len(schemas.TABLES["lancamentos"].columns) == 21


def test_sql_tables(spark, store, tmp_path):
    store.replace("projetos", projects(spark, [(1, "a")]))
    store.create_sql_tables("fin_test")
    try:
        assert spark.table("fin_test.projetos").count() == 1
    finally:
        spark.sql("DROP DATABASE fin_test CASCADE")
        spark.sql("DROP DATABASE fin_test_restrito CASCADE")


def test_null_violations(spark):
    df = spark.createDataFrame([(1, None, NOW), (2, "b", NOW)], "id BIGINT, nome STRING, sync_timestamp TIMESTAMP")
    got = {r.coluna: r.nulos for r in schemas.null_violations(df, "projetos").collect()}
    assert got == {"id": 0, "nome": 1, "sync_timestamp": 0}


def test_guard(spark):
    empty, some = schemas.empty(spark, "projetos"), projects(spark, [(1, "a")])
    tables.nonempty_guard(empty, some)
    tables.nonempty_guard(some, empty)
    with pytest.raises(tables.EmptySource):
        tables.nonempty_guard(empty, empty)


def test_access(spark, store):
    store.ensure_schema()
    for t in ("folha_funcionarios", "saldos_bancarios"):
        with pytest.raises(tables.AccessDenied):
            store.read(t, role="user")
        assert store.read(t, role="exec").count() == 0
    assert store.read("clientes", role="user").count() == 0
    assert set(schemas.TABLES) - set(tables.visible_tables("user")) == {"folha_funcionarios", "saldos_bancarios"}


def test_run_log(spark, store):
    end = NOW + dt.timedelta(seconds=75)
    store.append("sync_log", tables.log_start(spark, "a", NOW))
    store.append("sync_log", tables.log_success(spark, "a", NOW, end, {"lancamentos": 57}))
    store.append("sync_log", tables.log_start(spark, "b", NOW + dt.timedelta(hours=1)))
    store.append("sync_log", tables.log_failure(spark, "b", NOW + dt.timedelta(hours=1), NOW + dt.timedelta(hours=2), "x" * 9000))
    log = store.read("sync_log", role="exec")
    last = {r.sync_id: r for r in health.latest_events(log).collect()}
    assert last["a"].status == "success" and last["a"].duration_seconds == 75 and last["a"].lancamentos_count == 57
    assert last["b"].status == "failed" and len(last["b"].error_message) == 4000
    h = health.sync_health(log, F.lit(NOW + dt.timedelta(hours=9, minutes=30))).first()
    assert (h.horas_desde_fim, h.horas_desde_sucesso, h.falhas_7_dias, h.luz) == (7, 9, 1, "verde")


def test_light(spark):
    rows = [(0, 0, "verde"), (7, 1, "verde"), (8, 0, "amarelo"), (24, 0, "amarelo"), (25, 0, "vermelho"), (1, 2, "vermelho"), (None, 0, "vermelho")]
    df = spark.createDataFrame(rows, "h INT, f INT, want STRING")
    assert all(r[0] == r[1] for r in df.select("want", health.light(F.col("h"), F.col("f"))).collect())


def test_landed_pages(spark, tmp_path):
    pages = [
        {"pagina": 1, "cadastro": [{"cod": 1, "nome": "a"}, {"cod": 2, "nome": "b"}]},
        {"pagina": 2, "cadastro": [{"cod": 3, "nome": None}]},
        {"pagina": 3, "cadastro": [{"cod": 4, "nome": "d"}]},
    ]
    for p in pages:
        (tmp_path / f"p{p['pagina']}.json").write_text(json.dumps(p))
    df = raw.read_raw(spark, "projects", str(tmp_path), "cadastro", rename={"cod": "codigo"})
    got = [tuple(r) for r in df.orderBy("_page", "_pos").collect()]
    assert got == [(1, "a", 1, 0), (2, "b", 1, 1), (3, None, 2, 0), (4, "d", 3, 0)]


@pytest.mark.parametrize("fault", ["cut", "missing", "short", "twice", "indented"])
def test_landed_pages_never_lose_a_record(spark, tmp_path, fault):
    pages = [{"pagina": n, "total_de_paginas": 3, "cadastro": [{"codigo": n, "nome": "a"}]} for n in (1, 2, 3)]
    lines = [json.dumps(p) for p in pages]
    if fault == "cut":
        lines[1] = lines[1][:-12]
    elif fault == "missing":
        del lines[1]
    elif fault == "short":
        del lines[2]
    elif fault == "twice":
        lines.append(lines[0])
    else:
        lines[1] = json.dumps(pages[1], indent=1)
    for n, line in enumerate(lines):
        (tmp_path / f"p{n}.json").write_text(line)
    with pytest.raises(Exception):  # noqa: B017
        raw.read_raw(spark, "projects", str(tmp_path), "cadastro").collect()
    if fault == "indented":
        assert raw.read_raw(spark, "projects", str(tmp_path), "cadastro", multi_line=True).count() == 3


def test_repeated_lookup_records_keep_the_last(spark):
    from ledgerline.operators import normalize

    projects = spark.createDataFrame([(1, "old", 1, 0), (1, "new", 2, 0), (2, "b", 1, 1)], "codigo BIGINT, nome STRING, _page BIGINT, _pos INT")
    assert sorted(tuple(r) for r in normalize.clean_projects(projects).collect()) == [(1, "new"), (2, "b")]


def test_document(spark, tmp_path):
    ledger = I.ledger(spark, SF, "category", "direct", "project", "client")
    balances = I.balances(spark, SF)
    history = I.latest_balances(spark, SF).withColumns({"label": F.lit("x"), "saldo_conciliado": F.lit(0.0), "diferenca": F.lit(0.0)})
    from ledgerline.operators import normalize

    def build(budget, role):
        return document.dashboard_blocks(
            ledger, I.categories(spark, SF), normalize.clean_projects(I.raw_projects(spark, SF)), balances, history,
            I.order_items(spark, SF), I.clients(spark, SF), budget, I.AS_OF, NOW, role,
        )

    blocks = build(I.budget(spark, SF), "exec")
    document.write_blocks(blocks, str(tmp_path))
    assert set(blocks) == {
        "meta", "lancamentos", "categorias", "projetos", "saldos_bancarios", "historico_conciliacao", "vendas", "clientes",
        "pmr_pmp_mensal", "orcamento",
    }
    row = spark.read.json(str(tmp_path / "lancamentos")).first()
    for field in ("valor", "tipo", "status", "data", "data_vencimento", "categoria", "projeto_nome", "cliente_nome", "is_fd", "modalidade"):
        assert field in row.asDict()
    assert row.tipo in ("entrada", "saida") and len(row.data) == 10 and row.data[2] == "/"
    sales = blocks["vendas"].first()
    assert sales.quantidade_pedidos == 1500 and sum(sales.por_etapa.values()) == 1500 and len(sales.top_produtos) == 10
    budget = blocks["orcamento"].first()
    assert [x.label for x in budget.dre][0] == "Receita Bruta" and [x.label for x in budget.dre][-1] == "Lucro Líquido"
    assert set(budget.meses_com_real) < set(budget.meses_disponiveis)
    assert json.loads(document.as_json(blocks["meta"]).first()[0])["atualizado_em_formatado"] == "01/03/2026 às 08:00"
    for absent in (None, schemas.empty(spark, "orcamento_dre")):
        assert "orcamento" not in build(absent, "exec")
    assert not {"saldos_bancarios", "historico_conciliacao"} & set(build(None, "user"))


def test_public_payroll_has_no_names(spark, tmp_path):
    from ledgerline.operators import payroll as R

    sheet = I.payroll_sheet(spark, SF)
    document.write_public_payroll(R.demographics(sheet), R.salary_bands(sheet, I.LEVEL_RULES), str(tmp_path))
    text = "".join(p.read_text() for p in tmp_path.rglob("*.json"))
    assert "Func " not in text and "salario" not in text and '"media"' in text


def test_history_stream_equals_batch(spark, tmp_path):
    events = I.event_history(spark, SF)
    newest = ("sync_timestamp", "evento")
    for part in events.randomSplit([0.3, 0.3, 0.4], seed=1):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.stream_history(stream, str(tmp_path / "out"), str(tmp_path / "cp"), newest=newest).awaitTermination()
    got = streams.read_history(spark, str(tmp_path / "out"), events.schema, newest=newest)
    want = maintenance.latest_history(events, newest=newest)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_merge_stream_equals_batch(spark, store, tmp_path):
    snaps = {1: [(1, "a"), (2, "b")], 2: [(1, "a"), (2, "bb"), (3, "c")], 3: [(3, "c"), (4, "d")]}
    schema = "id BIGINT, nome STRING, sync_timestamp TIMESTAMP, n INT"
    for n, rows in snaps.items():
        df = spark.createDataFrame([(i, x, NOW + dt.timedelta(days=n), n) for i, x in rows], schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    streams.stream_merges(stream, store, "projetos", str(tmp_path / "cp"), "n").awaitTermination()
    got = sorted((r.id, r.nome, r.sync_timestamp.day) for r in store.read("projetos", role="exec").collect())
    assert got == [(3, "c", 3), (4, "d", 4)], "an unchanged row keeps its old stamp"
    assert store.version("projetos") == 3


def test_health_stream_equals_batch(spark, tmp_path):
    log = I.sync_log(spark, SF)
    log.write.parquet(str(tmp_path / "log"))
    now = F.lit(dt.datetime.fromisoformat(I.EVENTS_NOW)).cast("timestamp_ntz")
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    q = (
        streams.stream_health(stream, now).writeStream.outputMode("complete").format("memory").queryName("health_out")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert spark.table("health_out").collect() == health.sync_health(log, now).collect()


def test_history_stream_stores_keys_not_events(spark, tmp_path):
    schema = "conta_id BIGINT, data_referencia DATE, tipo STRING, saldo DOUBLE, sync_timestamp TIMESTAMP"
    day = dt.date(2026, 3, 1)
    rows = [[(i % 5, day, "mensal", float(10 * n + i), NOW + dt.timedelta(hours=n)) for i in range(5)] for n in range(9)]
    rows[4] = [(i % 5, day, "mensal", -1.0, NOW - dt.timedelta(hours=1)) for i in range(5)]  # late, older rows
    for n, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        streams.stream_history(stream, str(tmp_path / "out"), str(tmp_path / "cp"), compact_every=4).awaitTermination()
        stored = spark.read.schema(schema).parquet(*[f"{tmp_path}/out/{f}" for f in streams.live_folders(tables.TableStore(spark, str(tmp_path / "out")))])
        assert stored.count() <= 5 * 4, "repeats of a key don't pile up"
        got = streams.read_history(spark, str(tmp_path / "out"), stored.schema)
        want = maintenance.latest_history(spark.createDataFrame([r for p in rows[: n + 1] for r in p], schema))
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    left = {p.name for p in (tmp_path / "out").iterdir()}
    assert {n for n in left if n.startswith("inteiro")} == {"inteiro=7"} and len([n for n in left if n.startswith("lote")]) == 1
