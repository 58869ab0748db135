"""Merge, history, calendar, run log and rate limiting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import health, maintenance
from ledgerline.plans import inputs as I
from ledgerline.plans.checks import check, d, part
from ledgerline.plans.registry import query
from ledgerline.sources.tables import log_rows, within_retention
from ledgerline.streaming import rate_limit

TODAY = f"DATE '{I.AS_OF}'"
NOW = f"TIMESTAMP '{I.EVENTS_NOW}'"

part("dias", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS dia FROM orders")
# Each side numbers another tenth of the orders anew: inserts and deletes.
part(
    "tgt",
    """SELECT CASE WHEN o_orderkey % 10 = 0 THEN -o_orderkey ELSE o_orderkey END AS id, o_totalprice AS valor, o_orderstatus AS status, o_orderpriority AS prioridade,
 CAST(o_orderdate AS DATE) AS data_emissao FROM orders""",
)
part(
    "src",
    """SELECT CASE WHEN o_orderkey % 10 = 1 THEN -o_orderkey ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS valor, o_orderstatus AS status,
 CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS prioridade,
 CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS data_emissao FROM orders""",
)
SAME = "t.id IS NOT NULL AND t.valor = s.valor AND t.status = s.status AND COALESCE(t.prioridade, '') = COALESCE(s.prioridade, '')"


def _actions(s, sf):
    return maintenance.merge_actions(I.merge_target(s, sf), I.merge_source(s, sf), "id", I.MERGE_COMPARE)


# A row without a change in the compared columns keeps its old date.
@query(
    "merge_snapshot",
    check(
        f"""SELECT s.id, s.valor, s.status, s.prioridade, CASE WHEN {SAME} THEN t.data_emissao ELSE s.data_emissao END AS data_emissao
 FROM src s LEFT JOIN tgt t ON t.id = s.id""",
        "tgt",
        "src",
    ),
)
def _(s, sf):
    return maintenance.merged_rows(_actions(s, sf))


@query(
    "merge_stats",
    check(
        """SELECT count(*) FILTER (t.id IS NULL) AS inserted,
 count(*) FILTER (t.id IS NOT NULL AND s.id IS NOT NULL AND (t.valor <> s.valor OR t.status <> s.status OR COALESCE(t.prioridade, '') <> COALESCE(s.prioridade, ''))) AS updated,
 count(*) FILTER (s.id IS NULL) AS deleted,
 count(*) FILTER (t.id IS NOT NULL AND s.id IS NOT NULL AND t.valor = s.valor AND t.status = s.status AND COALESCE(t.prioridade, '') = COALESCE(s.prioridade, '')) AS unchanged
 FROM tgt t FULL OUTER JOIN src s ON s.id = t.id""",
        "tgt",
        "src",
    ),
)
def _(s, sf):
    return maintenance.merge_stats(_actions(s, sf))


@query(
    "latest_history",
    check(
        """SELECT user_id AS conta_id, 'Conta ' || user_id AS conta_nome, CAST(ts AS DATE) AS data_referencia, event_type AS tipo, value AS saldo_atual, ts AS sync_timestamp,
 event_id AS evento, CAST(ts AS DATE) AS sync_date FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
    ),
)
def _(s, sf):
    return maintenance.latest_history(I.event_history(s, sf), newest=("sync_timestamp", "evento"))


@query(
    "ttl_keep",
    check(
        f"""SELECT o_orderkey AS pedido, o_custkey % 25 AS conta_id, CAST(o_orderdate AS DATE) AS sync_date FROM orders
 WHERE CAST(o_orderdate AS DATE) >= CAST({TODAY} - INTERVAL 13 MONTH AS DATE)"""
    ),
)
def _(s, sf):
    return within_retention(I.balance_history(s, sf), I.AS_OF).select("pedido", "conta_id", "sync_date")


@query(
    "snapshot_calendar",
    check(
        """SELECT dia AS as_of, last_day(CAST(date_trunc('month', dia) - to_months(k) AS DATE)) AS data_referencia, 'mensal' AS tipo FROM dias, range(1, 7) t(k)
 UNION ALL SELECT DISTINCT dia, x, 'diario' FROM (SELECT dia, unnest(CAST(generate_series(date_trunc('month', dia), dia, INTERVAL 5 DAY) AS DATE[])) AS x FROM dias UNION ALL SELECT dia, dia FROM dias)""",
        "dias",
    ),
)
def _(s, sf):
    days = I.table(s, sf, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return maintenance.snapshot_calendar(days)


@query(
    "pending_snapshots",
    check(
        f"""SELECT a.conta_id, p.data_referencia, p.tipo FROM (SELECT DISTINCT o_custkey % 50 AS conta_id FROM orders) a,
 (SELECT last_day(CAST({TODAY} - to_months(k) AS DATE)) AS data_referencia, 'mensal' AS tipo FROM range(1, 7) t(k) UNION ALL SELECT {TODAY}, 'diario') p
 WHERE NOT (p.tipo = 'mensal' AND EXISTS (SELECT 1 FROM hist h WHERE h.conta = a.conta_id AND h.mes_fim = p.data_referencia))""",
        "hist",
    ),
)
def _(s, sf):
    accounts = I.table(s, sf, "orders").select((F.col("o_custkey") % 50).alias("conta_id")).distinct()
    return maintenance.pending_snapshots(accounts, I.balance_history(s, sf), I.AS_OF)


@query(
    "active_accounts",
    check(
        f"""SELECT conta_id, conta_nome, conta_tipo, saldo, saldo_conciliado, {d('saldo', 'saldo_conciliado')} AS diferenca,
 {TODAY} - 1 AS data_referencia FROM saldos WHERE saldo <> 0 OR saldo_conciliado <> 0""",
        "saldos",
    ),
)
def _(s, sf):
    return maintenance.active_accounts(I.balances(s, sf), I.IGNORED)


@query(
    "snapshot_rows",
    check(
        f"""SELECT conta AS conta_id, 'Conta ' || conta AS conta_nome, mes_fim AS data_referencia, strftime(mes_fim, '%b/%y') AS label, saldo AS saldo_atual,
 CAST(CAST(saldo AS DECIMAL(18,2)) - 1.25 AS DOUBLE) AS saldo_conciliado, 1.25::DOUBLE AS diferenca, 'mensal' AS tipo FROM hist
 UNION ALL SELECT o_custkey % 25, 'Conta ' || o_custkey % 25, CAST(o_orderdate AS DATE), strftime(o_orderdate, '%d/%m'), o_totalprice,
 CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 1.25 AS DOUBLE), 1.25, 'diario' FROM orders""",
        "hist",
    ),
)
def _(s, sf):
    monthly = I.latest_balances(s, sf)
    daily = I.balance_history(s, sf).withColumn("tipo", F.lit("diario")).withColumn("data_referencia", F.col("sync_date"))
    points = monthly.unionByName(daily).withColumnRenamed("saldo_atual", "saldo")
    return maintenance.snapshot_rows(points.withColumn("saldo_conciliado", F.round(F.col("saldo") - 1.25, 2)))


# Every event as a run: views still run, errors fail with a text of about 5,000 characters.
@query(
    "run_log_rows",
    check(
        """SELECT s.sync_id, s.started_at, s.finished_at, s.status, date_sub('second', s.started_at, s.finished_at) AS duration_seconds, user_id AS lancamentos_count,
 left(CASE WHEN s.status = 'failed' THEN repeat('erro ' || s.sync_id || ' ', 600) END, 4000) AS error_message, FALSE AS is_incremental FROM slog s JOIN events ON CAST(event_id AS VARCHAR) = sync_id""",
        "slog",
    ),
)
def _(s, sf):
    users = I.table(s, sf, "events").select(F.col("event_id").cast("string").alias("sync_id"), F.col("user_id").alias("lancamentos_count"))
    error = F.when(F.col("status") == "failed", F.repeat(F.concat(F.lit("erro "), "sync_id", F.lit(" ")), F.lit(600)))
    rows = log_rows(I.sync_log(s, sf).join(users, "sync_id").withColumn("error", error).drop("status"))
    kept = ["sync_id", "status", "duration_seconds", "lancamentos_count", "error_message", "is_incremental"]
    return rows.select(*kept, *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started_at", "finished_at")])


@query(
    "sync_health",
    check(
        f"""SELECT *, CASE WHEN horas_desde_fim > 24 OR falhas_7_dias >= 2 THEN 'vermelho' WHEN horas_desde_fim >= 8 THEN 'amarelo' ELSE 'verde' END AS luz FROM (
 SELECT date_sub('hour', max(finished_at), {NOW}) AS horas_desde_fim, date_sub('hour', max(finished_at) FILTER (status = 'success'), {NOW}) AS horas_desde_sucesso,
 count(*) FILTER (status = 'failed' AND started_at > {NOW} - INTERVAL 7 DAY) AS falhas_7_dias FROM slog)""",
        "slog",
    ),
)
def _(s, sf):
    now = F.lit(dt.datetime.fromisoformat(I.EVENTS_NOW)).cast("timestamp_ntz")
    return health.sync_health(I.sync_log(s, sf), now)


@query("sync_last_status", check("SELECT * FROM slog ORDER BY started_at DESC, sync_id DESC LIMIT 1", "slog"))
def _(s, sf):
    return health.last_status(I.sync_log(s, sf))


# Several events per run: a run is a user's day, its last finished event counts.
@query(
    "sync_latest_events",
    check(
        """SELECT sync_id, started_at, finished_at, status FROM (SELECT user_id || ' ' || strftime(started_at, '%Y-%m-%d') AS sync_id, started_at, finished_at, status,
 row_number() OVER (PARTITION BY user_id, CAST(started_at AS DATE) ORDER BY finished_at DESC NULLS LAST, started_at DESC) AS n
 FROM slog JOIN events ON CAST(event_id AS VARCHAR) = sync_id) WHERE n = 1""",
        "slog",
    ),
)
def _(s, sf):
    users = I.table(s, sf, "events").select(F.col("event_id").cast("string").alias("sync_id"), "user_id")
    run = F.concat_ws(" ", F.col("user_id").cast("string"), F.date_format("started_at", "yyyy-MM-dd"))
    log = I.sync_log(s, sf).join(users, "sync_id").withColumn("sync_id", run).drop("user_id")
    return health.latest_events(log)


# One step of the recursion decides the n-th request of every user.
@query(
    "rate_limit_admissions",
    """WITH RECURSIVE e AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE ts IS NOT NULL),
 r AS (SELECT user_id, ts, event_id, n, TRUE AS accepted, [ts] AS recent FROM e WHERE n = 1
 UNION ALL SELECT user_id, ts, event_id, n, len(live) < 5, CASE WHEN len(live) < 5 THEN list_append(live, ts) ELSE live END FROM (
  SELECT e.*, list_filter(r.recent, lambda x: e.ts - x < INTERVAL 1 DAY) AS live FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1))
 SELECT user_id, ts, event_id, accepted FROM r UNION ALL SELECT user_id, ts, event_id, FALSE FROM events WHERE ts IS NULL""",
)
def _(s, sf):
    events = I.table(s, sf, "events").select("user_id", "ts", "event_id")
    return rate_limit.admissions(events, "user_id", "ts", "event_id", limit=5, window_seconds=86400)
