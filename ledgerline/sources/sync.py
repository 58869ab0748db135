"""One batch run: landed records in, all tables published together.

Order: log start, clean and join, write what is new, guard against an empty run,
publish all of it with the success event. Any failure before the publish
leaves readers on the old state and appends a failed event.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators import budget as B
from ledgerline.operators import maintenance as M
from ledgerline.operators import normalize as N
from ledgerline.operators import payroll as P
from ledgerline.schemas import MERGE_RULES, TABLES, conform
from ledgerline.sources import tables as T

KINDS = (M.INSERTED, M.UPDATED, M.DELETED, M.UNCHANGED)


@dataclass(frozen=True)
class Landed:
    """Raw frames of one run, in the shapes of ``schemas.RAW``.

    ``statements``: conta_id, saldo, saldo_conciliado of the previous day.
    ``points``: fetched history points (conta_id, conta_nome, data_referencia,
    tipo, saldo, saldo_conciliado), see ``maintenance.pending_snapshots``.
    """

    receivables: DataFrame
    payables: DataFrame
    movements: DataFrame
    categories: DataFrame
    projects: DataFrame
    clients: DataFrame
    accounts: DataFrame
    statements: DataFrame
    points: DataFrame
    orders: DataFrame


def merge_table(
    store: T.TableStore, table: str, source: DataFrame, state: T.State | None = None
) -> tuple[list[str] | None, dict[str, int]]:
    """Takes over a snapshot. Returns (folders of the new state or None if nothing changed, counts per action).

    The source runs once, into held rows. One join of them with the key, the compared columns
    and the partition date of the target gives the changes; only partitions that lose or gain a row
    are read whole and written anew. An empty source changes nothing.
    """
    spec = TABLES[table]
    key, state = spec.key[0], state or store.state()
    held, counted = store.hold(conform(source, table))
    if not counted["n"]:
        return None, dict.fromkeys(KINDS, 0)
    folders = state.folders.get(table, [])
    month = (lambda side: F.trunc(F.col(side)[spec.month], "month")) if spec.month else (lambda side: F.lit(None).cast("date"))
    narrow = [key, *MERGE_RULES[table], *([spec.month] if spec.month and spec.month not in MERGE_RULES[table] else [])]
    target = store.read_folders(table, folders)
    actions = M.merge_actions(target.select(*narrow), held, key, MERGE_RULES[table])
    seen = Observation()
    actions = actions.observe(seen, *[F.count_if(F.col("action") == k).alias(k) for k in KINDS])
    changed = actions.filter(F.col("action") != M.UNCHANGED)
    changes, _ = store.hold(
        changed.select(
            key,
            "action",
            F.when(F.col("t").isNotNull(), month("t")).alias("antes"),
            F.when(F.col("action").isin(M.INSERTED, M.UPDATED), month("s")).alias("depois"),
            F.col("t").isNotNull().alias("tinha"),
        )
    )
    counts = {k: int(n) for k, n in T.observed(seen, list(KINDS)).items()}
    if counts[M.UNCHANGED] == sum(counts.values()):
        return None, counts
    kept, opened = [], folders
    if spec.month:  # one row per month
        left = changes.filter("tinha").select("antes")
        gained = changes.filter(F.col("action") != M.DELETED).select("depois")
        months = {r[0] for r in left.union(gained).distinct().collect()}
        kept = [f for f in folders if T._value(f) not in months]
        opened = [f for f in folders if T._value(f) in months]
    stay = store.read_folders(table, opened).join(changes, key, "left_anti")
    new = held.join(changes.filter(F.col("action") != M.DELETED), key, "left_semi")
    written, _ = store.write_version(table, stay.unionByName(new))
    return kept + written, counts


def run_sync(
    store: T.TableStore,
    landed: Landed,
    sync_id: str,
    started_at: dt.datetime,
    finished_at: dt.datetime | None = None,
    ignored: tuple[int, ...] = K.IGNORED_ACCOUNTS,
) -> dict[str, dict[str, int] | int]:
    """Runs one batch. Returns merge counts per merged table and row counts of the others."""
    spark = store.spark
    store.append("sync_log", T.log_start(spark, sync_id, started_at))
    end = lambda: finished_at or dt.datetime.now()
    try:
        base = store.state()
        counts, replaced, history = _write_all(store, landed, started_at, ignored, base)
        ledger = counts["lancamentos"]
        totals = {
            "lancamentos": ledger[M.INSERTED] + ledger[M.UPDATED],
            "saldos": counts["saldos_bancarios"],
            **{t: sum(n for k, n in counts[t].items() if k != M.DELETED) for t in ("clientes", "projetos", "categorias")},
        }
        event, _ = store.write_version("sync_log", T.log_success(spark, sync_id, started_at, end(), totals))
        fresh = [f for f in history if f not in base.folders.get("historico_saldos", [])]
        kept = store.retained("historico_saldos", base.folders.get("historico_saldos", []), started_at.date())
        store.publish(replaced | {"historico_saldos": kept + fresh}, {"sync_log": event}, base)
    except Exception as e:
        store.append("sync_log", T.log_failure(spark, sync_id, started_at, end(), str(e)))
        raise
    return counts


def _write_all(store: T.TableStore, landed: Landed, started_at: dt.datetime, ignored: tuple[int, ...], base: T.State):
    stamp, day = F.lit(started_at), started_at.date()
    stamped = lambda df: df.withColumn("sync_timestamp", stamp).withColumn("sync_date", F.lit(day))
    yesterday: Column = F.date_sub(F.lit(day), 1)
    categories = N.clean_categories(landed.categories)
    projects = N.clean_projects(landed.projects)
    ledger = N.build_ledger(
        landed.receivables,
        landed.payables,
        categories,
        projects,
        N.client_names(landed.clients),
        N.payment_dates(landed.movements),
        ignored,
        stamp,
    )
    balances = stamped(N.account_balances(landed.accounts, landed.statements, yesterday, ignored))
    counts: dict = {}
    folders: dict[str, list[str]] = {}
    folders["saldos_bancarios"], counts["saldos_bancarios"] = store.write_version("saldos_bancarios", balances)
    merged = {
        "lancamentos": ledger,
        "categorias": stamped(categories),
        "projetos": stamped(projects),
        "clientes": stamped(N.clean_clients(landed.clients)),
    }
    for table, source in merged.items():
        folders[table], counts[table] = merge_table(store, table, source, base)
        if table == "lancamentos":
            T.nonempty_guard(sum(n for k, n in counts[table].items() if k != M.DELETED), counts["saldos_bancarios"])
    folders["vendas_pedidos"], counts["vendas_pedidos"] = store.write_version("vendas_pedidos", stamped(N.order_items(landed.orders)))
    history, counts["historico_saldos"] = store.write_version("historico_saldos", stamped(M.snapshot_rows(landed.points)))
    return counts, {t: f for t, f in folders.items() if f or (f is not None and t in merged)}, history


def run_backfill(
    store: T.TableStore,
    accounts: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    started_at: dt.datetime,
    batches: int = 8,
) -> int:
    """Fetches the balance snapshots that history lacks and appends them, batch by batch. Returns the points fetched.

    The work list is the calendar without stored month ends and without the points that this run has
    stored before: every batch is published when it is done and is so marked off. A run that failed is
    continued by calling it again with its ``started_at``; only what is open is fetched. ``fetch`` turns
    points (conta_id, conta_nome, data_referencia, tipo) into points with saldo and saldo_conciliado.
    """
    day, done = started_at.date(), 0
    history = store.read("historico_saldos", role="exec")
    own = history.filter(F.col("sync_timestamp") == F.lit(started_at)).select("conta_id", "data_referencia", "tipo")
    names = accounts.select("conta_id", "conta_nome")
    open_points = M.pending_snapshots(accounts, history, day).join(own, ["conta_id", "data_referencia", "tipo"], "left_anti")
    batch = F.pmod(F.xxhash64("conta_id", "data_referencia", "tipo"), F.lit(batches)).alias("_lote")
    work, _ = store.hold(open_points.join(names, "conta_id").select("conta_id", "conta_nome", "data_referencia", "tipo", batch))
    for n in range(batches):
        points = fetch(work.filter(F.col("_lote") == n).drop("_lote"))
        rows = M.snapshot_rows(points).withColumn("sync_timestamp", F.lit(started_at)).withColumn("sync_date", F.lit(day))
        done += store.append("historico_saldos", rows)
    return done


def load_budget(
    store: T.TableStore, cells: DataFrame, lines: DataFrame, year: int, started_at: dt.datetime, allowed: int = 3
) -> tuple[int, int]:
    """Replaces the budget table from workbook cells. Returns (rows, labels that differ from the line map).

    Differing labels are summed by the write's own job; more than ``allowed`` publish nothing.
    """
    differing = B.line_map_mismatches(cells, lines).groupBy(F.col("esperado").alias("label")).agg(F.count("*").alias("_n"))
    rows = B.budget_from_cells(cells, lines, year).join(differing, "label", "left")
    seen = Observation()
    once = F.when(F.col("mes").endswith("-01"), F.col("_n"))
    rows = rows.observe(seen, F.coalesce(F.sum(once), F.lit(0)).alias("n")).drop("_n")
    folders, n = store.write_version("orcamento_dre", rows.withColumn("sync_timestamp", F.lit(started_at)))
    wrong = int(T.observed(seen, ["n"])["n"])
    if wrong > allowed:
        raise B.LineMapMismatch(f"{wrong} labels do not match the line map")
    if n:
        store.publish({"orcamento_dre": folders})
    return n, wrong


def load_payroll(store: T.TableStore, sheet: DataFrame, as_of: dt.date | str) -> int:
    """Replaces the payroll table from month sheets; rows without a name or month publish nothing."""
    return store.replace("folha_funcionarios", P.payroll_rows(sheet, as_of))
