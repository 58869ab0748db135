"""Keeping tables current: snapshot merge, deduplicated history, snapshot calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dates as D
from ledgerline.functions import text as T
from ledgerline.functions.money import round_cents

INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"


def _differs(cols: Iterable[str], left: str, right: str) -> Column:
    """Any column differs as text; NULL equals the empty text."""

    def text(side: str, c: str) -> Column:
        return F.coalesce(F.col(f"{side}.{c}").cast("string"), F.lit(""))

    return reduce(lambda a, b: a | b, [text(left, c) != text(right, c) for c in cols])


def _unique(df: DataFrame, key: str, side: str) -> DataFrame:
    """Fails the job, naming the key, when a key occurs twice.

    The numbering shuffles by the merge key, which the join needs anyway, so
    Spark reuses that one exchange. It also holds no group in memory.
    """
    n = F.row_number().over(Window.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"duplicate {key} in {side}: "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_n", n).filter(checked).drop("_n")


def merge_actions(target: DataFrame, source: DataFrame, key: str, compare: Iterable[str]) -> DataFrame:
    """Full outer join of both snapshots: key, ``action``, and both row structs ``t`` and ``s``.

    The key is unique on both sides, so a hot key cannot exist and rows spread evenly.
    """
    cols = target.columns
    typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])
    t = _unique(target, key, "target").select(F.col(key), F.struct(*cols).alias("t"))
    s = _unique(typed, key, "source").select(F.col(key), F.struct(*cols).alias("s"))
    action = (
        F.when(F.col("t").isNull(), INSERTED)
        .when(F.col("s").isNull(), DELETED)
        .when(_differs(compare, "t", "s"), UPDATED)
        .otherwise(UNCHANGED)
    )
    return t.join(s, key, "full_outer").withColumn("action", action)


def merged_rows(actions: DataFrame) -> DataFrame:
    """New table content: source rows for inserts and updates, old rows otherwise, deletes dropped."""
    row = F.when(F.col("action").isin(INSERTED, UPDATED), F.col("s")).otherwise(F.col("t"))
    return actions.filter(F.col("action") != DELETED).select(row.alias("r")).select("r.*")


def merge_stats(actions: DataFrame) -> DataFrame:
    """One row: exact number of inserted, updated, deleted and unchanged rows."""
    return actions.agg(
        *[F.count_if(F.col("action") == a).alias(a) for a in (INSERTED, UPDATED, DELETED, UNCHANGED)]
    )


def merge_snapshot(target: DataFrame, source: DataFrame, key: str, compare: Iterable[str]) -> DataFrame:
    """Target after taking over the source snapshot; an empty source changes nothing."""
    if source.isEmpty():
        return target
    return merged_rows(merge_actions(target, source, key, compare))


def latest_history(
    history: DataFrame,
    key: Iterable[str] = ("conta_id", "data_referencia", "tipo"),
    newest: Iterable[str] = ("sync_timestamp",),
) -> DataFrame:
    """Newest row per key. Spark keeps one row per key and task before the shuffle, so a hot key stays cheap."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in newest])
    return history.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def calendar_points(as_of: Column) -> Column:
    """Array of (data_referencia, tipo): six past month ends, then days 1, 6, 11, ... and the as-of day."""
    month = F.trunc(as_of, "month")
    ends = F.transform(F.sequence(F.lit(6), F.lit(1)), lambda k: F.last_day(F.add_months(month, -k)))
    days = F.array_distinct(
        F.concat(F.sequence(month, as_of, F.expr("INTERVAL 5 DAYS")), F.array(as_of))
    )

    def tag(points: Column, tipo: str) -> Column:
        return F.transform(points, lambda d: F.struct(d.alias("data_referencia"), F.lit(tipo).alias("tipo")))

    return F.concat(tag(ends, "mensal"), tag(days, "diario"))


def snapshot_calendar(dates: DataFrame, as_of: str = "as_of") -> DataFrame:
    """Calendar points for every as-of date of the input."""
    return dates.select(F.col(as_of), F.explode(calendar_points(F.col(as_of))).alias("p")).select(as_of, "p.*")


def active_accounts(balances: DataFrame, ignored: Iterable[int] = K.IGNORED_ACCOUNTS) -> DataFrame:
    moving = (F.col("saldo") != 0) | (F.col("saldo_conciliado") != 0)
    return balances.filter(moving & T.keep_account("conta_id", tuple(ignored), keep_null=False))


def pending_snapshots(accounts: DataFrame, history: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Snapshots still to fetch: every daily point, and month ends that history does not hold yet.

    The calendar is a constant array exploded per account, not a join.
    """
    today = D.date_lit(as_of)
    wanted = accounts.select("conta_id", F.explode(calendar_points(today)).alias("p")).select("conta_id", "p.*")
    stored = (
        history.filter((F.col("tipo") == "mensal") & (F.trunc("data_referencia", "month") != F.trunc(today, "month")))
        .select("conta_id", "data_referencia", "tipo")
        .distinct()
    )
    return wanted.join(stored, ["conta_id", "data_referencia", "tipo"], "left_anti")


def snapshot_rows(points: DataFrame) -> DataFrame:
    """History rows from fetched points: conta_id, conta_nome, data_referencia, tipo, saldo, saldo_conciliado."""
    label = F.when(F.col("tipo") == "mensal", F.date_format("data_referencia", "MMM/yy")).otherwise(
        F.date_format("data_referencia", "dd/MM")
    )
    return points.select(
        "conta_id",
        "conta_nome",
        "data_referencia",
        label.alias("label"),
        F.col("saldo").alias("saldo_atual"),
        "saldo_conciliado",
        round_cents(F.col("saldo") - F.col("saldo_conciliado")).alias("diferenca"),
        "tipo",
    )
