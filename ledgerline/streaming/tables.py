"""Tables kept current by streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import health, maintenance
from ledgerline.sources.sync import merge_table
from ledgerline.sources.tables import TableStore


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_history(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Iterable[str] = ("conta_id", "data_referencia", "tipo"),
    newest: Iterable[str] = ("sync_timestamp",),
    compact_every: int = 8,
) -> StreamingQuery:
    """Keeps the newest row per key as state and stores the rows of keys that change.

    A streaming aggregation holds one row per key, so an older row that comes late changes nothing.
    Each micro-batch owns a folder ``lote=<n>`` and overwrites it when replayed. Every
    ``compact_every`` micro-batches all live rows are written to ``inteiro=<n>`` and the folders
    before it are removed: what is stored follows the number of keys, not of events.
    """
    key, newest = list(key), list(newest)
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    latest = stream.groupBy(*key).agg(F.max_by(row, F.struct(*newest)).alias("_r")).select("_r.*")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/lote={batch_id}")
        if (batch_id + 1) % compact_every:
            return
        store = TableStore(spark, path)
        if "_SUCCESS" not in store._names(f"{path}/inteiro={batch_id}"):  # else a replay: what it was made of may be gone
            live = spark.read.schema(batch.schema).parquet(*[f"{path}/{f}" for f in live_folders(store, batch_id)])
            maintenance.latest_history(live, key, newest).write.mode("overwrite").parquet(f"{path}/inteiro={batch_id}")
        for name in store._names(path):
            kind, _, n = name.partition("=")
            if kind in ("lote", "inteiro") and (int(n), kind) < (batch_id, "inteiro") or name == f"lote={batch_id}":
                store._delete(f"{path}/{name}")

    return (
        latest.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def live_folders(store: TableStore, upto: int | None = None) -> list[str]:
    """The newest whole folder and the micro-batches after it. A whole folder counts once its write is complete."""
    names = [n.partition("=") for n in store._names(store.root)]
    whole = [int(n) for kind, _, n in names if kind == "inteiro" and "_SUCCESS" in store._names(f"{store.root}/inteiro={n}")]
    whole = [n for n in whole if upto is None or n < upto]
    last = max(whole, default=-1)
    parts = sorted(int(n) for kind, _, n in names if kind == "lote" and int(n) > last)
    return ([f"inteiro={last}"] if whole else []) + [f"lote={n}" for n in parts]


def read_history(
    spark: SparkSession,
    path: str,
    schema,
    key: Iterable[str] = ("conta_id", "data_referencia", "tipo"),
    newest: Iterable[str] = ("sync_timestamp",),
) -> DataFrame:
    folders = live_folders(TableStore(spark, path))
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])
    return maintenance.latest_history(rows, key, newest)


def stream_merges(
    snapshots: DataFrame, store: TableStore, table: str, checkpoint: str, snapshot_col: str, size_col: str | None = None
) -> StreamingQuery:
    """Takes over arriving snapshots in order; ``snapshot_col`` numbers them from 1.

    Rows are staged by snapshot, one folder per micro-batch. Snapshot n is merged after n - 1, once it
    is whole: with ``size_col`` when so many rows have come, else it must come in one micro-batch. The
    manifest that shows a snapshot also says its number and micro-batch, so a replayed micro-batch
    publishes nothing twice, and rows of a snapshot that is already published stop the stream. The
    staged rows of a published snapshot are removed.
    """
    staged = f"{store.root}/_chegada/{table}"

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        taken, at = store.state().marks.get(table, [0, -1])
        new = batch.withColumn("_snap", F.col(snapshot_col).cast("long")).withColumn("_lote", F.lit(batch_id).cast("long"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_snap", "_lote").parquet(staged)
        if store._names(staged) == []:
            return
        rows = spark.read.schema(new.schema).parquet(staged)
        size = F.max(size_col) if size_col else F.lit(None).cast("long")
        have = rows.groupBy("_snap").agg(F.count(F.lit(1)).alias("n"), size.alias("size"), F.max("_lote").alias("last"))
        for n, seen, whole, last in have.orderBy("_snap").collect():  # one row per open snapshot
            if n <= taken and last > at:
                raise ValueError(f"rows of snapshot {n} of {table} came after it was published")
            if n <= taken:
                store._delete(f"{staged}/_snap={n}")
                continue
            if n != taken + 1 or (whole is not None and seen < whole):
                break
            source = rows.filter(F.col("_snap") == n).drop("_snap", "_lote", snapshot_col, *([size_col] if size_col else []))
            base = store.state()
            folders, _ = merge_table(store, table, source, base)
            store.publish({} if folders is None else {table: folders}, base=base, marks={table: [n, batch_id]})
            taken, at = n, batch_id
            store._delete(f"{staged}/_snap={n}")

    return _start(snapshots, each, checkpoint)


def stream_health(log: DataFrame, now: Column) -> DataFrame:
    """Health figures over the run-log stream; write in complete mode."""
    return health.sync_health(log, now)
