"""Rate limiting: at most ``limit`` accepted requests per trailing window and user.

Rejected requests do not count, so each decision depends on earlier decisions
and a plain window count is not enough. The batch form narrows the sequential
part down:

1. Count requests, accepted or not, in the trailing window. Below the limit a
   request is accepted whatever happened before. The count runs per (user, time
   slice); the last window of a slice is copied into the next one, so a busy
   user is spread over many tasks.
2. A slice without any contested request is settled here, in SQL.
3. Runs of contested slices, with the settled window before them as context, go
   through one ordered pass. It streams Arrow batches and keeps ``limit``
   timestamps, whatever the length of the run.

A run of one user is decided in order by one task: that dependency is the rule
itself. The pass skips rejected stretches by binary search.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SLICE_WINDOWS = 8


def decide(times: np.ndarray, limit: int, window: int, recent: deque) -> np.ndarray:
    """Decisions for ascending timestamps; ``recent`` holds accepted ones and is updated."""
    out = np.zeros(len(times), dtype=bool)
    i, n = 0, len(times)
    while i < n:
        while recent and times[i] - recent[0] >= window:
            recent.popleft()
        if len(recent) < limit:
            out[i] = True
            recent.append(times[i])
            i += 1
        else:
            i += max(1, int(np.searchsorted(times[i:], recent[0] + window)))
    return out


def _ordered_pass(limit: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, recent = None, deque()
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            chain = batch.column("_chain").to_numpy(zero_copy_only=False)
            user = np.asarray(batch.column("_user").to_pylist(), dtype=object)
            times = batch.column("_t").to_numpy(zero_copy_only=False)
            context = batch.column("_context").to_numpy(zero_copy_only=False)
            new = np.r_[True, (chain[1:] != chain[:-1]) | (user[1:] != user[:-1])]
            starts = np.r_[np.flatnonzero(new), n]
            accepted = np.zeros(n, dtype=bool)
            for lo, hi in zip(starts[:-1], starts[1:]):
                key = (user[lo], chain[lo])
                if key != current:
                    current, recent = key, deque()
                while lo < hi and context[lo]:
                    recent.append(times[lo])
                    lo += 1
                accepted[lo:hi] = decide(times[lo:hi], limit, window, recent)
            out = batch.append_column("accepted", pa.array(accepted))
            keep = pa.array(~context)
            yield out.filter(keep).drop_columns(["_chain", "_user", "_t", "_context"])

    return run


def admissions(
    events: DataFrame, user: str, ts: str, event_id: str, limit: int = 10, window_seconds: int = 60
) -> DataFrame:
    """Adds ``accepted`` to (user, ts, event_id) rows. A request without a time can't be placed and is refused."""
    window = window_seconds * 1_000_000
    span = SLICE_WINDOWS * window
    timed = F.col(ts)
    if isinstance(events.schema[ts].dataType, TimestampNTZType):
        # read as UTC, whatever the session's zone: distances must not jump with its clock
        timed = F.concat(timed.cast("string"), F.lit("Z"))
    micros = F.unix_micros(timed.cast("timestamp"))
    rows = events.select(user, ts, event_id, F.col(user).alias("_user"), micros.alias("_t"))
    untimed = rows.filter("_t IS NULL").select(user, ts, event_id, F.lit(False).alias("accepted"))
    rows = rows.filter("_t IS NOT NULL").withColumn("_slice", F.floor(F.col("_t") / span))
    tail = F.col("_t") >= (F.col("_slice") + 1) * span - window
    placed = rows.withColumn(
        "_at", F.explode(F.when(tail, F.array(F.col("_slice"), F.col("_slice") + 1)).otherwise(F.array("_slice")))
    )
    before = (
        Window.partitionBy("_user", "_at").orderBy("_t").rangeBetween(-(window - 1), Window.currentRow)
    )
    in_order = Window.partitionBy("_user", "_at", "_t").orderBy(event_id)
    # requests in the trailing window, minus those of the same instant that come later
    same = F.count(F.lit(1)).over(Window.partitionBy("_user", "_at", "_t"))
    ahead = F.count(F.lit(1)).over(before) - same + F.row_number().over(in_order) - 1
    counted = placed.withColumn("_contested", ahead >= limit)
    own = F.col("_at") == F.col("_slice")
    slices = counted.groupBy("_user", "_at").agg(F.max(F.col("_contested") & own).alias("_hot"))
    # slice number minus rank among the hot ones is constant along a run of neighbours
    rank = F.row_number().over(Window.partitionBy("_user").orderBy("_at"))
    runs = slices.filter("_hot").withColumn("_chain", F.col("_at") - rank).select("_user", "_at", "_chain")
    keys = ["_user", "_at"]
    first = Window.partitionBy("_user", "_chain").orderBy("_at")
    runs = runs.withColumn("_first", F.row_number().over(first) == 1)
    j = placed.join(runs, keys, "left")
    free = j.filter(F.col("_chain").isNull() & own).select(user, ts, event_id, F.lit(True).alias("accepted"))
    # copies from the slice before matter only at the start of a run
    busy = j.filter(F.col("_chain").isNotNull() & (own | F.col("_first")))
    busy = busy.select(user, ts, event_id, "_user", "_chain", "_t", (~own).alias("_context"))
    ordered = busy.repartition("_user", "_chain").sortWithinPartitions("_user", "_chain", "_t", event_id)
    schema = events.select(user, ts, event_id).withColumn("accepted", F.lit(True)).schema
    return free.unionByName(ordered.mapInArrow(_ordered_pass(limit, window), schema)).unionByName(untimed)


def admit_stream(
    events: DataFrame, user: str, ts: str, event_id: str, limit: int = 10, window_seconds: int = 60, delay: str = "1 minute"
) -> DataFrame:
    """Continuous form over a stream of TIMESTAMP events.

    State per user: the accepted timestamps of the last window, at most
    ``limit``. Events are ordered inside a micro-batch; state of users that
    stay silent is dropped once the watermark has passed their window.
    """
    window = window_seconds * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        recent = deque(state.get[0]) if state.exists else deque()
        rows = pd.concat(list(frames)).sort_values([ts, event_id], kind="stable")
        times = rows[ts].astype("datetime64[us]").astype("int64").to_numpy()
        rows["accepted"] = decide(times, limit, window, recent)
        state.update(([int(t) for t in recent],))
        if recent:
            wake = int(recent[-1] + window) // 1000
            state.setTimeoutTimestamp(max(wake, state.getCurrentWatermarkMs() + 1))
        yield rows[[user, ts, event_id, "accepted"]]

    schema = events.select(user, ts, event_id).withColumn("accepted", F.lit(True)).schema
    return (
        events.select(user, ts, event_id)
        .withWatermark(ts, delay)
        .groupBy(user)
        .applyInPandasWithState(step, schema, "recent array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    )
