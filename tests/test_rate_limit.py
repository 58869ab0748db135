"""Rate limiting: batch and stream against a sequential model."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.streaming import rate_limit as R

T0 = dt.datetime(2024, 1, 1)


def model(events, limit, window):
    recent, out = {}, {}
    for user, second, eid in sorted(events, key=lambda e: (e[1], e[2])):
        q = [t for t in recent.get(user, []) if second - t < window]
        ok = len(q) < limit
        recent[user] = q + [second] if ok else q
        out[eid] = ok
    return out


def batch(spark, events, limit, window, parts=4):
    rows = [(u, T0 + dt.timedelta(seconds=s), e) for u, s, e in events]
    df = spark.createDataFrame(rows, "user BIGINT, ts TIMESTAMP_NTZ, event_id BIGINT").repartition(parts)
    return {r.event_id: r.accepted for r in R.admissions(df, "user", "ts", "event_id", limit, window).collect()}


def test_rejected_requests_do_not_count(spark):
    events = [(1, s, s) for s in range(0, 130, 5)]
    got = batch(spark, events, 3, 60)
    assert got == model(events, 3, 60)
    assert sum(got.values()) == 8


def test_many_users_one_of_them_hot(spark):
    rnd = random.Random(3)
    # user 0 sends a third of everything and is overloaded across many slices
    events = [(0, rnd.randrange(20000), i) for i in range(2000)]
    events += [(rnd.randrange(1, 60), rnd.randrange(20000), 2000 + i) for i in range(4000)]
    assert batch(spark, events, 4, 60) == model(events, 4, 60)


def test_same_instant_is_ordered_by_id(spark):
    events = [(1, 10, i) for i in range(8)] + [(1, 70, 100), (1, 69, 101)]
    assert batch(spark, events, 3, 60) == model(events, 3, 60)


def test_slice_borders(spark):
    span = R.SLICE_WINDOWS * 10
    events = [(1, span * k + d, 1000 * k + 10 * j + d + 50) for k in range(4) for j in range(3) for d in (-12, -9, -1, 0, 1, 9)]
    events = [e for e in events if e[1] >= 0]
    assert batch(spark, events, 2, 10) == model(events, 2, 10)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=1, max_size=60), st.integers(1, 4))
def test_against_model(spark, pairs, limit):
    events = [(u, s, i) for i, (u, s) in enumerate(pairs)]
    assert batch(spark, events, limit, 20) == model(events, limit, 20)


def test_only_contested_slices_reach_python(spark):
    events = [(u, 600 * u + 7 * k, u * 100 + k) for u in range(5) for k in range(20)]
    assert all(batch(spark, events, 10, 60).values())


def test_stream_equals_batch(spark, tmp_path):
    rnd = random.Random(5)
    events = sorted(((rnd.randrange(6), rnd.randrange(4000), i) for i in range(500)), key=lambda e: (e[1], e[2]))
    want = model(events, 3, 60)
    schema = "user BIGINT, ts TIMESTAMP, event_id BIGINT"
    for k in range(4):
        part = events[k * 125 : (k + 1) * 125]
        rows = [(u, T0 + dt.timedelta(seconds=s), e) for u, s, e in part]
        # files are read in the order of their modification time
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = R.admit_stream(stream, "user", "ts", "event_id", 3, 60, delay="10 minutes")
    q = (
        out.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = {r.event_id: r.accepted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want


@pytest.mark.parametrize("window", [86400])
def test_given_events(spark, window):
    rows = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    df = R.admissions(rows, "user_id", "ts", "event_id", 5, window)
    assert df.filter(~F.col("accepted")).count() == 485 and df.count() == 10000


def test_time_zone_and_missing_times(spark):
    rows = [("u", "2024-03-31 01:59:50", 1), ("u", "2024-03-31 03:00:10", 2), ("u", None, 3)]
    events = spark.createDataFrame(rows, "user STRING, t STRING, id INT").selectExpr("user", "CAST(t AS TIMESTAMP_NTZ) AS ts", "id")
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r.id: r.accepted for r in R.admissions(events, "user", "ts", "id", 1, 60).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == {1: True, 2: True, 3: False}
