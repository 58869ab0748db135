"""Snapshot merge, history, retention, calendar."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import maintenance as M
from ledgerline.sources.tables import within_retention

SCHEMA = "id BIGINT, valor DOUBLE, nota STRING, extra STRING"
COMPARE = ("valor", "nota")


def frames(spark, target, source):
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)


def model(target, source):
    """Row-by-row merge: (rows, inserted, updated, deleted, unchanged)."""
    text = lambda v: "" if v is None else str(v)
    old, new = {r[0]: r for r in target}, {r[0]: r for r in source}
    out, n = [], [0, 0, 0, 0]
    for k, s in new.items():
        if k not in old:
            out.append(s)
            n[0] += 1
        elif any(text(a) != text(b) for a, b in zip(old[k][1:3], s[1:3])):
            out.append(s)
            n[1] += 1
        else:
            out.append(old[k])
            n[3] += 1
    n[2] = len(old.keys() - new.keys())
    return sorted(out, key=str), n


def test_each_action(spark):
    target = [(1, 1.0, "a", "x"), (2, 2.0, "b", "x"), (3, 3.0, None, "x"), (4, 4.0, "d", "x"), (5, 5.0, "", "x")]
    source = [(1, 1.0, "a", "y"), (2, 9.0, "b", "y"), (3, 3.0, "", "y"), (4, None, "d", "y"), (6, 6.0, "f", "y")]
    t, s = frames(spark, target, source)
    actions = M.merge_actions(t, s, "id", COMPARE)
    got = {r.id: tuple(r)[1:] for r in M.merged_rows(actions).collect()}
    assert got[1] == (1.0, "a", "x"), "a change outside the compared columns is not taken over"
    assert got[2] == (9.0, "b", "y")
    assert got[3] == (3.0, None, "x"), "NULL equals the empty text"
    assert got[4] == (None, "d", "y"), "a NULL in the source overwrites"
    assert 5 not in got and got[6] == (6.0, "f", "y")
    assert tuple(M.merge_stats(actions).first()) == (1, 2, 1, 2)


def test_empty_source_changes_nothing(spark):
    t, s = frames(spark, [(1, 1.0, "a", "x")], [])
    assert M.merge_snapshot(t, s, "id", COMPARE).collect() == t.collect()


@pytest.mark.parametrize("side", ["target", "source"])
def test_duplicate_key_fails_and_is_named(spark, side):
    twice, once = [(7, 1.0, "a", "x"), (7, 2.0, "a", "x")], [(7, 1.0, "a", "x")]
    t, s = frames(spark, *((twice, once) if side == "target" else (once, twice)))
    with pytest.raises(Exception, match=f"duplicate id in {side}: 7"):
        M.merged_rows(M.merge_actions(t, s, "id", COMPARE)).collect()
    with pytest.raises(Exception, match="duplicate id"):
        M.merge_stats(M.merge_actions(t, s, "id", COMPARE)).collect()


rows = st.lists(
    st.tuples(
        st.integers(0, 12),
        st.one_of(st.none(), st.sampled_from([0.0, 1.5, 2.0])),
        st.one_of(st.none(), st.sampled_from(["", "a", "b"])),
        st.sampled_from(["x", "y"]),
    ),
    max_size=12,
    unique_by=lambda r: r[0],
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, source=rows.filter(bool))
def test_against_model(spark, target, source):
    t, s = frames(spark, target, source)
    actions = M.merge_actions(t, s, "id", COMPARE)
    want, counts = model(target, source)
    assert sorted((tuple(r) for r in M.merged_rows(actions).collect()), key=str) == want
    assert list(M.merge_stats(actions).first()) == counts


def test_merge_reuses_the_key_exchange(spark):
    t = spark.range(1000).selectExpr("id", "double(id) AS valor", "'a' AS nota", "'x' AS extra")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.merged_rows(M.merge_actions(t, t, "id", COMPARE))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_latest_history_prefers_newest(spark):
    day = dt.date(2026, 1, 31)
    rows = [(1, day, "mensal", 1, 10.0), (1, day, "mensal", 3, 30.0), (1, day, "mensal", 2, 20.0), (1, day, "diario", 1, 5.0)]
    df = spark.createDataFrame(rows, "conta_id INT, data_referencia DATE, tipo STRING, sync_timestamp INT, saldo DOUBLE")
    assert sorted(r.saldo for r in M.latest_history(df).collect()) == [5.0, 30.0]
    plan = M.latest_history(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_retention_edge(spark):
    df = spark.createDataFrame([(dt.date(2025, 2, 14),), (dt.date(2025, 2, 15),), (dt.date(2025, 2, 16),)], "sync_date DATE")
    kept = [r[0].day for r in within_retention(df, "2026-03-15").orderBy("sync_date").collect()]
    assert kept == [15, 16]


@pytest.mark.parametrize("as_of, days", [("2026-03-15", [1, 6, 11, 15]), ("2026-03-01", [1]), ("2026-03-11", [1, 6, 11])])
def test_calendar(spark, as_of, days):
    df = spark.createDataFrame([(dt.date.fromisoformat(as_of),)], "as_of DATE")
    got = M.snapshot_calendar(df).collect()
    assert [r.data_referencia.day for r in got if r.tipo == "diario"] == days
    ends = [r.data_referencia.isoformat() for r in got if r.tipo == "mensal"]
    assert ends == ["2025-09-30", "2025-10-31", "2025-11-30", "2025-12-31", "2026-01-31", "2026-02-28"]


def test_pending_skips_stored_months_only(spark):
    accounts = spark.createDataFrame([(1,), (2,)], "conta_id BIGINT")
    day = dt.date
    history = spark.createDataFrame(
        [(1, day(2026, 1, 31), "mensal"), (1, day(2026, 3, 6), "diario"), (2, day(2026, 3, 31), "mensal")],
        "conta_id BIGINT, data_referencia DATE, tipo STRING",
    )
    got = {(r.conta_id, r.data_referencia.isoformat(), r.tipo) for r in M.pending_snapshots(accounts, history, "2026-03-08").collect()}
    assert (1, "2026-01-31", "mensal") not in got and (2, "2026-01-31", "mensal") in got
    assert {(1, "2026-03-06", "diario"), (1, "2026-03-08", "diario")} <= got
    assert len(got) == 2 * (6 + 3) - 1
