"""Run log: freshness, failures and last status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sync_health(log: DataFrame, now: Column) -> DataFrame:
    """Whole hours since the last finished and the last successful run, failures in seven days, traffic light."""
    week = (F.col("status") == "failed") & (F.col("started_at") > now - F.expr("INTERVAL 7 DAYS"))
    g = log.agg(
        F.max("finished_at").alias("_fin"),
        F.max(F.when(F.col("status") == "success", F.col("finished_at"))).alias("_ok"),
        F.count_if(week).alias("falhas_7_dias"),
    )
    hours = lambda c: F.timestamp_diff("HOUR", F.col(c), now)
    g = g.select(
        hours("_fin").alias("horas_desde_fim"), hours("_ok").alias("horas_desde_sucesso"), "falhas_7_dias"
    )
    return g.withColumn("luz", light(F.col("horas_desde_fim"), F.col("falhas_7_dias")))


def light(hours: Column, failures: Column) -> Column:
    """Red beyond 24 h or with two failures (or without any run), yellow from 8 h, else green."""
    return (
        F.when(hours.isNull() | (hours > 24) | (failures >= 2), "vermelho").when(hours >= 8, "amarelo").otherwise("verde")
    )


def last_status(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("started_at"), F.desc("sync_id")).limit(1)


def latest_events(log: DataFrame) -> DataFrame:
    """Newest event of every run: finished events beat the running one."""
    w = Window.partitionBy("sync_id").orderBy(F.col("finished_at").desc_nulls_last(), F.desc("started_at"))
    return log.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
