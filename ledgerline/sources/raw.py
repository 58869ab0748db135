"""Landed ERP pages and workbook cell grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ledgerline.schemas import RAW


class IncompletePages(ValueError):
    """A page of a landed set is missing or given twice."""


def read_raw(
    spark: SparkSession,
    entity: str,
    path: str,
    list_key: str,
    page_field: str = "pagina",
    total_field: str = "total_de_paginas",
    multi_line: bool = False,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """One row per record from JSON page envelopes ``{page_field: n, list_key: [record, ...]}``.

    Adds ``_page`` and ``_pos``, the ingest order that last-wins rules need.
    ``rename`` maps field names of the landed records to ours. An envelope takes a line, or
    with ``multi_line`` a file. A page that can't be read fails the read, and a set whose
    pages are not 1 to n, n being ``total_field`` where the pages give it, raises
    ``IncompletePages``: a merge of what is left would delete the lost page's rows.
    """
    record = StructType.fromDDL(RAW[entity])
    landed = record
    if rename:
        back = {new: old for old, new in rename.items()}
        landed = StructType([StructField(back.get(f.name, f.name), f.dataType) for f in record])
    envelope = StructType([StructField(page_field, LongType()), StructField(total_field, LongType()), StructField(list_key, ArrayType(landed))])
    pages = spark.read.schema(envelope).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    number = F.col(page_field)
    seen = pages.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(number).alias("different"), F.min(number).alias("low"),
        F.max(F.greatest(number, F.col(total_field))).alias("high"),
    ).first()
    if seen["n"] and not (seen["n"] == seen["different"] == seen["high"] and seen["low"] == 1):
        raise IncompletePages(f"{entity}: {seen['n']} pages, {seen['different']} different, from {seen['low']}, expected 1 to {seen['high']}")
    rows = pages.select(F.col(page_field).alias("_page"), F.posexplode(list_key).alias("_pos", "_r"))
    return rows.select(
        *[F.col("_r").getField(src.name).alias(dst.name) for src, dst in zip(landed, record)], "_page", "_pos"
    )
