"""The exported monthly series.

The reference runs the metric at build time, writes a JSON array of
``{month: 'YYYY-MM-DD', mrr_amount: number}`` and a chart reads it back. The series
has one row per month of the window (bounded by the window length), so folding it
into one JSON document is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C

SERIES_READ_SCHEMA = "month DATE, mrr_amount DECIMAL(38,9)"


def series_document(series: DataFrame) -> DataFrame:
    """B9 (+P24): one row, one column ``json``: the month-ordered array of points."""
    point = F.struct(C.iso_month("month").alias("month"), F.col("mrr_amount").cast("double").alias("mrr_amount"))
    return series.agg(F.sort_array(F.collect_list(point)).alias("points")).select(F.to_json("points").alias("json"))


def write_series(series: DataFrame, path: str) -> None:
    """Write the document as one text file (overwrite)."""
    series_document(series).coalesce(1).write.mode("overwrite").text(path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """A10: read the document back into (month, mrr_amount) rows; an empty array gives no rows."""
    doc = spark.read.text(path)
    points = F.from_json("value", f"array<struct<month: string, mrr_amount: double>>")
    return doc.select(F.explode(points).alias("p")).select(
        F.to_date("p.month").alias("month"), F.col("p.mrr_amount").cast("decimal(38,9)").alias("mrr_amount")
    )


def labels(series: DataFrame) -> DataFrame:
    """P22 + P23 (+P24): chart labels for every point."""
    return series.select(
        "month",
        C.iso_month("month").alias("month_iso"),
        C.month_label("month").alias("month_label"),
        C.currency_label("mrr_amount", 2).alias("amount_label"),
        C.currency_label("mrr_amount", 0).alias("axis_label"),
    )


def series_min_max(series: DataFrame) -> DataFrame:
    """Smallest and largest value, first and last point of the series."""
    return series.agg(
        F.min("mrr_amount").alias("min_amount"),
        F.max("mrr_amount").alias("max_amount"),
        F.min_by("mrr_amount", "month").alias("first_amount"),
        F.max_by("mrr_amount", "month").alias("last_amount"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )
