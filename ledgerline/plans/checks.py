"""Metamorphic checks of the metric (C1-C3) and of the plan generator.

Each check returns one row per checked item with boolean verdicts, so a caller can
``where(~ok)`` for violations; nothing is collected in the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import metric, reconcile


def _cents(c):
    return F.round(c, 2)


def check_cancel_month(subs: DataFrame, start, end, series: DataFrame | None = None) -> DataFrame:
    """A canceled subscription counts in the month before its cancel month, not in it.

    For every candidate (canceled, cancel month and the month before inside the window,
    monthly amount defined): MRR(prev) == MRR(prev without it) + C and
    MRR(cancel) == MRR(cancel without it), compared to the cent. MRR is ``series`` (default:
    G1); what the others make is taken from the swept totals, which G1 has no part in. The
    two months are joined side by side, so no subscription is grouped back.
    """
    months = reconcile.swept_and_series(subs, start, end, series)
    cand = reconcile.cancel_candidates(subs, start, end).where(F.col("contribution").isNotNull())
    cand = cand.withColumn("prev_month", C.prev_month("cancel_month"))
    prev = months.select(F.col("month").alias("prev_month"), F.col("total").alias("total_prev"), F.col("mrr_strict").alias("mrr_prev"))
    at = months.select(F.col("month").alias("cancel_month"), F.col("total").alias("total_at"), F.col("mrr_strict").alias("mrr_at"))
    excl_prev = F.col("total_prev") - reconcile.own_in(F.col("prev_month"))
    excl_at = F.col("total_at") - reconcile.own_in(F.col("cancel_month"))
    return cand.join(prev, "prev_month").join(at, "cancel_month").select(
        "stripe_subscription_id",
        "cancel_month",
        "contribution",
        F.coalesce(_cents("mrr_prev") == _cents(excl_prev + F.col("contribution")), F.lit(False)).alias("prev_ok"),
        F.coalesce(_cents("mrr_at") == _cents(excl_at), F.lit(False)).alias("cancel_ok"),
    )


def check_tier_change(subs: DataFrame, start, end, series: DataFrame | None = None) -> DataFrame:
    """In the transition month only v1 counts: MRR(M) == excl + c1 and != excl + c0 + c1.

    MRR is ``series`` (default: G1), excl comes from the swept totals, as in C1.
    """
    pairs = reconcile.excluding_pair(subs, start, end, reconcile.swept_and_series(subs, start, end, series))
    c0 = F.coalesce("c0", F.lit(0))
    c1 = F.coalesce("c1", F.lit(0))
    return pairs.select(
        "v0_sub_id",
        "v1_sub_id",
        "month",
        F.coalesce(_cents("mrr_strict") == _cents(F.col("mrr_excluding_pair") + c1), F.lit(False)).alias("v1_only_ok"),
        F.coalesce(_cents("mrr_strict") != _cents(F.col("mrr_excluding_pair") + c0 + c1), F.lit(False)).alias(
            "no_double_count"
        ),
    )


def check_total_reconciles(subs: DataFrame, start, end, series: DataFrame | None = None) -> DataFrame:
    """The sum of the monthly series equals the one-pass window total and the sum of the
    swept totals (to the cent).

    The one-row aggregates are stacked with a union and folded by one global aggregate, so
    no join is needed to put them side by side.
    """
    series = metric.mrr_monthly(subs, start, end) if series is None else series
    parts = [
        series.select(F.lit("series").alias("src"), F.col("mrr_amount").cast("decimal(38,9)").alias("v")),
        metric.mrr_window_total(subs, start, end).select(F.lit("total").alias("src"), F.col("window_total").alias("v")),
        reconcile.swept_totals(subs, start, end).select(F.lit("swept").alias("src"), F.col("total").cast("decimal(38,9)").alias("v")),
    ]

    def total(src: str):
        return _cents(F.sum(F.when(F.col("src") == src, F.col("v")))).cast("decimal(18,2)")

    folded = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        total("series").alias("months_sum"), total("total").alias("window_total"), total("swept").alias("swept")
    )
    same = (F.col("months_sum") == F.col("window_total")) & (F.col("months_sum") == F.col("swept"))
    return folded.select("months_sum", "window_total", F.coalesce(same, F.lit(False)).alias("reconciles"))
