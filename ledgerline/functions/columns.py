"""Column expressions (no UDFs): everything here compiles into whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses that never activated (excluded from the metric).
NEVER_ACTIVATED = ["incomplete", "incomplete_expired"]
# Statuses admitted by the subscription flatten step.
VALID_STATUSES = ["active", "past_due", "canceled", "trialing", "incomplete"]


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- dates (P1, P2, P5, P9, P10, P11) -------------------------------------------------


def ts_to_date(ts: str | Column) -> Column:
    """``DATE(ts)``: UTC calendar date of an instant (session zone is pinned to UTC)."""
    return _c(ts).cast("date")


def nullable_ts_to_date(ts: str | Column) -> Column:
    """Date of a possibly-NULL cancel instant; NULL stays NULL."""
    return _c(ts).cast("date")


def last_day(d: str | Column) -> Column:
    return F.last_day(_c(d))


def date_add_day(d: str | Column, days: int = 1) -> Column:
    return F.date_add(_c(d), days)


def month_floor(d: str | Column) -> Column:
    return F.trunc(_c(d), "MM")


def prev_month(m: str | Column) -> Column:
    return F.add_months(month_floor(m), -1)


# --- amounts (P3, P4, P6, P7, P8, P12) ------------------------------------------------


def lower_interval(interval: str | Column) -> Column:
    return F.lower(_c(interval))


def normalize_monthly(cents: str | Column, interval: str | Column, count: str | Column) -> Column:
    """Monthly value in dollars (double): month -> cents/count/100, year -> cents/12/count/100, else NULL.

    Literals are doubles on purpose: a SQL ``12.0`` would be a DECIMAL literal in Spark.
    """
    it = lower_interval(interval)
    c = _c(cents).cast("double")
    n = _c(count).cast("double")
    return (
        F.when(it == "month", c / n / F.lit(100.0))
        .when(it == "year", c / F.lit(12.0) / n / F.lit(100.0))
        .otherwise(F.lit(None).cast("double"))
    )


def monthly_divisor(interval: str | Column, count: str | Column) -> Column:
    """Exact divisor turning cents into monthly dollars: 100*count (month) or 1200*count (year)."""
    it = lower_interval(interval)
    n = _c(count).cast("bigint")
    return F.when(it == "month", n * 100).when(it == "year", n * 1200).otherwise(F.lit(None).cast("bigint"))


def coalesce_zero(x: str | Column) -> Column:
    return F.coalesce(_c(x), F.lit(0.0))


def cast_numeric(x: str | Column) -> Column:
    """FLOAT64 -> NUMERIC: decimal(38,9)."""
    return _c(x).cast("decimal(38,9)")


def round_cents(x: str | Column) -> Column:
    return F.round(_c(x), 2)


def to_cents_decimal(x: str | Column) -> Column:
    """Money as reported by the registered queries: rounded to the cent, decimal(18,2)."""
    return F.round(_c(x), 2).cast("decimal(18,2)")


def cast_int(x: str | Column) -> Column:
    return _c(x).cast("bigint")


# --- parsing of raw objects (P13-P18) ---------------------------------------------------


def epoch_to_ts(x: str | Column) -> Column:
    """Unix seconds (number or numeric text) or ISO text -> TIMESTAMP; anything else -> NULL."""
    s = F.trim(_c(x).cast("string"))
    seconds = s.try_cast("bigint")
    # Years 1 to 9999; other numbers are as unusable as text that is no time.
    as_epoch = F.timestamp_seconds(F.when(seconds.between(-62135596800, 253402300799), seconds))
    as_text = F.try_to_timestamp(s)
    return F.coalesce(as_epoch, as_text)


def metadata_json(m: str | Column) -> Column:
    """JSON text of a metadata map; empty or absent map -> NULL."""
    m = _c(m)
    return F.when(F.size(m) > 0, F.to_json(m))


def metadata_get(m: str | Column, key: str) -> Column:
    return _c(m).getItem(key)


def json_get(text: str | Column, key: str) -> Column:
    """Key lookup in JSON text (metadata after encoding, event props)."""
    path = f"$.{key}" if key.isidentifier() else f"$['{key}']"
    return F.get_json_object(_c(text), path)


def first_item_price(items: str | Column) -> Column:
    """``items.data[0].price``; NULL when the list is empty or any level is missing."""
    return F.try_element_at(_c(items).getField("data"), F.lit(1)).getField("price")


# --- labels and ids (P22-P27) --------------------------------------------------------------


def month_label(m: str | Column) -> Column:
    return F.date_format(_c(m), "MMM yyyy")


def currency_label(x: str | Column, decimals: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(x).cast("double"), decimals))


def iso_month(m: str | Column) -> Column:
    return F.date_format(_c(m), "yyyy-MM-dd")


def seed_email(idx: str | Column) -> Column:
    return F.format_string("mrr-seed-%03d@example.com", _c(idx) + 1)


def seed_name(idx: str | Column) -> Column:
    return F.format_string("Test Customer %03d", _c(idx) + 1)


def seed_idempotency_key(customer_id: str | Column, version: int) -> Column:
    return F.concat(F.lit("seed-sub-"), _c(customer_id), F.lit(f"-v{version}"))


def batch_index(idx: str | Column, size: int = 3) -> Column:
    return F.floor(_c(idx) / F.lit(size)).cast("bigint")


def batch_count(n: str | Column, size: int = 3) -> Column:
    """Number of groups of ``size`` needed for ``n`` items (ceiling division)."""
    return F.floor((_c(n) + F.lit(size - 1)) / F.lit(size)).cast("bigint")


def pct_floor(count: str | Column, total: str | Column) -> Column:
    """Integer floor percentage; 0 when the denominator is 0."""
    c, n = _c(count).cast("bigint"), _c(total).cast("bigint")
    return F.when(n > 0, F.floor(c * 100 / n).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
