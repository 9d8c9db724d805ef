"""Batch sync (entry point E2): raw listings -> flat tables, upserted, then bookmarks.

Per entity, in order customers -> subscriptions -> invoices:
  1. parse + load rules (live mode, items, cross-listing de-duplication; of the invoices
     listed by customer, those of known customers),
  2. flatten; every row is staged once with its reject reason as a column, while an
     observation of that same job counts fetched rows and rejects per reason,
  3. accepted rows (reason ``accepted``) are merged into the table.
An entity that fails counts as an error and leaves its table as it was; the others go on.
Bookmarks move only for entities whose merge was published. ``dry_run`` runs 1-2 into the
``noop`` sink. A run that is started again with its run time and files finds what it has
published already and reports the same counts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import flatten
from ledgerline.sinks import tables, versions
from ledgerline.sources import raw

LOADERS = {
    "customers": (raw.load_customers, flatten.flatten_customers),
    "subscriptions": (raw.load_subscriptions, flatten.flatten_subscriptions),
    "invoices": (raw.load_invoices, flatten.flatten_invoices),
}
ENTITY_ORDER = ["customers", "subscriptions", "invoices"]
REASONS = ["not_json", "invalid_status", "bad_created", "missing_required"]
ACCEPTED = "accepted"  # stage partition value of rows that load

SUMMARY_SCHEMA = "entity string, fetched bigint, inserted bigint, updated bigint, rejected bigint, errors bigint, error string"


def _observed_flat(flat: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("fetched")]
    metrics += [F.count(F.when(F.col("reject_reason") == r, 1)).alias(r) for r in REASONS]
    return flat.observe(obs, *metrics), obs


def _loaded(got: dict) -> dict[str, int]:
    return {"fetched": got["fetched"], "rejected": sum(got[r] for r in REASONS)}


def sync_entity(spark: SparkSession, wh: tables.Warehouse, entity: str, listing: DataFrame, run_ts: dt.datetime,
                batch_id: str, dry_run: bool = False) -> dict[str, int]:
    """Load one entity; a batch that was published before reports its counts and does nothing."""
    load, flat_fn = LOADERS[entity]
    observed, obs = _observed_flat(flat_fn(load(listing), run_ts), f"sync_{entity}_{uuid.uuid4().hex[:8]}")
    pk = flatten.PRIMARY_KEYS[entity]
    if dry_run:
        observed.write.format("noop").mode("overwrite").save()
        return _loaded(obs.get) | {"inserted": 0, "updated": 0}
    done = versions.of_batch(spark, wh.location(entity), batch_id)
    if done is None:
        root = tables.stage_root(spark, entity, batch_id)
        staged = tables.with_partition(observed).withColumn("reject_reason", F.coalesce("reject_reason", F.lit(ACCEPTED)))
        if tables.ORDER not in staged.columns:
            staged = staged.withColumn(tables.ORDER, F.lit(None).cast(tables.ORDER_TYPE))
        # one file set with the reason as a column (a partitioned write would sort every
        # task's rows by reason first); the merge reads it back with a filter on the reason
        staged.write.mode("overwrite").parquet(f"{root}/source")
        # the rejected rows (a small share) are kept next to the tables
        spark.read.parquet(f"{root}/source").where(F.col("reject_reason") != ACCEPTED).write.mode("overwrite").parquet(
            rejects_path(wh, entity, batch_id)
        )
        done = tables.merge(spark, wh, entity, f"{root}/source", pk, batch_id, F.col("reject_reason") == ACCEPTED, _loaded(obs.get))
        tables.discard_stage(spark, root)
    return {k: done.counts[k] for k in ("fetched", "inserted", "updated", "rejected")}


def rejects_path(wh: tables.Warehouse, entity: str, batch_id: str) -> str:
    return f"{wh.location('_rejects')}/{entity}/{batch_id}"


def rejects(spark: SparkSession, wh: tables.Warehouse, entity: str, batch_id: str) -> DataFrame:
    """F8 side table of one run: the rows that were kept out, with their reason and, of lines
    that are not JSON, the line."""
    return spark.read.parquet(rejects_path(wh, entity, batch_id))


def batch_of(listings: dict[str, DataFrame], run_ts: dt.datetime) -> str:
    """The same for the same files and run time; a listing without files makes it unique."""
    files = [f for e in sorted(listings) for f in [e, *sorted(listings[e].inputFiles())]]
    if len(files) == len(listings):
        files.append(uuid.uuid4().hex)
    return f"sync-{run_ts:%Y%m%dT%H%M%S}-{hashlib.sha1('|'.join(files).encode()).hexdigest()[:12]}"


def sync(spark: SparkSession, wh: tables.Warehouse, listings: dict[str, DataFrame], run_ts: dt.datetime | None = None,
         full_refresh: bool = False, dry_run: bool = False, batch_id: str | None = None) -> DataFrame:
    """Run E2 and return G16's summary rows (one per entity plus ``total``)."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    batch_id = batch_id or batch_of(listings, run_ts)
    started = time.time()
    if not dry_run:
        tables.ensure_tables(spark, wh)
        if full_refresh:
            for entity in ENTITY_ORDER:
                if versions.of_batch(spark, wh.location(entity), batch_id) is None:
                    tables.truncate_table(spark, wh, entity)
            tables.watermark_reset(spark, wh)
    rows, done = [], []
    for entity in ENTITY_ORDER:
        if entity not in listings:
            continue
        try:
            listing = listings[entity]
            if entity == "invoices" and not dry_run:
                listing = raw.of_known_customers(listing, tables.read(spark, wh, "customers"), "stripe_customer_id")
            s = sync_entity(spark, wh, entity, listing, run_ts, batch_id, dry_run)
            rows.append((entity, s["fetched"], s["inserted"], s["updated"], s["rejected"], 0, None))
            done.append(entity)
        except (ValueError, PySparkException, RuntimeError) as e:
            rows.append((entity, 0, 0, 0, 0, 1, f"{type(e).__name__}: {e}"[:1000]))
    if done and not dry_run:
        stamp = flatten.ts_literal(run_ts)
        tables.write_watermarks(
            spark, wh, spark.createDataFrame([(e,) for e in done], "sync_key string").select(stamp.alias("last_synced_at"), "sync_key")
        )
    totals = tuple(sum(r[i] for r in rows) for i in range(1, 6))
    rows.append(("total", *totals, None))
    summary = spark.createDataFrame(rows, SUMMARY_SCHEMA)
    return summary.withColumn("duration_s", F.lit(round(time.time() - started, 3)))
