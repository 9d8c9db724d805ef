"""Warehouse tables: create, upsert by key, change feed, truncate, bookmarks.

Tables are versioned folders (see ``versions``): parquet, partitioned by creation month and
clustered by the primary key inside a month. An upsert writes the months it touches into a
new commit folder with one job, and then moves the table to the next version in one step.
No session setting is changed, nothing is overwritten in place, and a reader never sees a
mix of two versions.

The merge joins the staged source, dealt to the table's buckets, with the touched months of
the table: the table's side is read bucket by bucket and not shuffled. The same job finds
for every row whether it was inserted, updated, unchanged or stale, and keeps with a changed
row its old image; ``changes`` reads these back as the change feed of a version.

A batch that is replayed finds the version it published and reports that version's counts.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.flatten import PRIMARY_KEYS, ts_literal
from ledgerline.schemas import TABLE_DDL, VERSION_ORDER, WATERMARK_TABLE
from ledgerline.session import checkpoint_dir
from ledgerline.sinks import versions
from ledgerline.sinks.versions import Version

# Partition grain: the creation month. The reference partitions by day; with years of
# history that is thousands of partitions and small files. Months keep the count in the
# hundreds, and a month is cut further into the table's buckets.
PARTITION_COLUMN = "created_month"
WATERMARK_DDL = "last_synced_at TIMESTAMP, sync_key STRING"

#: Columns beside those of the schema, hidden by the view: what orders versions of a key
#: (smaller is newer), and for rows that the latest commit of their month changed, how.
ORDER = "_order"
ORDER_TYPE = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in VERSION_ORDER.items()) + ">"
OP, BEFORE = "_op", "_before"
#: The old image is one JSON column: a file per month and bucket pays for each column it has.
IMAGE = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
COUNTED = ["inserted", "updated", "unchanged", "stale"]

#: Rows of a bucket, over all months, beyond which a merge deals the table to more buckets: a
#: task of the merge holds and sorts one bucket.
ROWS_A_BUCKET = 500_000

#: A commit that others overtake starts again so often.
ATTEMPTS = 10


@dataclass(frozen=True)
class Warehouse:
    """A database name, the shared folder its tables live in, and the buckets that a new table's
    months are cut into at least: a merge raises them as the table grows (``buckets_for``)."""

    database: str
    root: str
    buckets: int = 4

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def location(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _stored_ddl(name: str) -> str:
    return f"{TABLE_DDL[name]}, {ORDER} {ORDER_TYPE}, {OP} STRING, {BEFORE} STRING"


def schema_columns(name: str) -> list[str]:
    return [c.split()[0].strip("`") for c in TABLE_DDL[name].split(", ")]


def ensure_database(spark: SparkSession, wh: Warehouse) -> None:
    """B1: create the database if absent (idempotent)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {wh.database} LOCATION '{wh.root}'")


def ensure_tables(spark: SparkSession, wh: Warehouse) -> None:
    """B2: create the three entity tables and the bookmark table if absent, and show their
    current versions in the catalog (a folder that exists already keeps its rows)."""
    ensure_database(spark, wh)
    for name in [*TABLE_DDL, WATERMARK_TABLE]:
        if versions.current(spark, wh.location(name)) is None:
            versions.publish(spark, wh.location(name), Version(0, buckets=wh.buckets))
        attach(spark, wh, name)


def attach(spark: SparkSession, wh: Warehouse, name: str, at: Version | None = None) -> str:
    """Show the current version under the table's name; returns the name of that version's table."""
    at = at or versions.current(spark, wh.location(name))
    if name == WATERMARK_TABLE:
        return versions.attach(spark, wh.table(name), wh.location(name), WATERMARK_DDL, None, None, ["sync_key", "last_synced_at"], at)
    shown = [*schema_columns(name), PARTITION_COLUMN]
    return versions.attach(spark, wh.table(name), wh.location(name), _stored_ddl(name), PARTITION_COLUMN, PRIMARY_KEYS[name], shown, at)


def read(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame:
    """The table as its newest version has it, whoever published that."""
    attach(spark, wh, name)
    return spark.table(wh.table(name))


def version(spark: SparkSession, wh: Warehouse, name: str, number: int) -> Version:
    """A version by its number (0: the empty table)."""
    return versions.version(spark, wh.location(name), number)


def table_schema(spark: SparkSession, wh: Warehouse, name: str) -> T.StructType:
    """The target's column list, read from the catalog."""
    return spark.table(wh.table(name)).schema


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a batch to the target schema; missing columns become NULL, extra ones are dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.trunc(F.col("created_at").cast("date"), "MM"))


def stage_root(spark: SparkSession, name: str, batch_id: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-stage/{name}/{batch_id}"


def discard_stage(spark: SparkSession, root: str) -> None:
    """Delete a batch's staged source once its version is published (the reference drops its
    staging table too). Only paths under this module's stage folder are ever removed."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-stage/"
    if not root.startswith(base) or root.rstrip("/") == base.rstrip("/"):
        raise ValueError(f"refusing to delete {root!r}: not a stage folder")
    versions.delete(spark, root)


def stage_source(spark: SparkSession, wh: Warehouse, name: str, rows: DataFrame, root: str) -> str:
    """Write a batch in the table's schema (missing columns NULL, extra ones dropped) to its stage."""
    schema = T.StructType([f for f in table_schema(spark, wh, name).fields if f.name != PARTITION_COLUMN])
    ordered = T.StructType([*schema.fields, *T.StructType.fromDDL(f"{ORDER} {ORDER_TYPE}").fields])
    with_partition(align_to_schema(rows, ordered)).write.mode("overwrite").parquet(f"{root}/source")
    return f"{root}/source"


def upsert(
    spark: SparkSession,
    wh: Warehouse,
    name: str,
    rows: DataFrame,
    pk: str,
    batch_id: str | None = None,
) -> dict[str, int]:
    """B4 + B5: MERGE ``rows`` into table ``name`` on ``pk``; returns inserted / updated counts.

    ``rows`` must be unique on ``pk`` and fill the required columns, else nothing is
    written (ValueError). Matched target rows are replaced whole (unless the row carries an
    ``_order`` and the table holds a newer one), unmatched source rows inserted, other rows
    untouched. Keys alone match: a key whose creation month changed leaves its old month.
    ``last_counts`` has the finer counts, ``changes`` the changed rows.
    """
    done = versions.of_batch(spark, wh.location(name), batch_id) if batch_id else None
    if done is None:
        root = stage_root(spark, name, batch_id or uuid.uuid4().hex)
        done = merge(spark, wh, name, stage_source(spark, wh, name, rows, root), pk, batch_id)
        discard_stage(spark, root)
    return {k: done.counts[k] for k in ("inserted", "updated")}


def last_counts(spark: SparkSession, wh: Warehouse, name: str) -> dict[str, int]:
    """Counts of the newest version: inserted, updated (of these unchanged), stale."""
    return versions.current(spark, wh.location(name)).counts


def validate_source(source: DataFrame, name: str, pk: str) -> int:
    """Stop before anything is written when keys repeat or a required column is empty; returns the rows."""
    required = re.findall(r"(\w+) \w+ NOT NULL", TABLE_DDL[name])
    empty = F.sum(F.greatest(*[F.col(c).isNull().cast("long") for c in required])).alias("empty")
    per_key = source.groupBy(pk).agg(F.count(F.lit(1)).alias("n"), empty)
    got = per_key.agg(F.count(F.when(F.col("n") > 1, 1)).alias("repeated"), F.sum("empty").alias("empty"), F.sum("n").alias("rows")).first()
    if got["repeated"]:
        raise ValueError(f"{name}: {got['repeated']} keys occur more than once in the source")
    if got["empty"]:
        raise ValueError(f"{name}: {got['empty']} rows lack a required column ({', '.join(required)})")
    return got["rows"] or 0


def buckets_for(base: Version, rows: int) -> int:
    """Buckets of the version after ``base``, which will hold ``rows``: those of ``base`` while
    they do, else twice as many at least, so that a growing table is seldom dealt anew."""
    needed = -(-rows // ROWS_A_BUCKET)
    if needed <= base.buckets:
        return base.buckets
    return max(needed, 2 * base.buckets) if base.months else needed


def merge(spark: SparkSession, wh: Warehouse, name: str, source_path: str, pk: str, batch_id: str | None = None,
          source_filter: Column | None = None, also: dict[str, int] | None = None) -> Version:
    """Merge a staged source and publish the result; starts again when another writer was first.
    ``also`` are counts of the caller's that the version keeps for a replay."""
    source = spark.read.parquet(source_path)
    if source_filter is not None:
        source = source.where(source_filter)
    arriving = validate_source(source, name, pk)
    for _ in range(ATTEMPTS):
        base = versions.current(spark, wh.location(name))
        commit = f"c{uuid.uuid4().hex[:12]}"
        new = merged_version(spark, wh, name, source, pk, base, commit, batch_id, arriving)
        new = dataclasses.replace(new, counts=new.counts | (also or {}))
        if versions.publish(spark, wh.location(name), new):
            attach(spark, wh, name, new)
            return new
        versions.delete(spark, f"{wh.location(name)}/data/{commit}")
    raise RuntimeError(f"{name}: {ATTEMPTS} commits in a row were overtaken by other writers")


def touched_months(source: DataFrame, target: DataFrame | None, pk: str) -> DataFrame:
    """(month, matched) of a staged source and of the target rows its keys match, with the number
    of these rows: a row a month at most. The target's side reads its key and month columns only."""
    months = source.select(PARTITION_COLUMN).distinct().withColumn("matched", F.lit(0).cast("bigint"))
    if target is None:
        return months
    old = target.select(pk, PARTITION_COLUMN).join(source.select(pk), pk, "left_semi")
    matched = old.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("matched"))
    return months.unionByName(matched).groupBy(PARTITION_COLUMN).agg(F.sum("matched").alias("matched"))


def merge_rows(target: DataFrame | None, source: DataFrame, pk: str, columns: list[str], buckets: int, dealt_anew: bool = False) -> DataFrame:
    """The touched months after the merge, with ``_outcome`` (kept or one of COUNTED), ``_op``
    and ``_before``. Only the source is shuffled: to the table's buckets (and the target, where
    the table is ``dealt_anew`` to more of them). A table without rows (None) is not joined.

    A partition of the result is a bucket: a file for each of its months is all that it writes.
    So the columns are packed above the exchanges; a join right above two exchanges would have
    Spark deal both sides to ``spark.sql.shuffle.partitions`` where that is more than the buckets.
    """
    held = [*columns, ORDER, PARTITION_COLUMN]
    dealt = source.select(*held).repartition(buckets, pk)
    if target is None:
        return dealt.select(
            *held, F.lit("inserted").alias(OP), F.lit(None).cast("string").alias(BEFORE), F.lit("inserted").alias("_outcome"))
    old = target.select(*held)
    if dealt_anew:
        old = old.repartition(buckets, pk)
    old = old.select(F.col(pk).alias("_key"), F.struct(*held).alias("_old"))
    new = dealt.select(F.col(pk).alias("_key"), F.struct(*held).alias("_new"))
    both = old.join(new, "_key", "full_outer")
    compared = [c for c in columns if c != "synced_at"]
    same = F.struct(*[F.col(f"_old.{c}") for c in compared]).eqNullSafe(F.struct(*[F.col(f"_new.{c}") for c in compared]))
    stale = F.coalesce(F.col(f"_new.{ORDER}") > F.col(f"_old.{ORDER}"), F.lit(False))
    outcome = (
        F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "inserted").when(stale, "stale")
        .when(same, "unchanged").otherwise("updated")
    )
    from_old = F.col("_outcome").isin("kept", "stale")
    changed = F.col("_outcome").isin("inserted", "updated")
    marked = both.withColumn("_outcome", outcome)
    return marked.select(
        *[F.when(from_old, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c) for c in held],
        F.when(changed, F.col("_outcome")).alias(OP),
        F.when(F.col("_outcome") == "updated", F.to_json(F.struct(*[F.col(f"_old.{c}").alias(c) for c in columns]), IMAGE)).alias(BEFORE),
        "_outcome",
    )


def merged_version(spark: SparkSession, wh: Warehouse, name: str, source: DataFrame, pk: str, base: Version, commit: str,
                   batch_id: str | None, arriving: int) -> Version:
    """Write the months that ``source`` (of ``arriving`` rows) touches under ``commit``, or all of
    them where the table needs more buckets; returns the version that takes them over."""
    target = spark.table(attach(spark, wh, name, base)) if base.months else None
    found = touched_months(source, target, pk).collect()
    touched = [r[0] for r in found]
    held = target.count() if touched and target is not None else 0
    buckets = buckets_for(base, held + arriving - sum(r["matched"] for r in found)) if touched else base.buckets
    dealt_anew = buckets != base.buckets
    if dealt_anew:
        touched = sorted({*touched, *map(dt.date.fromisoformat, base.months)})
    counts = dict.fromkeys(COUNTED, 0)
    months = dict(base.months)
    if touched:
        if target is not None:
            target = target.where(F.col(PARTITION_COLUMN).isin(*touched))  # static: prunes the scan
        rows = merge_rows(target, source, pk, schema_columns(name), buckets, dealt_anew)
        seen = Observation(f"merge_{name}_{commit}")
        outcome = F.col("_outcome")
        counted = rows.observe(seen, *[F.count(F.when(outcome == c, 1)).alias(c) for c in COUNTED])
        written = versions.write_commit(
            spark, counted, wh.table(name), wh.location(name), _stored_ddl(name), PARTITION_COLUMN, pk, buckets, commit
        )
        counts = {c: int(seen.get.get(c, 0)) for c in COUNTED}
        counts["updated"] += counts["unchanged"]
        for month in touched:  # a month whose rows all moved away has no folder any more
            months.pop(str(month), None)
        months |= dict.fromkeys(written, commit)
    return Version(base.number + 1, months, buckets, "merged", commit if touched else None, batch_id, counts)


def changes(spark: SparkSession, wh: Warehouse, name: str, number: int | None = None) -> DataFrame:
    """B5 row by row: (op, before, after) of the version ``number`` (default: the newest).

    ``op`` is ``inserted`` (``before`` is null) or ``updated``; rows equal to their old image
    but for ``synced_at`` are not changes. Only the version's own commit is read. A version
    that truncated the table has no rows here: its ``kind`` says so.
    """
    location = wh.location(name)
    at = versions.current(spark, location) if number is None else versions.version(spark, location, number)
    columns, image = schema_columns(name), T.StructType.fromDDL(re.sub(r" NOT NULL", "", TABLE_DDL[name]))
    schema = T.StructType.fromDDL(re.sub(r" NOT NULL", "", _stored_ddl(name)))
    if at.commit is None or at.kind != "merged":
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).parquet(f"{location}/data/{at.commit}")
    return rows.where(F.col(OP).isNotNull()).select(F.col(OP).alias("op"), F.from_json(BEFORE, image, IMAGE).alias("before"), F.struct(*columns).alias("after"))


def truncate_table(spark: SparkSession, wh: Warehouse, name: str) -> None:
    """Remove every row (full refresh): a version without folders."""
    for _ in range(ATTEMPTS):
        base = versions.current(spark, wh.location(name))
        new = Version(base.number + 1, {}, base.buckets, "truncated")
        if versions.publish(spark, wh.location(name), new):
            attach(spark, wh, name, new)
            return
    raise RuntimeError(f"{name}: {ATTEMPTS} commits in a row were overtaken by other writers")


def watermark_read(spark: SparkSession, wh: Warehouse, sync_key: str) -> dt.datetime | None:
    """Last successful sync time for ``sync_key``; None when there is none."""
    rows = read(spark, wh, WATERMARK_TABLE).where(F.col("sync_key") == F.lit(sync_key)).select("last_synced_at").limit(1).collect()
    return rows[0][0] if rows else None


def watermark_write(spark: SparkSession, wh: Warehouse, sync_key: str, ts: dt.datetime) -> None:
    """Set one bookmark."""
    row = spark.range(1).select(ts_literal(ts).alias("last_synced_at"), F.lit(sync_key).alias("sync_key"))
    write_watermarks(spark, wh, row)


def write_watermarks(spark: SparkSession, wh: Warehouse, rows: DataFrame) -> None:
    """B7 for any number of keys at once: ``rows`` has (sync_key, last_synced_at), one row per key.

    All bookmarks move together, in one version. Values stay Spark timestamps end to end (no
    trip through driver-side datetimes).
    """
    location = wh.location(WATERMARK_TABLE)
    rows = rows.select(F.col("last_synced_at").cast("timestamp").alias("last_synced_at"), "sync_key")
    for _ in range(ATTEMPTS):
        base = versions.current(spark, location)
        commit = f"c{uuid.uuid4().hex[:12]}"
        kept = spark.table(attach(spark, wh, WATERMARK_TABLE, base)).join(rows.select("sync_key"), "sync_key", "left_anti")
        kept.select(*rows.columns).unionByName(rows).coalesce(1).write.parquet(f"{location}/data/{commit}")  # a row a key
        new = Version(base.number + 1, {"all": commit}, kind="replaced", commit=commit)
        if versions.publish(spark, location, new):
            attach(spark, wh, WATERMARK_TABLE, new)
            return
        versions.delete(spark, f"{location}/data/{commit}")
    raise RuntimeError(f"{WATERMARK_TABLE}: {ATTEMPTS} commits in a row were overtaken by other writers")


def watermarks(spark: SparkSession, wh: Warehouse, keys: list[str]) -> DataFrame:
    """A9 as a DataFrame: (sync_key, last_synced_at) for the asked keys, NULL where none is set."""
    asked = spark.createDataFrame([(k,) for k in keys], "sync_key string")
    return asked.join(read(spark, wh, WATERMARK_TABLE), "sync_key", "left")


def watermark_reset(spark: SparkSession, wh: Warehouse) -> None:
    """Clear all bookmarks."""
    truncate_table(spark, wh, WATERMARK_TABLE)


def dry_run(df: DataFrame) -> int:
    """Run the whole read/transform, write nothing, return the row count.

    The ``noop`` sink executes the plan fully; the count comes from an observation of
    the same job, so there is no second pass.
    """
    obs = Observation(f"dry_run_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return int(obs.get.get("rows", 0))
