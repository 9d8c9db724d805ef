"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

#: Word separators of the contracts: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so that a lost
    executor never recomputes what is above, and two readers share one computation."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def payload(text: str | Column, name: str = "_bytes") -> Column:
    """UTF-8 bytes of a text column; a null text is empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("binary"), F.lit(b"")).alias(name)


#: Arrow batches handed to Python: rows and bytes at most (one longer text is a batch alone).
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, for ``mapInArrow``: whole texts go to Python, so batches are kept small."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def map_batches(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], dict[str, list]], schema: str, setup: Callable | None = None
) -> DataFrame:
    """``mapInArrow`` of a function from one batch to columns. ``setup`` runs once a task and
    its value is passed as second argument."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (setup(),) if setup else ()
        for batch in batches:
            if batch.num_rows:
                out = per_batch(batch, *state)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c := out[f.name], pa.Array) else pa.array(c, type=f.type) for f in arrow], schema=arrow
                    )

    return in_small_batches(df).mapInArrow(run, schema)


def replaced(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` with the named columns replaced, all in one select, in their old order."""
    return docs.select(*[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns])
