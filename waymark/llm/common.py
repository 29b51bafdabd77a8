"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids fall in fold of the empty text."""
    text = F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(parts)).cast("int")


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts (in ``column``) are about ``most`` bytes, a longer text alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a, done = 0, 0
        while a < len(ends):
            z = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(a, z - a)
            a, done = z, int(ends[z - 1])


def checkpoint_folder(session: SparkSession) -> str:
    """The checkpoint folder that the cluster shares, as named in ``spark.checkpoint.dir``.

    Only on one machine, as in tests, a temporary folder is taken where it is unset;
    elsewhere that is an error, since executors can't read each other's local folders.
    """
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        shared = session.conf.get("spark.checkpoint.dir", None)
        if not shared and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="waymark-checkpoint-"))
    return context.getCheckpointDir()


def release(session: SparkSession) -> None:
    """Let Spark delete shuffle and checkpoint files that nothing refers to any more; it learns of them by the driver's garbage collection alone."""
    gc.collect()
    session.sparkContext._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame, rows: int, each: int = 20_000) -> DataFrame:
    """``df``, of about ``rows`` rows, in no more partitions than cores or than these rows need, so that a small table doesn't cost a task for every shuffle partition."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names as wanted, with underscores added until none clashes with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names
