"""Cutting lineage between the rounds of a loop."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(session: SparkSession) -> str:
    """The checkpoint folder that the cluster shares, as named in ``spark.checkpoint.dir``.

    Only on one machine, as in tests, a temporary folder is taken where it is unset;
    elsewhere that is an error, since executors can't read each other's local folders.
    """
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        shared = session.conf.get("spark.checkpoint.dir", None)
        if not shared and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="waymark-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
