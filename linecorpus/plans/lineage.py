"""Lineage cuts that survive the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only where
    that is unset and the session is local does this make a temporary one;
    elsewhere it raises, since a folder of one machine would lose data.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="linecorpus-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
