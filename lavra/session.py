"""Session helpers: table access and durable intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for durable intermediates: the one that ``spark.checkpoint.dir`` names.

    Only where that setting is absent and the master is local (tests) is a temporary folder used, and deleted at the end; on a
    cluster, whose executors would not share it, that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lavra-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: its lineage ends there, and a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
