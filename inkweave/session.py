"""Session and lineage helpers shared by every operator."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators assume (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("inkweave")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    ``spark.checkpoint.dir`` names it. Where that is unset, a local session (one machine, so any folder is
    shared) gets a folder of its own; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="inkweave-checkpoint-")
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the checkpoint folder, so that later stages survive a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
