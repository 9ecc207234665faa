"""Session settings that matter for these jobs."""

from __future__ import annotations

import re
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Every setting is a runtime SQL setting, so it can also be applied to a session
#: that somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One account can hold a large share of the rows: AQE splits such partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the month partitions that a job produces are replaced on write.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "abonara") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        # Static: recording the Python line of every expression costs milliseconds each,
        # and the label chains here have hundreds.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a scratch folder only where all is one process.

    The scratch folder is made once for the process; ``checkpoint()`` uses the folder too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = _scratch_folder()
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@cache
def _scratch_folder() -> str:
    return tempfile.mkdtemp(prefix="abonara-checkpoint-")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder once and read it back.

    A parquet table survives lost executors, and its readers still prune columns and push
    filters down, which a row checkpoint does not allow.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}_{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
