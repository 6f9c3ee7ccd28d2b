"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "colloquy", checkpoint_dir: str | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    ``checkpoint_dir`` becomes ``spark.checkpoint.dir``; without it the first lineage cut
    makes a temporary folder, which only a local session may do.
    """
    builder = SparkSession.builder if checkpoint_dir is None else SparkSession.builder.config(
        "spark.checkpoint.dir", checkpoint_dir
    )
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="colloquy-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder and read it from there.

    The folder is the shared one named in ``spark.checkpoint.dir``, so the data
    outlives any executor. Only a local session without one gets a new folder.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate files, in the same shared folder as checkpoints."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
