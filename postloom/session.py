"""Session factory with the settings the library is written for."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: What every operator relies on: UTC timestamps, adaptive execution with skew handling, last-wins map merges.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "postloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` overrides them (keys with ``__`` for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_ready(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a session whose executors are threads of this process
    (master ``local``, as in tests) gets a folder of its own where nothing is set; elsewhere that is refused, because a folder of
    one machine would be lost to the others.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="postloom-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, and the shuffle files behind it removed.

    Otherwise those files stay until the driver happens to collect its garbage. Should ``df`` itself be used again, it is computed anew.
    """
    done = df.checkpoint()
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return done
