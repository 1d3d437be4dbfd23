"""Session settings for tests and benchmarks, and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "spanloom", cpus: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session. On a cluster the caller brings its own session and settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches, as the session names it in ``spark.checkpoint.dir``.

    A session must name one; only a session within one process may do without, as in a notebook.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
            folder = os.path.join(tempfile.gettempdir(), "spanloom-checkpoints")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What is read several times is computed once, lost executors cost no recomputation, and readers get
    column pruning and true sizes.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
