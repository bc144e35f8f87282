"""Session set-up and the one way lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "fundloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library expects. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the reliable folder all executors share.

    The folder is the session's own ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder; a cluster without one is an
    error, because a folder of one machine would not survive its loss.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of :func:`checkpoint`."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir", "")
        if configured:
            sc.setCheckpointDir(configured)
        elif (sc.master or "").startswith("local["):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="fundloom-checkpoint-"))
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder: what is read several times, or by some of its columns.

    The table survives the loss of executors as a checkpoint does, in a part of its space.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` into the session's full number of partitions.

    For Python work: rows that are few in bytes but long in computing would
    otherwise be coalesced into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
