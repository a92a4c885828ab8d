"""Session helpers shared by every query."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, for checkpoints.

    It is the session's spark.checkpoint.dir. Only a local session that has none gets a folder of its own; on a
    cluster a missing setting is an error, as a folder of one machine is lost with it.
    """
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)  # noqa: SLF001
    if not known:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        known = tempfile.mkdtemp(prefix="corpusloom-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():  # noqa: SLF001
        sc.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that a lost executor costs nothing but a reading."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def freed(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that nothing refers to any more are deleted now; else they stay until the driver happens to
    collect its garbage, which a driver of many jobs and little data seldom does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of costly Python work over all tasks, also where few bytes would make few partitions."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan of fewer parts than there are tasks, spread; other scans stay as they are, without a shuffle."""
    parts = df.rdd.getNumPartitions()  # of a scan: known from the files, nothing runs
    return spread(df) if parts < df.sparkSession.sparkContext.defaultParallelism else df


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver has it, whatever folder they start in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
