"""Page records as they arrive: each micro-batch replaces the records of its leaves if it is newer (keyed upsert)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def current(pages: DataFrame) -> DataFrame:
    """One record per leaf: the latest, of equal times the one whose body sorts last."""
    return pages.groupBy("leaf").agg(F.max(F.struct("written_at", "body")).alias("x")).select("leaf", "x.written_at", "x.body")


def _versions(spark: SparkSession, target: str, kind: str) -> list[int]:
    """The numbers of the finished folders of a kind."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)  # noqa: SLF001
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path)]
    done = [p.getName() for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]  # noqa: SLF001
    return sorted(int(n.split("=")[1]) for n in done if n.startswith(f"{kind}="))


def state(spark: SparkSession, target: str, until: int | None = None) -> DataFrame:
    """The current record of each leaf: the newest whole state, and the batches after it."""
    wanted = lambda kind: [v for v in _versions(spark, target, kind) if until is None or v <= until]
    whole = wanted("whole")[-1:]
    folders = [f"{target}/whole={v}" for v in whole] + [f"{target}/batch={v}" for v in wanted("batch") if not whole or v > whole[0]]
    schema = "leaf int, written_at timestamp, body string"
    return current(spark.read.schema(schema).parquet(*folders)) if folders else spark.createDataFrame([], schema)


def upsert_stream(spark: SparkSession, source: str, target: str, checkpoint: str, every: int = 20) -> StreamingQuery:
    """A query that keeps ``target`` at the current record of each leaf of all files that have come into ``source``. A batch
    writes its own records only, and every so many batches the whole state is written anew, so that a batch costs what it
    brings. A batch that is run again writes the same folders, so the state is exact after a failure; late and repeated
    records change nothing. ``state`` reads it."""

    def merge(batch: DataFrame, epoch: int) -> None:
        current(batch).write.mode("overwrite").parquet(f"{target}/batch={epoch}")
        if epoch % every == every - 1:
            state(spark, target, epoch).write.mode("overwrite").parquet(f"{target}/whole={epoch}")

    stream = spark.readStream.schema("leaf int, written_at timestamp, body string").parquet(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
