"""Durable intermediate tables.

A stage that is dear to compute, or that must not change when a task is
repeated, is written as a Parquet table to the folder that the session names
in ``spark.checkpoint.dir``.  That folder is shared by all executors, so the
data outlives any of them; lineage ends there, columns that a later step does
not need are not read, and the optimizer knows the written size.  Where the
setting is missing (a local session, tests) a folder of this process is used.

Stages are removed by :func:`release`, at the latest when the process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def stage_folder(spark: SparkSession) -> str:
    """The shared folder for stages; set for this session if it is not."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quillmesh-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """The same rows, read from a written table."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> int:
    """Delete the stages written so far and return how many; results that still read them must have been used before."""
    mine = [x for x in _written if spark is None or x[0] is spark]
    for session, path in mine:
        place = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        _written.remove((session, path))
    return len(mine)


@atexit.register
def _at_exit() -> None:
    try:
        release()
    except Exception:  # noqa: BLE001 - the session may be gone; its folder then belongs to whoever cleans the cluster
        pass


def spread(df: DataFrame) -> DataFrame:
    """Rows over at least as many partitions as there are cores, for work that is dear per row.

    Only a scan with fewer splits than cores is redistributed, so what moves is bounded by cores times the split size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
