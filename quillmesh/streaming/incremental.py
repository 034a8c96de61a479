"""Structured Streaming variants of deliveries that arrive over time.

Batch rules carry over: a repeated delivery counts once, the newest version of
a record stands, totals are kept by event time.  State is bounded by the
watermark; what arrives later than that belongs to a batch re-run.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmesh.operators.versions import latest_version


def deliveries(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """Rows of Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def without_repeats(stream: DataFrame, event_time: str, key: Sequence[str], delay: str) -> DataFrame:
    """Each key once within the watermark, whatever its event time on the second delivery."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def windowed_totals(stream: DataFrame, event_time: str, length: str, key: Sequence[str], values: Sequence[str], delay: str) -> DataFrame:
    """Totals per window and key; a window is final once the watermark has passed it."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, length), *key).agg(F.count("*").alias("n_rows"), *[F.sum(v).alias(f"total_{v}") for v in values])


def keep_latest(stream: DataFrame, key: Sequence[str], order: str, table_folder: str, checkpoint: str, parts: int = 16) -> StreamingQuery:
    """Maintain the newest version of every key in versioned folders ``v=<batch>``, cut into ``parts`` by a hash of the key.

    A micro-batch rewrites only the parts its keys fall into, and ``v=<batch>.json`` beside the folder, written last, says in
    which folder every part is; a reader takes the newest such list (:func:`read_latest`), a repeated batch writes its own
    folder again.  A batch whose predecessor has no list is an error: nothing may be lost.  Folders that neither of the
    last two lists names are removed.
    """
    marked = lambda df: df.withColumn("part_of_key", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        places = _list_of(spark, table_folder, number - 1) if number else {}
        if places is None:
            raise RuntimeError(f"the list before batch {number} is missing")
        batch = marked(batch).persist()
        try:
            touched = sorted(r.part_of_key for r in batch.select("part_of_key").distinct().collect())
            held = [f"{table_folder}/{places[p]}/part_of_key={p}" for p in touched if p in places]
            rows = batch.unionByName(marked(spark.read.schema(batch.drop("part_of_key").schema).parquet(*held))) if held else batch
            latest_version(rows, list(key), [F.desc_nulls_last(order)]).write.mode("overwrite").partitionBy("part_of_key").parquet(f"{table_folder}/v={number}")
        finally:
            batch.unpersist()
        now = places | {p: f"v={number}" for p in touched}
        fs, path = _filesystem(spark, table_folder)
        out = fs.create(path(f"{table_folder}/v={number}.json"), True)
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        # A batch may be repeated, so what the list before names stays for one more batch.
        older = _list_of(spark, table_folder, number - 2) or {}
        for old in set(older.values()) - set(places.values()) - set(now.values()):
            fs.delete(path(f"{table_folder}/{old}"), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _filesystem(spark: SparkSession, folder: str):
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _list_of(spark: SparkSession, folder: str, number: int) -> dict[int, str] | None:
    fs, path = _filesystem(spark, folder)
    name = f"{folder}/v={number}.json"
    return {int(k): v for k, v in json.loads(spark.read.text(name, wholetext=True).first()[0]).items()} if fs.exists(path(name)) else None


def read_latest(spark: SparkSession, table_folder: str) -> DataFrame:
    """The table as of the newest list."""
    fs, path = _filesystem(spark, table_folder)
    numbers = [int(s.getPath().getName()[2:-5]) for s in fs.listStatus(path(table_folder)) if s.getPath().getName().endswith(".json")]
    places = _list_of(spark, table_folder, max(numbers))
    return spark.read.parquet(*[f"{table_folder}/{place}/part_of_key={p}" for p, place in sorted(places.items())])
