"""Incremental loads as a stream: files of records arrive, each micro-batch is diffed against the state and upserted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.changes import diff, upsert
from vitrine.runtime import cut


#: Parts of the state by hash of the key; a batch rewrites those it touches.
PARTS = 32


def state_parts(spark: SparkSession, state: str, before: int | None = None) -> dict[int, str]:
    """Folder of every part of the state: the newest that a whole batch (before batch ``before``) wrote."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest: dict[int, tuple[int, str]] = {}
    for batch in fs.listStatus(at) if fs.exists(at) else []:
        number = int(batch.getPath().getName().split("=")[1])
        if before is not None and number >= before or not fs.exists(batch.getPath().suffix("/_SUCCESS")):
            continue
        for part in fs.listStatus(batch.getPath()):
            name = part.getPath().getName()
            if name.startswith("part_of="):
                k = int(name.split("=")[1])
                newest[k] = max(newest.get(k, (-1, "")), (number, part.getPath().toString()))
    return {k: path for k, (_, path) in newest.items()}


def read_state(spark: SparkSession, state: str, schema: T.StructType, before: int | None = None, only: list[int] | None = None) -> DataFrame:
    """The table as it stands, or as it stood before a batch; of some parts only."""
    paths = [p for k, p in state_parts(spark, state, before).items() if only is None or k in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def replay(spark: SparkSession, source: str, schema: T.StructType, state: str, feed: str, checkpoint: str, key: str, columns: list[str], order: str | None = None, on_change: Callable[[int], None] | None = None, files: int = 1) -> None:
    """Run every waiting file through the state and stop.

    ``state`` holds the parts that a batch touched, in a folder of its own (``batch=N/part_of=K``); the newest of each
    part make the table, so a batch costs as much as the parts its changes fall in. A batch that is run again after a
    failure writes the same parts anew from those before it, so a batch counts once. ``feed`` gets one row per new or
    updated key of a batch. ``on_change`` is called with the number of changes of a batch that has any.
    """
    columns_all = [f.name for f in schema]
    part = F.pmod(F.xxhash64(F.trim(F.col(key).cast("string"))), F.lit(PARTS)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        batch = cut(batch.select(*columns_all))
        coming = [r[0] for r in batch.select(part).distinct().collect()]  # PARTS at most
        old = read_state(spark, state, schema, number, coming)
        changes = cut(diff(old, batch, key, columns, new_order=order).where(F.col("change_type").isin("new", "updated")))
        fresh = batch.join(changes.select(key), key, "left_semi").select(*columns_all)
        touched = [r[0] for r in changes.select(part).distinct().collect()]
        stays = read_state(spark, state, schema, number, touched)
        after = upsert(stays, fresh, [key], order).withColumn("part_of", part)
        after.repartition(max(1, len(touched)), "part_of").write.mode("overwrite").partitionBy("part_of").parquet(f"{state}/batch={number}")
        changes.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{feed}/batch={number}")
        if on_change and (n := changes.count()):
            on_change(n)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums of events by window and type, late events within ``late`` included; for a stream or a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
