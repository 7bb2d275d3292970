"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "vitrine", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter's session is used as it is."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (a file or a folder)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where none is set, a local session gets one in the temporary folder; a
    cluster must name one, since its executors would write to disks of their own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"vitrine-{os.getpid()}"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and read it back: later passes neither recompute it nor
    lose it with an executor. The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/vitrine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, marked for broadcast if a count proves that it has at most ``rows`` rows; else it is joined by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Share of the rows from which a key is hot.
HOT = 0.002


def join_keyed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", share: float = HOT) -> DataFrame:
    """left joined with right, which has one row a key at most, whatever share of left one key holds.

    Keys that hold more than ``share`` of the rows are fewer than 1 / share, whatever the data, so their rows of right
    are broadcast and their rows of left stay where they are; all other keys are joined by shuffle. Rows with a NULL key
    match nothing and aren't shuffled either. ``how`` is left, inner, left_semi or left_anti.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    counts = left.where(known).groupBy(*keys).agg(F.count("*").alias("__n"))
    hot = counts.where(F.col("__n") > counts.agg(F.sum("__n") * share).scalar()).select(*keys)
    there = left.where(known)
    parts = [
        there.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(right.join(F.broadcast(hot), keys, "left_semi")), keys, how),
        there.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how),
    ]
    if how in ("left", "left_anti"):
        lost = left.where(~known)
        parts.append(lost if how == "left_anti" else lost.join(right.limit(0), keys, "left"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], how: str, rows: int) -> DataFrame:
    """left joined with right, a written table of one row a key: broadcast if a count proves that it has at most ``rows``
    rows, else by shuffle with hot keys kept where their rows are."""
    return left.join(F.broadcast(right), keys, how) if right.limit(rows + 1).count() <= rows else join_keyed(left, right, keys, how)


def blank(col: Column) -> Column:
    """NULL for NULL, empty and white-space-only strings, else the string without surrounding white space."""
    return F.nullif(F.regexp_replace(col, r"^[\s 　]+|[\s 　]+$", ""), F.lit(""))


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str) -> DataFrame:
    """Run a Python row function over Arrow batches. ``make()`` is called once per task (models and automata are built
    there); the function it returns gets the columns of a batch as lists and yields output tuples. Output is flushed in
    bounded batches, so a batch that explodes doesn't pile up in the worker."""
    from pyspark.sql.types import _parse_datatype_string  # noqa: PLC0415
    from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            rows: list[tuple] = []
            for row in step(*[c.to_pylist() for c in batch.columns]):
                rows.append(row)
                if len(rows) >= 20_000:
                    yield pack(rows)
                    rows = []
            if rows:
                yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return df.mapInArrow(run, schema)
