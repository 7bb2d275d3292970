"""Reading record files: CSV with byte order mark, JSON lines, folders; and choosing which of several files to read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.text import strip
from vitrine.schema import COLUMNS


def exists(spark: SparkSession, path: str) -> int:
    """Size in bytes of a file or folder, -1 if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength() if fs.exists(at) else -1


def read_csv(spark: SparkSession, path: str, project: bool = True, raw: bool = False, parallel: bool = False, ordinal: int | None = None) -> DataFrame:
    """A CSV of records: quoted line breaks, doubled quotes, byte order mark; cells stripped unless raw; in the record's
    columns (project) or the file's own; with seq if the file's ``ordinal`` among several inputs is given. A file that is
    missing or empty gives no rows. A file with line breaks in cells can't be cut up, so it is one task (many files are as
    many); files without them can be read in parallel parts."""
    more = [] if ordinal is None else ["seq"]
    if exists(spark, path) <= 0:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS] + [T.StructField(c, T.LongType()) for c in more]))
    df = spark.read.csv(path, header=True, multiLine=not parallel, escape='"', encoding="UTF-8")
    if ordinal is not None:
        df = numbered(df, ordinal)
    df = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    if not raw:
        df = df.select(*[F.col(c) if c in more else strip(c).alias(c) for c in df.columns])
    if not project:
        return df
    have = set(df.columns)
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in COLUMNS], *more)


def numbered(df: DataFrame, file_ordinal: int = 0) -> DataFrame:
    """df, as read from files, with seq: the file's place in a list of inputs and the row's place among the files, so that
    "first" has a meaning. Rows are counted by parts of files, on the JVM; parts follow each other by path and offset."""
    part = ("__path", "__from")
    rows = df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__from")).withColumn("__id", F.monotonically_increasing_id())
    sizes = rows.groupBy(*part).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    # one row for each part of a file; their running sum is the number of rows before a part
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = rows.join(before.select(*part, "__before", "__first"), list(part))
    return joined.select(*df.columns, (F.lit(file_ordinal).cast("long") * (1 << 40) + F.col("__before") + F.col("__id") - F.col("__first")).alias("seq"))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(source, target) of a cache kept as one JSON object of texts; a file that is missing or can't be read is empty."""
    empty = spark.createDataFrame([], "source string, target string")
    if exists(spark, path) <= 0:
        return empty
    pairs = F.explode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("e")
    return spark.read.text(path, wholetext=True).select(pairs).select(F.col("e.key").alias("source"), F.col("e.value").alias("target"))


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """JSON lines as text (value), lines that are no JSON objects dropped, with their file's name."""
    df = spark.read.text(paths).withColumn("file", F.col("_metadata.file_name"))
    return df.where(F.try_parse_json("value").isNotNull() & F.col("value").startswith("{"))


def read_shards(spark: SparkSession, index: str) -> DataFrame:
    """An object store's shards: the index lists them, one name a line; each holds JSON lines. The list is the
    store's directory, read on the driver like a folder listing; it is bounded by the number of files."""
    folder = index.rpartition("/")[0]
    names = [r.value.strip() for r in spark.read.text(index).collect() if r.value.strip()]
    return read_lines(spark, [n if re.match(r"^\w+:|^/", n) else f"{folder}/{n}" for n in names])


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder in their own columns, with the file each row came from."""
    return spark.read.csv(path, header=True, escape='"').withColumn("file", F.col("_metadata.file_name"))


def first_existing(spark: SparkSession, candidates: list[str]) -> list[str]:
    """Of each base name (variants ".fixed" and ".cleaned" taken as the same) the first candidate that isn't empty."""
    chosen: dict[str, str] = {}
    for path in candidates:
        key = re.sub(r"\.(?:fixed|cleaned)(?=\.|$)", "", path.rpartition("/")[2])
        if key not in chosen and exists(spark, path) > 0:
            chosen[key] = path
    return list(chosen.values())


def read_table(spark: SparkSession, url: str, table: str, museum_id: int | None = None, **options: str) -> DataFrame:
    """A database table over JDBC; the museum's filter is pushed down."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df if museum_id is None else df.where(F.col("museum_id") == museum_id)
