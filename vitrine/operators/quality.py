"""Counts that say how good a table is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.schema import REQUIRED


def blank_counts(df: DataFrame, columns: tuple[str, ...] = REQUIRED, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., column, rows, blank) for each column: NULL, empty and blank values."""
    sums = df.groupBy(*by).agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(c) for c in columns])
    return sums.unpivot([*by, "rows"], list(columns), "column", "blank").select(*by, "column", "rows", "blank")


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, by: str = "museum_id", column: str = "image_path") -> DataFrame:
    """Rows and rows with a value, by group."""
    return df.groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.trim(F.col(column)) != "").alias("with_value"))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys met more than once; empty where the keys are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def changed_cells(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: rows and cells that differ between two versions of a table."""
    j = before.select(key, *[F.col(c).alias(f"b_{c}") for c in columns]).join(after.select(key, *columns), key)
    n = sum((F.when(F.col(f"b_{c}").eqNullSafe(F.col(c)), 0).otherwise(1) for c in columns), F.lit(0))
    return j.select(n.alias("n")).agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("changed_rows"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("changed_cells"))
