"""What the catalog holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "database string, name string, column string, type string, position int"


def columns(spark: SparkSession) -> DataFrame:
    """(database, name, column, type, position) of every table and view; the catalog's own listing, read on the driver."""
    rows = []
    for db in spark.catalog.listDatabases():
        for t in spark.catalog.listTables(db.name):
            name = t.name if t.isTemporary else f"{db.name}.{t.name}"
            rows += [(db.name, t.name, c.name, c.dataType, i) for i, c in enumerate(spark.catalog.listColumns(name), 1)]
    return spark.createDataFrame(list(dict.fromkeys(rows)), SCHEMA)


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """(name, rows) of the named tables; tables that aren't there are left out."""
    found = [n for n in names if spark.catalog.tableExists(n)]
    return spark.createDataFrame([(n, spark.table(n).count()) for n in found], "name string, rows long")


def ensure(spark: SparkSession, name: str, like: DataFrame) -> None:
    """Create an empty parquet table with the columns of ``like`` unless it is there."""
    if not spark.catalog.tableExists(name):
        like.limit(0).write.format("parquet").saveAsTable(name)
