"""Writing records, triples and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.schema import texts


def write_csv(df: DataFrame, path: str, append: bool = False, records: bool = True) -> None:
    """A folder of CSV parts with header, NULL as empty, in the record's columns; appended parts must have them too."""
    (texts(df) if records else df).write.mode("append" if append else "overwrite").option("emptyValue", "").csv(path, header=True, escape='"')


def write_relations(triples: DataFrame, path: str) -> DataFrame:
    """One folder per relation, sorted inside; stale ones go. Returns the count of each relation."""
    ordered = triples.repartition("relation", F.pmod(F.xxhash64("from"), F.lit(16))).sortWithinPartitions("relation", "from", "to")
    ordered.write.mode("overwrite").partitionBy("relation").csv(path, header=True)
    return triples.groupBy("relation").agg(F.count("*").alias("n"))


def append_log(df: DataFrame, path: str) -> None:
    """JSON lines of a change feed or run ledger, added to what is there."""
    df.write.mode("append").json(path)


def write_state(df: DataFrame, path: str, key: str = "object_id") -> None:
    """The snapshot of fingerprints by key."""
    from vitrine.operators.changes import fingerprint  # noqa: PLC0415

    texts(df).select(key, fingerprint().alias("fingerprint")).write.mode("overwrite").parquet(path)


def upsert_table(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """A staging table over JDBC, to be merged by the database with one statement."""
    df.write.jdbc(url, f"{table}_staging", mode="overwrite", properties=properties)
