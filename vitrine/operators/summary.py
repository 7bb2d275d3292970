"""What a run, a registry and a graph come to, in numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import strip
from vitrine.operators.registry import label_of

#: Counts of a run.
COUNTS = ("records", "images_downloaded", "new", "updated", "unchanged")


def of_changes(changes: DataFrame, by: str = "museum_id") -> DataFrame:
    """Counts of one run by source, from rows (by, change_type): skipped rows are no records."""
    kind = F.col("change_type")
    return changes.groupBy(by).agg(F.count_if(kind != "skipped").alias("records"), *[F.count_if(kind == k).alias(k) for k in ("new", "updated", "unchanged")])


def of_run(stats: DataFrame, by: str = "museum_id", counts: tuple[str, ...] = COUNTS) -> DataFrame:
    """One row by source and a last one, named "total", with what all come to; ``changed`` is new and updated."""
    have = set(stats.columns)
    cells = stats.select(F.col(by).cast("string").alias(by), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) if c in have else F.lit(0).cast("long").alias(c) for c in counts])
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
    every = cells.groupBy(by).agg(*sums).unionByName(cells.agg(*sums).withColumn(by, F.lit("total")))
    return every.withColumn("changed", F.col("new") + F.col("updated"))


def of_registry(masters: DataFrame, relations: DataFrame, properties: DataFrame) -> DataFrame:
    """One row: entities, shared ones, makers, makers with an external id, relations, properties."""
    shared = F.col("entity_type") != "Artifact"
    maker = F.col("entity_type") == "Artist"
    number = lambda t, x: t.agg(x).scalar()
    cells = {
        "entity_count": number(masters, F.count("*")),
        "shared_entity_count": number(masters, F.count_if(shared)),
        "artist_entity_count": number(masters, F.count_if(maker)),
        "artist_with_external_id": number(masters, F.count_if(maker & (F.col("external_id") != ""))),
        "relation_count": number(relations, F.count("*")),
        "property_count": number(properties, F.count("*")),
    }
    return masters.sparkSession.range(1).select(*[v.alias(k) for k, v in cells.items()])


def edge_kinds(edges: DataFrame) -> DataFrame:
    """Edges by the labels of their ends and their relation, in order."""
    return edges.groupBy(label_of("from").alias("from_label"), "relation", label_of("to").alias("to_label")).agg(F.count("*").alias("n")).orderBy("from_label", "to_label", "relation")


def top_labels(nodes: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent labels of nodes, ties by name."""
    return nodes.groupBy(label_of("id").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most)


def sample(df: DataFrame, by: list[str], most: int, where: Column | None = None) -> DataFrame:
    """The first rows in an order, of those that a condition leaves."""
    return (df if where is None else df.where(where)).orderBy(*by).limit(most)


def first_rows(df: DataFrame, limit: int, order: str = "seq") -> DataFrame:
    """The first ``limit`` rows by order; all for 0."""
    return df.orderBy(order).limit(limit) if limit > 0 else df


def batches(df: DataFrame, size: int, order: str = "seq") -> DataFrame:
    """df with ``batch``: which of the batches of ``size`` orders a row is written in. Orders are whole numbers from 0."""
    return df.withColumn("batch", F.floor(F.col(order) / size))


def artifact_map(df: DataFrame) -> DataFrame:
    """(museum_id, object_id, artifact_id) of every record that has both ids."""
    m, o = strip("museum_id"), strip("object_id")
    return df.where((m != "") & (o != "")).select(m.alias("museum_id"), o.alias("object_id"), F.concat_ws(":", F.lit("entity:artifact"), m, o).alias("artifact_id"))
