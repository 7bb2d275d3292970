"""Whole jobs over tables: enrich, translate, load what is new, repair, build the graph. Each takes and gives DataFrames;
what a job asks of a service comes in as a table of answers, and what is still to be asked goes out as one."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import changes, enrich, quality, registry, repair, summary
from vitrine.plans.pipelines import export
from vitrine.runtime import cut


class Done(NamedTuple):
    records: DataFrame
    open: DataFrame  # noqa: A003
    report: DataFrame


def _report(before: DataFrame, after: DataFrame, key: str, columns: list[str], left: DataFrame) -> DataFrame:
    cells = quality.changed_cells(before, after, key, [c for c in columns if c in before.columns])
    return cells.select("changed_rows", "changed_cells", left.agg(F.count("*")).scalar().alias("open"))


def enriched(df: DataFrame, answers: DataFrame, run_date: str, force: bool = False, key: str = "seq") -> Done:
    """Records filled from answers(artist_norm, the five fields); makers without an answer are left to ask for."""
    records = cut(enrich.merge(df, answers, run_date, force))
    wanted = enrich.lookups(df, key).join(answers.select("artist_norm").distinct(), "artist_norm", "left_anti")
    return Done(records, wanted, _report(df, records, key, [*enrich.ENRICHED, "artist_enriched_at"], wanted))


def translated(df: DataFrame, cache: DataFrame, columns: list[str], key: str = "seq") -> Done:
    """Records whose columns are replaced by what the cache has; texts it hasn't are left to ask for, shortest first."""
    records = cut(enrich.translate(df, cache, columns))
    wanted = enrich.untranslated(df, cache, columns)
    return Done(records, wanted, _report(df, records, key, columns, wanted))


def loaded(stored: DataFrame, incoming: DataFrame, key: str, columns: list[str], order: str | None = None, by: str = "museum_id") -> Done:
    """The stored table after a crawl: changes of incoming rows are found, only new and updated rows are put in. ``open``
    holds the changes, and the report counts them by source and in all."""
    found = cut(changes.diff(stored, incoming, key, columns, new_order=order, old_order=order))
    touched = found.where(F.col("change_type").isin("new", "updated")).select(key)
    fresh = changes.first_of(incoming, key, order).join(touched, key, "left_semi")
    records = changes.upsert(stored, fresh.select(*stored.columns), [key], order)
    sources = changes.first_of(incoming, key, order).select(key, by)
    report = summary.of_run(summary.of_changes(found.where(F.col(key) != "").join(sources, key, "left"), by), by)
    return Done(records, found, report)


def repaired(stored: DataFrame, read: DataFrame, key: str = "seq") -> Done:
    """Stored records refreshed from pages read anew; records still without images are left to visit."""
    records = cut(repair.refreshed(stored, read))
    left = repair.unfilled(records).select(key, "detail_url")
    return Done(records, left, _report(stored, records, key, ["title", "description", "image_url", "image_urls"], left))


def graph(df: DataFrame) -> dict[str, DataFrame]:
    """(nodes, edges, properties) of a collection: artifacts and entities as nodes, whatever an edge implies added."""
    tables = export(df)
    edges = cut(tables["relations"].select("from", "relation", "to"))
    named = tables["master"].select(F.col("canonical_id").alias("id"), F.col("label").alias("name"))
    artifacts = edges.select(F.col("from").alias("id")).distinct().withColumn("name", F.lit(None).cast("string"))
    nodes = named.unionByName(artifacts)
    implied = registry.implied_nodes(nodes, edges).select("id", F.lit(None).cast("string").alias("name"))
    return {"nodes": nodes.unionByName(implied).withColumn("label", registry.label_of("id")), "edges": edges, "properties": tables["properties"]}


def synced(spark: SparkSession, df: DataFrame, path: str, wipe: bool = False, museum: str | None = None, names: list[str] | None = None) -> DataFrame:
    """Write the graph of a collection to a folder and give its counts by label, read back from there.

    With ``wipe`` what stood there goes; else nodes keep the names they have and edges and properties are merged. One
    museum's artifacts, or some property names only, can be chosen. Raises if what is read back isn't what was written."""
    new = graph(df if museum is None else df.where(F.trim(F.col("museum_id").cast("string")) == museum))
    if names is not None:
        new["properties"] = new["properties"].where(F.col("relation").isin(names))
    for kind, table in new.items():
        at = f"{path}/{kind}"
        if not wipe and _there(spark, at):
            old = spark.read.parquet(at)
            if kind == "nodes":
                merged = registry.merge_nodes(old.select("id", "name"), table.select("id", "name"), keep=True)
                table = merged.withColumn("label", registry.label_of("id"))
            else:
                table = old.unionByName(table).distinct()
        ready = cut(table)
        ready.write.mode("overwrite").parquet(at)
        if spark.read.parquet(at).count() != ready.count():
            raise RuntimeError(f"{at} doesn't hold what was written")
    return registry.graph_counts(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))


def _there(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
