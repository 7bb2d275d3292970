"""The composite jobs: clean, register and export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.records import standardise
from vitrine.operators import dedup, images, registry
from vitrine.runtime import cut
from vitrine.schema import COLUMNS


def clean(df: DataFrame, checks: DataFrame | None = None, drop_imageless: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean records, duplicates with reason and winner, one-row report) of records with a seq."""
    keyed = df.select("seq", *[c for c in COLUMNS if c in df.columns])
    standard = cut(standardise(keyed, carry=("seq",)))
    staged = dedup.artifacts(standard)
    kept = staged.where("reason IS NULL").drop("reason", "kept_by")
    dups = staged.where("reason IS NOT NULL").select("seq", "museum_id", "object_id", "reason", F.col("kept_by.seq").alias("kept_seq"))
    out = images.repaired(kept, checks, drop=drop_imageless) if checks is not None else kept
    number = lambda t: t.agg(F.count("*")).scalar()
    report = df.sparkSession.range(1).select(number(keyed).alias("rows_in"), number(out).alias("rows_out"), number(dups).alias("duplicates"))
    return out, dups, report


def export(df: DataFrame) -> dict[str, DataFrame]:
    """All tables of the graph: masters, aliases, sources, relations, properties, counts."""
    m = cut(registry.resolve(registry.mentions(df)))
    rel = registry.relations(m)
    return {"master": registry.masters(m), "alias": registry.aliases(m), "source": registry.sources(m), "relations": rel, "properties": registry.properties(df), "relation_counts": rel.groupBy("relation").agg(F.count("*").alias("n"))}
