"""Filling records from lookups: one lookup per maker, one per distinct text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import artist_key, lookup_name, strip
from vitrine.runtime import join_keyed
from vitrine.schema import ENRICHED


def wants(force: bool = False) -> Column:
    """Has a record a maker and a gap to fill?"""
    gap = F.lit(force)
    for c in ENRICHED:
        gap = gap | (strip(c) == "")
    return (strip("artist") != "") & gap


def lookups(df: DataFrame, order: str = "seq") -> DataFrame:
    """(artist_norm, name, rows) to look up: one per key, named as in its first record, dealers left out."""
    named = df.where(wants()).select(F.col(order), artist_key("artist").alias("artist_norm"), lookup_name("artist").alias("name")).where("name <> ''")
    return named.groupBy("artist_norm").agg(F.min_by("name", order).alias("name"), F.count("*").alias("rows"))


def merge(df: DataFrame, found: DataFrame, run_date: str, force: bool = False) -> DataFrame:
    """df filled from found(artist_norm, the five fields): blank fields only, or all with ``force``; the date is stamped
    where something changed. Of several finds for one key the largest counts."""
    one = found.groupBy("artist_norm").agg(*[F.max(c).alias(f"__{c}") for c in ENRICHED])
    out = join_keyed(df.withColumn("artist_norm", artist_key("artist")), one, ["artist_norm"])
    fills = {c: (F.coalesce(F.col(f"__{c}"), F.lit("")) != "") & (F.lit(force) | (strip(c) == "")) & (F.coalesce(F.col(f"__{c}"), F.lit("")) != F.coalesce(F.col(c), F.lit(""))) for c in ENRICHED}
    hit = F.lit(False)
    for t in fills.values():
        hit = hit | t
    out = out.withColumn("__hit", hit & (strip("artist") != ""))
    out = out.withColumns({c: F.when(fills[c] & F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in ENRICHED})
    return out.withColumn("artist_enriched_at", F.when(F.col("__hit"), F.lit(run_date)).otherwise(F.col("artist_enriched_at"))).select(*df.columns)


def translate(df: DataFrame, cache: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns' texts replaced by cache(source, target) where it has them; blank texts stay."""
    one = cache.groupBy("source").agg(F.max("target").alias("target"))
    for c in columns:
        look = one.select(F.col("source").alias("__s"), F.col("target").alias("__t"))
        keyed = df.withColumn("__s", F.nullif(strip(c), F.lit("")))
        df = join_keyed(keyed, look, ["__s"]).withColumn(c, F.when(F.col("__s").isNull(), F.col(c)).otherwise(F.coalesce("__t", c))).select(*df.columns)
    return df


def untranslated(df: DataFrame, cache: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-blank texts that the cache hasn't, shortest first."""
    every = df.select(F.explode(F.array(*[strip(c) for c in columns])).alias("source")).where("source <> ''").distinct()
    return every.join(cache.select("source").distinct(), "source", "left_anti").orderBy(F.length("source"), "source")
