"""Keep-first deduplication in explainable stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import strip
from vitrine.runtime import cut, join_keyed


def staged(df: DataFrame, stages: list[tuple[str, list[Column]]], order: list[str]) -> DataFrame:
    """df with ``reason`` (NULL for rows kept) and ``kept_by`` (order columns of the row that won).

    Each stage has a name and key columns; among the rows that earlier stages left and whose last key isn't empty, the
    first by ``order`` claims the key. A row that lost a key still blocks it no more: a claim belongs to survivors of the
    stages before. NULL keys count as empty; ties of the whole order are broken arbitrarily, so it should be unique.
    Every stage aggregates (first owner of each key, pre-aggregated per task) and joins keys only; a hot key, such as a
    blank id, is joined where its rows are.
    """
    # the stages look at keys only; the rows meet their reasons once, at the end
    names = [[f"__k{n}_{i}" for i in range(len(keys))] for n, (_, keys) in enumerate(stages)]
    cells = {k: F.coalesce(x.cast("string"), F.lit("")) for (_, keys), ks in zip(stages, names) for k, x in zip(ks, keys)}
    slim = cut(df.select(F.struct(*order).alias("__at"), *[x.alias(k) for k, x in cells.items()]))
    live, lost = slim, []
    for (name, keys), ks in zip(stages, names):
        open_to = F.lit(True) if len(keys) == 1 or name.endswith("id") else F.col(ks[-1]) != ""
        owners = live.where(open_to).groupBy(*ks).agg(F.min("__at").alias("__owner"))
        beaten = cut(join_keyed(live.where(open_to), owners, ks, "inner").where("__owner <> __at").select("__at", F.lit(name).alias("reason"), F.col("__owner").alias("kept_by")))
        lost.append(beaten)
        live = live.join(beaten.select("__at"), "__at", "left_anti")
    reasons = lost[0]
    for x in lost[1:]:
        reasons = reasons.unionByName(x)
    found = df.withColumn("__at", F.struct(*order)).join(reasons, "__at", "left")
    return found.withColumn("kept_by", F.coalesce("kept_by", "__at")).drop("__at").select(*df.columns, "reason", "kept_by")


def artifacts(df: DataFrame, order: str = "seq") -> DataFrame:
    """The three stages of artifact records: same object, same page of a museum, same accession number of a museum."""
    m = F.col("museum_id")
    return staged(df, [("duplicate_object_id", [m, F.col("object_id")]), ("duplicate_detail_url", [m, strip("detail_url")]), ("duplicate_accession_number", [m, strip("accession_number")])], [order])


def first_seen(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """First row of each key; NULL is a key like any other."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__r"))
    return best.select(*keys, "__r.*").select(*df.columns)


def best_by_key(df: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """Row of the highest score of each key, first by order of equals."""
    rest = [c for c in df.columns if c not in keys]
    # nothing scores less than no score; of equals the first by order, so the order counts downwards
    first = df.groupBy(*keys, score).agg(F.min_by(F.struct(*[c for c in rest if c != score]), F.col(order)).alias("__r"))
    best = first.groupBy(*keys).agg(F.max_by(F.struct(F.col(score).alias("s"), F.col("__r").alias("r")), F.struct(F.col(score).isNotNull(), F.col(score))).alias("__b"))
    return best.select(*keys, F.col("__b.s").alias(score), "__b.r.*").select(*df.columns)
