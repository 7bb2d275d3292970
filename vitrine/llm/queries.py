"""Registered queries of the subpackage, and the SQL to hold them against where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import canonical, leakage, linkage, packing, residue, sentences, truncated, variants
from vitrine.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary entry of every freely typed value."""
    return canonical.map_values(table(spark, sf_dir, "artifact"), table(spark, sf_dir, "vocab_term"))


@query()
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every description and provenance that holds page or template matter."""
    return residue.residue(table(spark, sf_dir, "artifact"))


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text field that lost its end."""
    return truncated.cut_off(table(spark, sf_dir, "artifact"))


@query()
def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each museum cuts each field."""
    return truncated.rates(table(spark, sf_dir, "artifact"))


@query()
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of names that mean one person, firm or workshop."""
    return variants.variant_pairs(table(spark, sf_dir, "artist_alias"))


@query()
def p7_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the clusters of variants."""
    c = variants.clusters(table(spark, sf_dir, "artist_alias"))
    return c.groupBy("cluster").agg(F.count("*").alias("spellings")).groupBy("spellings").agg(F.count("*").alias("clusters"))


@query()
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object and the partner entry that describes it."""
    return linkage.link(table(spark, sf_dir, "object_record"), table(spark, sf_dir, "artifact"), table(spark, sf_dir, "vocab_term")).drop("confidence")


@query()
def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs with their confidence."""
    return linkage.link(table(spark, sf_dir, "object_record"), table(spark, sf_dir, "artifact"), table(spark, sf_dir, "vocab_term"))


@query()
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item and the document that holds a passage of it."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item")).select("item_id", "doc_id")


@query()
def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test item that leaked: documents concerned and its longest passage."""
    found = leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("longest"))


@query()
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every text, and of every piece of one that is longer than a container."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of room used."""
    per = packing.pack(table(spark, sf_dir, "documents")).groupBy("container").agg(F.sum("tokens").alias("tokens"))
    return per.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"), (F.sum("tokens") / (F.count("*") * packing.CAPACITY)).alias("used"))


@query()
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document."""
    return sentences.split_sentences(table(spark, sf_dir, "documents"))
