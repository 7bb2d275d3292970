"""The record schema and its fixed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of a record, in file order.
COLUMNS = (
    "object_id museum_id title artist artist_province dynasty artist_wikidata_id artist_birth artist_death artist_bio artist_wikipedia_summary artist_enriched_at period period_start_year period_end_year type material culture "
    "description provenance bibliography dimensions museum location detail_url image_url image_urls iiif_manifest_url image_path image_paths image_count credit_line accession_number source_updated_at crawl_date"
).split()
#: Columns that a complete record fills, that a change doesn't count in, and that enrichment fills.
REQUIRED = ("object_id", "museum_id", "title", "detail_url", "image_url", "crawl_date")
UNTRACKED = ("crawl_date", "image_path", "image_paths")
ENRICHED = ("artist_wikidata_id", "artist_birth", "artist_death", "artist_bio", "artist_wikipedia_summary")

FILE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
_TYPES = {"museum_id": "int", "period_start_year": "int", "period_end_year": "int", "image_count": "int"}


def texts(df: DataFrame) -> DataFrame:
    """Every column of a record as a string, NULL and missing columns as empty strings; others dropped."""
    have = set(df.columns)
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in COLUMNS])


def typed(df: DataFrame, run_date: str) -> DataFrame:
    """The database view of a text record: whole numbers, dates, a museum that can't be read as 0, a crawl date that
    can't be read as the day of the run, and the artifact's id."""
    cols = [F.expr(f"try_cast(trim({c}) AS int)").alias(c) if c in _TYPES else F.col(c) for c in COLUMNS]
    out = df.select(*cols).withColumn("museum_id", F.coalesce("museum_id", F.lit(0)))
    out = out.withColumn("crawl_date", F.coalesce(F.expr("try_cast(substring(crawl_date, 1, 10) AS date)"), F.lit(run_date).cast("date")))
    return out.withColumn("artifact_id", F.concat(F.lit("entity:artifact:"), F.col("museum_id"), F.lit(":"), F.trim("object_id")))


def reconcile(df: DataFrame, target: T.StructType, renames: dict[str, str] | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """df in the columns, order and types of target: renamed, missing ones added with their default, widened by cast."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit((defaults or {}).get(f.name))).cast(f.dataType).alias(f.name) for f in target])
