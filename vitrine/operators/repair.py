"""Repairing stored records from pages and files read anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.pages import page_key
from vitrine.functions.text import split_paths, strip
from vitrine.runtime import join_keyed
from vitrine.schema import COLUMNS

#: What a page read anew doesn't replace where the stored record has it.
KEPT = ("image_path", "image_paths", "image_urls", "image_count", "crawl_date")


def refreshed(stored: DataFrame, read: DataFrame, order: str | None = None) -> DataFrame:
    """stored with the records of pages read anew, met by page address: the new record counts, but local images, image
    lists and crawl date stay where they were set, and so does a main image the page doesn't give. Of several readings of
    one page the last by order (or the largest) counts; records without an address, or without a reading, stay."""
    columns = [c for c in COLUMNS if c in stored.columns]
    have = set(read.columns)
    fresh = read.select(page_key("detail_url").alias("__page"), F.struct(*[strip(c).alias(c) if c in have else F.lit("").alias(c) for c in columns]).alias("__new"), *([order] if order else []))
    by = F.col(order) if order else F.col("__new")
    one = fresh.where("__page <> ''").groupBy("__page").agg(F.max_by("__new", by).alias("__new"))
    joined = join_keyed(stored.withColumn("__page", F.nullif(page_key("detail_url"), F.lit(""))), one, ["__page"])
    kinds = dict(stored.dtypes)

    def cell(c: str) -> Column:
        new = F.col(f"__new.{c}").try_cast(kinds[c])
        keep = strip(c) != ""
        if c in KEPT:
            new = F.when(keep, F.col(c)).otherwise(new)
        elif c == "image_url":
            new = F.when((F.coalesce(new, F.lit("")) == "") & keep, F.col(c)).otherwise(new)
        return F.when(F.col("__new").isNull(), F.col(c)).otherwise(new).alias(c)

    return joined.select(*[cell(c) if c in columns else F.col(c) for c in stored.columns])


def unfilled(df: DataFrame) -> DataFrame:
    """Records that a repair has still to visit: those without a list of images."""
    return df.where(F.size(split_paths("image_urls")) == 0)


def without_images(df: DataFrame) -> DataFrame:
    """Records before their images are fetched anew: no local paths, no count."""
    kinds = dict(df.dtypes)
    blank = {"image_path": "", "image_paths": "", "image_count": "0"}
    return df.withColumns({c: F.lit(v).cast(kinds[c]) for c, v in blank.items() if c in kinds})


def preview(df: DataFrame, slots: Column, candidates: Column, run_date: str) -> DataFrame:
    """Records as they are compared with stored ones before any image is fetched: as many addresses as there are images,
    the first as main image, no local paths, the day of the run."""
    first = F.coalesce(F.get(candidates, F.lit(0)), F.lit(""))
    listed = F.when(F.size(slots) > 0, F.array_join(F.slice(candidates, 1, F.size(slots)), " | ")).otherwise("")
    given = {"crawl_date": F.lit(run_date), "image_url": first, "image_urls": listed, "image_path": F.lit(""), "image_paths": F.lit(""), "image_count": F.size(slots).cast("string")}
    return df.withColumns(given)


def by_id(wanted: DataFrame, captured: DataFrame, keys: tuple[str, ...] = ("id", "url"), value: str = "value") -> DataFrame:
    """wanted with ``found``: the captured value of the first key that has one; keys are tried in order, NULL for none.
    Of several captures of a key the smallest value counts."""
    out = wanted
    for n, k in enumerate(keys):
        one = captured.where(F.col(k).isNotNull()).groupBy(F.col(k).cast("string").alias("__k")).agg(F.min(value).alias(f"__f{n}"))
        out = join_keyed(out.withColumn("__k", F.col(k).cast("string")), one, ["__k"]).drop("__k")
    return out.select(*wanted.columns, F.coalesce(*[F.col(f"__f{n}") for n in range(len(keys))]).alias("found"))
