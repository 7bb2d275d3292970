"""Image checks against records: validity, repair, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import split_paths


def latest_checks(checks: DataFrame) -> DataFrame:
    """Last check of each URL (by time, then id)."""
    return checks.where("image_url IS NOT NULL").groupBy("image_url").agg(F.max_by(F.struct("valid", "status_code", "content_type", "check_id"), F.struct("checked_at", "check_id")).alias("c")).select("image_url", "c.*")


def checked(df: DataFrame, checks: DataFrame, key: str = "seq") -> DataFrame:
    """(key, pos, image_url, state) per URL of a record: valid, invalid or not_checked. Main image first, each URL once."""
    every = F.array_distinct(F.filter(F.concat(F.array(F.trim("image_url")), split_paths("image_urls")), lambda u: u != ""))
    one = df.select(key, F.posexplode(every).alias("pos", "image_url"))
    last = latest_checks(checks).select("image_url", "valid", F.lit(True).alias("seen"))
    state = F.when(F.col("seen").isNull() | F.col("valid").isNull(), "not_checked").when(F.col("valid"), "valid").otherwise("invalid")
    return one.join(last, "image_url", "left").select(key, "pos", "image_url", state.alias("state"))


def repaired(df: DataFrame, checks: DataFrame, key: str = "seq", drop: bool = False) -> DataFrame:
    """Records whose main image is known to be bad get their first good one instead, or none; others keep theirs. With
    ``drop``, records left without any image go."""
    states = checked(df, checks, key).groupBy(key).agg(F.max(F.when((F.col("pos") == 0) & (F.col("state") == "invalid"), 1).otherwise(0)).alias("__bad"), F.array_sort(F.collect_list(F.when(F.col("state") == "valid", F.struct("pos", "image_url")))).alias("__ok"))
    out = df.join(states, key, "left")
    good = F.transform("__ok", lambda x: x["image_url"])
    bad = F.coalesce(F.col("__bad"), F.lit(0)) == 1
    out = out.withColumn("image_url", F.when(bad, F.coalesce(F.get(good, F.lit(0)), F.lit(""))).otherwise(F.col("image_url")))
    out = out.withColumn("image_urls", F.when(bad, F.array_join(good, " | ")).otherwise(F.col("image_urls"))).drop("__bad", "__ok")
    return out.where(F.trim(F.coalesce("image_url", F.lit(""))) != "") if drop else out


def complete(df: DataFrame) -> DataFrame:
    """df with ``images_complete``: as many local paths as URLs, and at least one."""
    n, m = F.size(split_paths("image_urls")), F.size(split_paths("image_paths"))
    return df.withColumn("images_complete", (n > 0) & (m >= n))


def with_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """Records with their local image columns set from files(museum_id, object_id, path): paths in order, the first one
    as main, and their number. Records without files have blank columns and 0."""
    per = files.groupBy("museum_id", "object_id").agg(F.array_sort(F.collect_set("path")).alias("__p"))
    out = df.drop("image_path", "image_paths", "image_count").join(per, ["museum_id", "object_id"], "left").withColumn("__p", F.coalesce("__p", F.array().cast("array<string>")))
    out = out.withColumns({"image_path": F.coalesce(F.get("__p", F.lit(0)), F.lit("")), "image_paths": F.array_join("__p", " | "), "image_count": F.size("__p")})
    return out.select(*df.columns, *[c for c in ("image_path", "image_paths", "image_count") if c not in df.columns])


def moved(df: DataFrame, prefix: str, columns: tuple[str, ...] = ("image_path", "image_paths")) -> DataFrame:
    """Records whose relative image paths are put under a prefix; absolute ones stay."""
    return df.withColumns({c: F.regexp_replace(F.col(c), r"(^|\|\s*)(?![/\s]|\w+:)(?=\S)", f"$1{prefix.rstrip('/')}/") for c in columns})
