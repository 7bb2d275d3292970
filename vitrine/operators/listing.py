"""The read side: filtered pages, totals, details, images."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import split_paths


def matches(equal: dict[str, object] | None = None, like: dict[str, str] | None = None) -> Column:
    """All given conditions: equality, and substrings in any case, where % and _ stay wildcards; blank ones are none."""
    tests = [F.col(c) == v for c, v in (equal or {}).items() if v is not None] + [F.col(c).ilike(f"%{v}%") for c, v in (like or {}).items() if v]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def page(df: DataFrame, keys: list[str], number: int = 1, size: int = 20, equal: dict | None = None, like: dict | None = None) -> DataFrame:
    """One page of the filtered rows in key order; numbers from 1, sizes from 1 to 100."""
    number, size = max(1, number), min(100, max(1, size))
    return df.where(matches(equal, like)).orderBy(*keys).offset((number - 1) * size).limit(size)


def total(df: DataFrame, equal: dict | None = None, like: dict | None = None) -> DataFrame:
    return df.where(matches(equal, like)).agg(F.count("*").alias("total"))


def detail(df: DataFrame, **keys: object) -> DataFrame:
    return df.where(matches(keys))


def shown(df: DataFrame, base: str = "/api/img") -> DataFrame:
    """Rows as the API shows them: image addresses, count of images or of files, and whether there is one. The first
    image's address has no number."""
    files = split_paths(F.coalesce(F.nullif(F.trim("image_paths"), F.lit("")), F.col("image_path")))
    address = F.concat(F.lit(f"{base}/"), F.col("museum_id"), F.lit("/"), F.col("object_id"))
    out = df.withColumn("__f", files)
    web = F.transform(F.sequence(F.lit(1), F.size("__f")), lambda i: F.when(i == 1, address).otherwise(F.concat(address, F.lit("/"), i - 1)))
    out = out.withColumn("imgs_web", F.when(F.size("__f") > 0, web).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("img_web", F.coalesce(F.get("imgs_web", F.lit(0)), F.lit("")))
    out = out.withColumn("image_count", F.when(F.coalesce(F.col("image_count"), F.lit(0)) == 0, F.size("__f")).otherwise(F.col("image_count")))
    return out.withColumn("has_local_image", F.size("__f") > 0).drop("__f")


def nth_image(df: DataFrame, index: int = 0) -> DataFrame:
    """(museum_id, object_id, path, media_type) of each object's image number ``index``, where it has one."""
    p = F.get(split_paths(F.coalesce(F.nullif(F.trim("image_paths"), F.lit("")), F.col("image_path"))), F.lit(index))
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    media = F.when(kind.isin("jpg", "jpeg"), "image/jpeg").when(kind.isin("png", "webp", "gif"), F.concat(F.lit("image/"), kind)).when(kind.isin("tif", "tiff"), "image/tiff").otherwise("application/octet-stream")
    return df.select("museum_id", "object_id", p.alias("path")).where("path IS NOT NULL").withColumn("media_type", media)


def resolve_paths(paths: DataFrame, roots: list[str], files: DataFrame) -> DataFrame:
    """(path, file) for each stored path: the first of these that is among files(path): the path itself; then for each
    root in order root/path, root/name, root/path without a leading images/. The roots are few and make candidates per row."""
    p = F.regexp_replace("path", r"\\", "/")
    name = F.substring_index(p, "/", -1)
    every = F.array(p, *[x for r in roots for x in (F.concat(F.lit(r.rstrip("/") + "/"), p), F.concat(F.lit(r.rstrip("/") + "/"), name), F.concat(F.lit(r.rstrip("/") + "/"), F.regexp_replace(p, "^images/", "")))])
    tries = paths.select("path").distinct().select("path", F.posexplode(every).alias("n", "file"))
    hit = tries.join(files.select(F.col("path").alias("file")).distinct(), "file", "left_semi")
    return hit.groupBy("path").agg(F.min_by("file", "n").alias("file"))
