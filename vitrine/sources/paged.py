"""A paged listing as a Spark data source: tasks take the pages in turn, up to the end of the listing.

``PagedSource`` reads pages captured in a folder as ``page-000001.json`` files of ``{"records": [...], "info": {"next":
...}}``; a subclass may fetch them from a service instead by overriding ``fetch``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PageRange(InputPartition):
    """Pages first, first + step, ... up to last, or to the end of the listing if last is None."""

    def __init__(self, first: int, step: int, last: int | None) -> None:
        self.first, self.step, self.last = first, step, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def fetch(self, page: int) -> dict | None:
        """One page, None beyond the last. The folder must be one that every executor can read."""
        path = Path(self.options["path"]) / f"page-{page:06d}.json"
        return json.loads(path.read_text()) if path.exists() else None

    def partitions(self) -> list[PageRange]:
        """"splits" tasks share the pages in turn, each up to the first page without records; "pages" stops before it.
        A service that can't be asked for a page beyond its last needs "splits" of 1."""
        splits = max(1, int(self.options.get("splits", 8)))
        last = int(self.options["pages"]) if "pages" in self.options else None
        return [PageRange(k, splits, last) for k in range(1, splits + 1) if last is None or k <= last]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        size, number = int(self.options.get("size", 0)), partition.first
        while partition.last is None or number <= partition.last:
            page = self.fetch(number)
            records = (page or {}).get("records") or []
            for r in records:
                yield number, json.dumps(r, ensure_ascii=False)
            if not records or size and len(records) < size or "info" in page and not (page["info"] or {}).get("next"):
                return
            number += partition.step


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, value string"

    def reader(self, schema) -> PagedReader:  # noqa: ANN001
        return PagedReader(self.options)


#: What a search service is asked for, wide questions before narrow ones.
IMAGES, FREE = 'online_media_type:"Images"', 'metadata_usage:"CC0" OR media_usage:"CC0"'
PROFILES = (
    ("chinese", (IMAGES,)),
    ("china", (IMAGES,)),
    ("Chinese art", (IMAGES,)),
    ("chinese", (IMAGES, FREE)),
    ("china", (IMAGES, FREE)),
)


def search(spark: SparkSession, folders: list[str], key: str = "$.id", pages: int | None = None, size: int = 0) -> DataFrame:
    """(profile, page, value) of the pages captured for each profile, one folder a profile, in order of the profiles: a
    record that several give counts for the first. ``pages`` stops every listing earlier. A record without the key is kept."""
    spark.dataSource.register(PagedSource)
    parts = []
    for n, folder in enumerate(folders):
        options = {"path": folder, "size": str(size), **({"pages": str(pages)} if pages is not None else {})}
        parts.append(spark.read.format("paged").options(**options).load().withColumn("profile", F.lit(n)))
    every = reduce(DataFrame.unionByName, parts).withColumn("__k", F.get_json_object("value", key))
    found = every.where("__k IS NOT NULL").groupBy("__k").agg(F.min(F.struct("profile", "page", "value")).alias("r")).select("r.*")
    return found.unionByName(every.where("__k IS NULL").select("profile", "page", "value"))
