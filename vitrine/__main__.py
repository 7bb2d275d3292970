"""Command line: python -m vitrine JOB INPUT OUTPUT. Tables are folders of Parquet, or CSV files of records."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vitrine.plans import jobs, pipelines
from vitrine.sources.files import read_cache, read_csv


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return read_csv(spark, path, ordinal=0)
    return spark.read.parquet(path)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vitrine")
    job = p.add_subparsers(dest="job", required=True)
    for name, text in (
        ("clean", "standardise and deduplicate"), ("export", "masters, aliases, relations, properties"), ("sync", "build the graph"), ("enrich", "fill from lookups"),
        ("translate", "replace texts by a cache"), ("load", "put a crawl into a stored table"), ("repair", "refresh records from pages read anew"),
    ):
        sub = job.add_parser(name, help=text)
        sub.add_argument("input")
        sub.add_argument("output")
        sub.add_argument("--limit", type=int, default=0, help="first rows only; 0 for all")
        if name in ("enrich", "translate", "load", "repair"):
            sub.add_argument("--with", dest="other", required=True, help="the table of answers, cache, crawl or pages")
        if name == "translate":
            sub.add_argument("--columns", default="type,material,culture,dynasty")
        if name == "sync":
            sub.add_argument("--wipe", action="store_true")
            sub.add_argument("--museum")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"vitrine {a.job}").getOrCreate()
    df = _read(spark, a.input)
    if a.limit:
        df = df.orderBy("seq").limit(a.limit)
    save = lambda t, name: t.write.mode("overwrite").parquet(f"{a.output}/{name}")
    if a.job == "sync":
        jobs.synced(spark, df, a.output, a.wipe, a.museum).show()
        return
    if a.job == "clean":
        out = dict(zip(("records", "duplicates", "report"), pipelines.clean(df)))
    elif a.job == "export":
        out = pipelines.export(df)
    elif a.job == "enrich":
        out = jobs.enriched(df, spark.read.parquet(a.other), date.today().isoformat())._asdict()
    elif a.job == "translate":
        out = jobs.translated(df, read_cache(spark, a.other), a.columns.split(","))._asdict()
    elif a.job == "load":
        tracked = [c for c in df.columns if c not in ("seq", "object_id", *jobs.changes.UNTRACKED)]
        out = jobs.loaded(df, _read(spark, a.other), "object_id", tracked)._asdict()
    else:
        out = jobs.repaired(df, _read(spark, a.other))._asdict()
    for name, t in out.items():
        save(t, name)


if __name__ == "__main__":
    main()
