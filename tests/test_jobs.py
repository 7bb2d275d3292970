"""Page functions, repair, summaries, whole jobs and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from vitrine import __main__ as cli
from vitrine.functions import pages
from vitrine.operators import repair, summary
from vitrine.plans import jobs
from vitrine.sources import files, paged

PAGE = "Bowl\nShare\nProvenance:\n\nBought 1901\n×\nSold 1920\n\nlater words\nCredit Line\nGift\nMedium\nClay\n" + "\n".join(f"line {i}" for i in range(14))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("header", "value"), [("Provenance", "Bought 1901 Sold 1920"), ("Credit Line", "Gift"), ("medium", "Clay " + " ".join(f"line {i}" for i in range(9))), ("Culture", ""), ("Bowl", "")])
def test_section(spark, header, value):
    assert one(spark, pages.section(F.lit(PAGE), header)) == value
    assert one(spark, pages.section(F.lit(None).cast("string"), header)) == ""


def test_addresses_of_images(spark):
    base, at = "https://x.org", "/internal/media/dispatcher/7/preview"
    assert one(spark, pages.image_variants(F.lit(at), base)) == [base + at, f"{base}/internal/media/dispatcher/7/full"]
    assert one(spark, pages.image_variants(F.lit(" "), base)) == []
    urls = F.array(F.lit(at), F.lit("https://y/a.jpg"), F.lit(""), F.lit(at))
    assert one(spark, pages.ordered_images(urls, base)) == ["https://y/a.jpg", f"{base}/internal/media/dispatcher/7/full"]
    assert one(spark, pages.iiif_variants(F.lit("https://h/iiif/9_dynmc/"))) == [f"https://h/iiif/9{d}{r}" for d in ("_dynmc", "") for r in pages.RENDITIONS]
    none = F.array().cast("array<string>")
    assert one(spark, pages.iiif_manifest(F.array(F.lit("https://m/1")), none, F.lit(""))) == "https://m/1"
    assert one(spark, pages.iiif_manifest(none, F.array(F.lit("https://nrs.harvard.edu/u:9_dynmc/")), F.lit(""))) == "https://nrs.harvard.edu/u:9/manifest"
    assert one(spark, pages.iiif_manifest(none, none, F.lit("https://h/iiif/9/full/max/0/default.jpg"))) == "https://h/iiif/9/manifest"
    assert one(spark, pages.iiif_manifest(none, none, F.lit(None).cast("string"))) == ""


def test_field_value_and_keys(spark):
    assert one(spark, pages.field_value(F.lit("a\n\n share \n b"))) == "a b"
    assert one(spark, pages.field_value(F.lit("x" * 30), 10)) == "x" * 9 + "…"
    assert one(spark, pages.page_key(F.lit(" https://x/objects/12/;jsession?q=1 "))) == "https://x/objects/12"
    assert one(spark, pages.number_in_address(F.lit("https://x/objects/12/bowl"))) == "12"


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(1, "1", "1", "Bowl", "https://x/o/1?p", "", "a.jpg", "Ming Wu", "", "Qing"), (2, "1", "2", "Vase", "https://x/o/2", "u2", "u2 | v2", "", "", ""), (3, "1", "3", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "seq long, museum_id string, object_id string, title string, detail_url string, image_url string, image_urls string, artist string, artist_birth string, dynasty string")


def test_refresh_keeps_images(spark, stored):
    read = spark.createDataFrame([("https://x/o/1", "New bowl", "n.jpg", "n.jpg"), ("https://x/o/2/", "New vase", "", "")], "detail_url string, title string, image_url string, image_urls string")
    out = {r.seq: r for r in repair.refreshed(stored, read).collect()}
    assert (out[1].title, out[1].image_url, out[1].image_urls) == ("New bowl", "n.jpg", "a.jpg")
    assert (out[2].title, out[2].image_url, out[2].image_urls) == ("New vase", "u2", "u2 | v2")
    assert out[3].title is None and len(out) == 3
    assert repair.refreshed(stored, read.limit(0)).count() == 3 and repair.refreshed(stored.limit(0), read).count() == 0
    assert {r.seq for r in jobs.repaired(stored, read).open.collect()} == {3}


def test_summaries(spark):
    changes = spark.createDataFrame([(1, "new"), (1, "updated"), (2, "unchanged"), (2, "skipped"), (None, "new")], "museum_id int, change_type string")
    got = {r.museum_id: (r.records, r.new, r.updated, r.unchanged, r.changed) for r in summary.of_run(summary.of_changes(changes)).collect()}
    assert got == {"1": (2, 1, 1, 0, 2), "2": (1, 0, 0, 1, 0), None: (1, 1, 0, 0, 1), "total": (4, 2, 1, 1, 3)}
    assert summary.of_run(summary.of_changes(changes.limit(0))).collect()[0].records == 0
    df = spark.range(25).withColumnRenamed("id", "seq")
    assert [r.n for r in summary.batches(df, 10).groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch").collect()] == [10, 10, 5]
    assert (summary.first_rows(df, 0).count(), summary.first_rows(df, 3).count()) == (25, 3)


def test_jobs(spark, stored, tmp_path):
    answers = spark.createDataFrame([("ming wu", "", "1500", "", "", "")], "artist_norm string, artist_wikidata_id string, artist_birth string, artist_death string, artist_bio string, artist_wikipedia_summary string")
    full = stored.withColumns({c: F.lit("") for c in ("artist_wikidata_id", "artist_death", "artist_bio", "artist_wikipedia_summary", "artist_enriched_at")})
    done = jobs.enriched(full, answers, "2026-01-01")
    assert {r.seq: r.artist_birth for r in done.records.collect()}[1] == "1500" and done.open.count() == 0
    assert (done.report.first().changed_rows, done.report.first().changed_cells) == (1, 2)
    assert jobs.enriched(full, answers.limit(0), "2026-01-01").open.count() == 1
    (tmp_path / "cache.json").write_text(json.dumps({"Bowl": "碗"}))
    (tmp_path / "broken.json").write_text('{"Bowl": ')
    cache = files.read_cache(spark, str(tmp_path / "cache.json"))
    assert files.read_cache(spark, str(tmp_path / "broken.json")).count() == files.read_cache(spark, str(tmp_path / "none.json")).count() == 0
    done = jobs.translated(stored, cache, ["title"])
    assert {r.title for r in done.records.collect()} == {"碗", "Vase", None} and [r.source for r in done.open.collect()] == ["Vase"]
    new = stored.where("seq < 3").withColumn("title", F.when(F.col("seq") == 1, "Bowl!").otherwise(F.col("title"))).unionByName(stored.where("seq = 1").withColumns({"object_id": F.lit("9"), "seq": F.lit(9).cast("long")}))
    done = jobs.loaded(stored, new, "object_id", ["title"], "seq")
    assert {r.object_id: r.title for r in done.records.collect()} == {"1": "Bowl!", "2": "Vase", "3": None, "9": "Bowl"}
    assert {r.museum_id: (r.new, r.updated, r.unchanged) for r in done.report.collect()} == {"1": (1, 1, 1), "total": (1, 1, 1)}


def test_graph_is_written_merged_and_wiped(spark, stored, tmp_path):
    at = str(tmp_path / "graph")
    first = {r.label: r.n for r in jobs.synced(spark, stored, at).collect()}
    assert first["Artifact"] == 3 and first["Museum"] == 1 and first["Artist"] == 1
    more = {r.label: r.n for r in jobs.synced(spark, stored.where("seq = 1").withColumn("object_id", F.lit("7")), at).collect()}
    assert more["Artifact"] == 4
    wiped = {r.label: r.n for r in jobs.synced(spark, stored.where("seq = 1"), at, wipe=True, names=["title"]).collect()}
    assert wiped["Artifact"] == 1 and spark.read.parquet(f"{at}/properties").select("relation").distinct().count() == 1


def test_command_line(spark, stored, tmp_path):
    stored.write.parquet(str(tmp_path / "in"))
    for job in ("clean", "export"):
        cli.main([job, str(tmp_path / "in"), str(tmp_path / job)], spark)
    assert spark.read.parquet(str(tmp_path / "clean" / "records")).count() == 3
    assert spark.read.parquet(str(tmp_path / "export" / "master")).count() > 0
    cli.main(["load", str(tmp_path / "in"), str(tmp_path / "load"), "--with", str(tmp_path / "in"), "--limit", "2"], spark)
    assert {r.unchanged for r in spark.read.parquet(str(tmp_path / "load" / "report")).collect()} == {2}


def test_search_takes_profiles_in_order(spark, tmp_path):
    for n, lists in enumerate(([["a", "b"], ["c"]], [["b", "d"]])):
        (tmp_path / f"p{n}").mkdir()
        for k, ids in enumerate(lists, 1):
            (tmp_path / f"p{n}" / f"page-{k:06d}.json").write_text(json.dumps({"records": [{"id": i} for i in ids]}))
    folders = [str(tmp_path / "p0"), str(tmp_path / "p1")]
    got = {json.loads(r.value)["id"]: (r.profile, r.page) for r in paged.search(spark, folders).collect()}
    assert got == {"a": (0, 1), "b": (0, 1), "c": (0, 2), "d": (1, 1)}
    assert paged.search(spark, folders, pages=1).count() == 3
    assert len(paged.PROFILES) == 5


def test_numbered_rows_follow_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("object_id,title\n" + "".join(f"{i},t{i}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        got = files.read_csv(spark, str(tmp_path / "a.csv"), parallel=True, ordinal=2)
        assert got.rdd.getNumPartitions() > 3
        assert {int(r.object_id) + (2 << 40) == r.seq for r in got.collect()} == {True}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
