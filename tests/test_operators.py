import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine import schema
from vitrine.operators import changes, components, dedup, enrich, images, listing, quality, registry
from vitrine.plans import pipelines
from vitrine.sources import files, sinks
from vitrine.sources.paged import PagedSource
from vitrine.streaming.replay import read_state, replay


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_dedup_stages_follow_each_other(spark):
    data = [(1, 1, "a", "u1", "x"), (2, 1, "a", "u2", "y"), (3, 1, "b", "u1", "z"), (4, 1, "c", "", "x"), (5, 1, "d", None, "z"), (6, 2, "a", "u1", "x"), (7, 1, "e", " u9 ", ""), (8, 1, "f", "u9", "")]
    df = spark.createDataFrame(data, "seq long, museum_id int, object_id string, detail_url string, accession_number string")
    got = {r.seq: (r.reason, r.kept_by.seq) for r in dedup.artifacts(df).where("reason IS NOT NULL").collect()}
    # 2 lost at once, so its page u2 blocks nobody; 3 lost by page, so its number z is free for 5
    assert got == {2: ("duplicate_object_id", 1), 3: ("duplicate_detail_url", 1), 4: ("duplicate_accession_number", 1), 8: ("duplicate_detail_url", 7)}
    assert dedup.artifacts(df.limit(0)).count() == 0


def test_diff_and_upsert(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", None), ("2", "ignored", "x")], "object_id string, title string, type string")
    new = spark.createDataFrame([("1", " a ", "x"), ("2", "b2", ""), ("3", "c", "y"), ("", "n", "n"), (None, "n", "n")], old.schema)
    got = {(r.object_id, r.change_type, tuple(r.changed_fields)) for r in changes.diff(old, new, "object_id", ["title", "type"]).collect()}
    assert got == {("1", "unchanged", ()), ("2", "updated", ("title",)), ("3", "new", ("title", "type")), ("", "skipped", ())}
    up = changes.upsert(old.where("title <> 'ignored'"), new.where("object_id IN ('2', '3')"), ["object_id"])
    assert rows(up) == [("1", "a", "x"), ("2", "b2", ""), ("3", "c", "y")]
    filled = changes.upsert(old.where("title <> 'ignored'"), spark.createDataFrame([("2", "zz", "filled")], old.schema), ["object_id"], fill=True)
    assert ("2", "b", "filled") in rows(filled)


def test_fingerprint_equals_compact_json(spark):
    import hashlib

    df = spark.createDataFrame([("é", None, " x ")], "title string, type string, artist string")
    want = hashlib.sha256(json.dumps({"artist": "x", "title": "é", "type": ""}, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert df.select(changes.fingerprint(["title", "type", "artist"]).alias("f")).first().f == want


def test_last_known_and_watermark(spark):
    df = spark.createDataFrame([(1, "k", ""), (2, "k", "Q1"), (3, "k", None), (4, "j", None)], "seq int, k string, v string")
    assert {r.seq: r.known for r in changes.last_known(df, "k", "v", "seq").collect()} == {1: None, 2: "Q1", 3: "Q1", 4: None}
    assert changes.watermark(df.withColumn("source_updated_at", F.col("v"))).first().watermark == "Q1"
    assert changes.since(df, "Q1", "v").count() == 3


def test_components_against_brute_force(spark):
    import random

    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*edges, (None, 1)], "a int, b int")).collect()}
    assert got == {n: find(n) for n in list(parent)}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_registry(spark):
    data = [(1, 1, "a", "Bowl", "Wu", "Q5", "Ink on paper"), (2, 1, "b", "Cup", "wu", "", ""), (3, 1, "c", "Vase", "Xu; Wu", "", None), (4, 1, "", "No id", "Wu", "", "")]
    df = spark.createDataFrame(data, "seq long, museum_id int, object_id string, title string, artist string, artist_wikidata_id string, material string")
    m = registry.resolve(registry.mentions(df))
    ids = {(r.seq, r.label): r.canonical_id for r in m.where("entity_type = 'Artist'").collect()}
    assert ids == {(1, "Wu"): "entity:artist:Q5", (2, "wu"): "entity:artist:Q5", (3, "Xu"): "entity:artist:xu", (3, "Wu"): "entity:artist:Q5"}
    master = {r.canonical_id: (r.label, r.external_id, r.source_count) for r in registry.masters(m).collect()}
    assert master["entity:artist:Q5"] == ("Wu", "Q5", 3) and master["entity:material:paper"][2] == 2
    rel = {(r["from"], r.relation, r.to) for r in registry.relations(m).collect()}
    assert ("entity:artifact:1:a", "hasPrimaryMaterial", "entity:material:paper") in rel and ("entity:artifact:1:a", "usesMaterial", "entity:material:ink") in rel
    props = {(r.relation, r.to) for r in registry.properties(df).where("`from` = 'entity:artifact:1:a'").collect()}
    assert {("title", "Bowl"), ("materialBase", "paper | ink"), ("artistWikidataId", "Q5")} <= props
    nodes = spark.createDataFrame([("entity:artifact:1:a",)], "id string")
    assert registry.with_properties(nodes, registry.properties(df), ["title"]).first().title == "Bowl"
    assert registry.implied_nodes(nodes, registry.relations(m)).where("label = 'Artist'").count() == 2
    assert registry.graph_counts(nodes, registry.relations(m).limit(0)).count() == 0
    assert registry.resolve(registry.mentions(df.limit(0))).count() == 0


def test_listing(spark):
    df = spark.createDataFrame([(1, str(i), f"Bowl {i}", "a.jpg|b.png" if i % 2 else "", None, 0) for i in range(30)], "museum_id int, object_id string, title string, image_paths string, image_path string, image_count int")
    assert listing.page(df, ["museum_id", "object_id"], 2, 5, like={"title": "bowl"}).count() == 5
    assert listing.page(df, ["object_id"], 0, 0).count() == 1 and listing.total(df, like={"title": "b_wl 1%"}).first().total == 11
    shown = {r.object_id: r for r in listing.shown(df).collect()}
    assert shown["1"].imgs_web == ["/api/img/1/1", "/api/img/1/1/1"] and shown["1"].image_count == 2 and not shown["2"].has_local_image
    assert listing.nth_image(df, 1).first().media_type == "image/png"
    got = listing.resolve_paths(spark.createDataFrame([("images/a.jpg",), ("x/b.jpg",)], "path string"), ["/r1", "/r2"], spark.createDataFrame([("/r2/a.jpg",), ("/r1/b.jpg",), ("/r2/b.jpg",)], "path string"))
    assert rows(got) == [("images/a.jpg", "/r2/a.jpg"), ("x/b.jpg", "/r1/b.jpg")]


def test_images(spark):
    df = spark.createDataFrame([(1, "u1", "u1 | u2"), (2, "u2", "u2"), (3, "u1", "u1"), (4, None, None)], "seq int, image_url string, image_urls string")
    checks = spark.createDataFrame([(1, "u1", True, 200, "i", 1), (2, "u1", False, 404, "i", 2), (3, "u2", True, 200, "i", 1), (4, None, True, 200, "i", 1)], "check_id long, image_url string, valid boolean, status_code int, content_type string, checked_at int")
    got = {r.seq: (r.image_url, r.image_urls) for r in images.repaired(df, checks).collect()}
    assert got == {1: ("u2", "u2"), 2: ("u2", "u2"), 3: ("", ""), 4: (None, None)}
    assert images.repaired(df, checks, drop=True).count() == 2


def test_enrichment(spark):
    base = schema.texts(spark.createDataFrame([("Wu  Bo", "", "1700"), ("wu bo", "Q9", "")], "artist string, artist_wikidata_id string, artist_birth string"))
    found = spark.createDataFrame([("wu bo", "Q1", "1701", "1760", "b", "s")], "artist_norm string, artist_wikidata_id string, artist_birth string, artist_death string, artist_bio string, artist_wikipedia_summary string")
    got = [(r.artist_wikidata_id, r.artist_birth, r.artist_enriched_at) for r in enrich.merge(base, found, "2026-01-01").orderBy("artist").collect()]
    assert got == [("Q1", "1700", "2026-01-01"), ("Q9", "1701", "2026-01-01")]
    assert [(r.artist_norm, r["rows"]) for r in enrich.lookups(base.withColumn("seq", F.lit(1))).collect()] == [("wu bo", 2)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", ""), (1, None, " ")], "k int, x string, y string")
    assert {(r.column, r.blank) for r in quality.blank_counts(df, ("x", "y")).collect()} == {("x", 1), ("y", 2)}
    assert quality.changed_cells(df.limit(1), df.limit(1).withColumn("x", F.lit("z")), "k", ["x", "y"]).first().changed_cells == 1


def test_csv_round_trip(spark, tmp_path):
    df = schema.texts(spark.createDataFrame([("1", 'say "hi",\nall', None)], "object_id string, title string, artist string"))
    sinks.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"))
    assert back.first().title == 'say "hi",\nall' and back.first().artist == ""
    (tmp_path / "bom.csv").write_text("﻿object_id,title\n7, x \n", encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "bom.csv")).first().object_id == "7"
    assert files.read_csv(spark, str(tmp_path / "none.csv")).count() == 0
    assert [r.seq for r in files.read_csv(spark, str(tmp_path / "c"), ordinal=1).collect()] == [1 << 40]
    (tmp_path / "a.fixed.csv").write_text("x")
    (tmp_path / "a.csv").write_text("y")
    assert files.first_existing(spark, [str(tmp_path / "a.fixed.csv"), str(tmp_path / "a.csv")]) == [str(tmp_path / "a.fixed.csv")]


def test_lines_pages_and_relations(spark, tmp_path):
    (tmp_path / "s1.txt").write_text('{"a": 1}\nbroken\n')
    (tmp_path / "index.txt").write_text("s1.txt\n")
    assert files.read_shards(spark, str(tmp_path / "index.txt")).count() == 1
    for n, recs in ((1, [1, 2]), (2, [3])):
        (tmp_path / f"page-{n:06d}.json").write_text(json.dumps({"records": recs, "info": {"next": "x"}}))
    spark.dataSource.register(PagedSource)
    got = spark.read.format("paged").options(path=str(tmp_path), pages=4, splits=1, size=2).load()
    assert rows(got) == [(1, "1"), (1, "2"), (2, "3")]
    t = spark.createDataFrame([("a", "r1", "b"), ("a", "r2", "c"), ("d", "r2", "c")], "from string, relation string, to string")
    assert rows(sinks.write_relations(t, str(tmp_path / "rel"))) == [("r1", 1), ("r2", 2)]
    assert (tmp_path / "rel" / "relation=r1").exists()


def test_schema(spark):
    t = schema.typed(schema.texts(spark.createDataFrame([("x", "12", "nope")], "museum_id string, period_start_year string, crawl_date string")), "2026-01-01").first()
    assert (t.museum_id, t.period_start_year, str(t.crawl_date)) == (0, 12, "2026-01-01")
    target = T.StructType([T.StructField("b", T.LongType()), T.StructField("c", T.StringType())])
    assert schema.reconcile(spark.createDataFrame([(1,)], "a int"), target, {"a": "b"}, {"c": "d"}).first() == (1, "d")


def test_clean_pipeline(spark):
    data = [(1, 1, "a", "Bowl", "u1"), (2, 1, "a", "Bowl again", "u2"), (3, 1, "b", "Cup", "u1")]
    df = spark.createDataFrame(data, "seq long, museum_id int, object_id string, title string, detail_url string")
    out, dups, report = pipelines.clean(df)
    assert rows(report) == [(3, 1, 2)] and out.first().title == "Bowl" and out.first().source_updated_at == ""
    assert rows(dups.select("seq", "reason")) == [(2, "duplicate_object_id"), (3, "duplicate_detail_url")]


def test_stream_replay_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    s = "object_id string, title string"
    sch = T._parse_datatype_string(s)
    for n, data in enumerate([[("1", "a"), ("2", "b")], [("2", "b2"), ("3", "c")], [("3", "c")]]):
        spark.createDataFrame(data, s).coalesce(1).write.mode("append").parquet(src)
    seen = []
    args = (spark, src, sch, str(tmp_path / "state"), str(tmp_path / "feed"), str(tmp_path / "cp"), "object_id", ["title"])
    replay(*args, on_change=seen.append)
    replay(*args)
    final = {r.object_id: r.title for r in read_state(spark, str(tmp_path / "state"), sch).collect()}
    assert set(final) == {"1", "2", "3"} and sum(seen) >= 3
    touched = [len(list(p.glob("part_of=*"))) for p in (tmp_path / "state").glob("batch=*")]
    assert min(touched) == 0 and max(touched) <= 2, "a batch rewrites the parts its changes fall in"
    feed = spark.read.parquet(str(tmp_path / "feed"))
    assert feed.where("change_type = 'new'").count() == 3


def test_every_query_has_its_columns(spark):
    from vitrine.plans.queries import QUERIES, SQL

    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 45
    for name in ("p4_found", "p6_found", "api_list_page", "dedup_stages", "era_of_years"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").columns


@pytest.mark.parametrize("name", ["dedup_stages", "keys_and_slugs", "era_of_years", "snapshot_diff", "image_states", "triples", "resolved_masters", "resolved_aliases", "entity_triples", "all_properties", "run_summary", "loaded_table", "refreshed_records", "maker_segments", "image_repair", "maker_lookups"])
def test_against_sql(spark, name):
    import duckdb

    import vitrine.plans.field_queries  # noqa: F401
    from vitrine.plans.queries import QUERIES, SQL

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("artifact", "image_check"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, d).select(*columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_lookups_and_pieces(spark):
    from vitrine.functions import lookup

    df = spark.createDataFrame([([("normal", "+1700-05-03T00:00:00Z", 11), ("preferred", "-0519-00-00T00:00:00Z", 9)], ["Q5"], {"en": "painter", "zh": " "}), (None, None, None)], "claims array<struct<rank:string,time:string,precision:int>>, p31 array<string>, d map<string,string>")
    got = df.select(lookup.best_time("claims").alias("t"), lookup.is_human("p31").alias("h"), lookup.in_languages("d").alias("d")).collect()
    assert [tuple(r) for r in got] == [("0519", True, "painter"), ("", False, "")]
    text = "One two. " * 1000
    assert all(len(p) <= 100 for p in lookup.pieces(text, 100)) and "".join(lookup.pieces(text, 100)).replace(" ", "") == text.replace(" ", "")
    assert lookup.pieces("x" * 250, 100) == ["x" * 100, "x" * 100, "x" * 50]
    assert lookup.in_pieces(spark.createDataFrame([(1, "a b"), (2, None)], "k int, t string"), "k", "t").count() == 1


def test_files_of_images_and_catalog(spark):
    from vitrine.sources import catalog

    df = spark.createDataFrame([(1, "a", "old", "", 9), (1, "b", "images/x.jpg", "images/x.jpg | /abs/y.jpg", 1)], "museum_id int, object_id string, image_path string, image_paths string, image_count int")
    fs = spark.createDataFrame([(1, "a", "p2"), (1, "a", "p1")], "museum_id int, object_id string, path string")
    got = {r.object_id: (r.image_path, r.image_paths, r.image_count) for r in images.with_files(df, fs).collect()}
    assert got == {"a": ("p1", "p1 | p2", 2), "b": ("", "", 0)}
    assert images.moved(df.where("object_id = 'b'"), "/srv").first().image_paths == "/srv/images/x.jpg | /abs/y.jpg"
    df.createOrReplaceTempView("some_images")
    assert catalog.columns(spark).where("name = 'some_images'").count() == 5
    assert rows(catalog.table_counts(spark, ["some_images", "none_such"])) == [("some_images", 2)]
