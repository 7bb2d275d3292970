"""One key on half of the rows: results stay whole, and no task gets all of them."""

import pytest
from pyspark.sql import functions as F

from vitrine.functions.materials import cleaned, materials, primary
from vitrine.operators import changes, dedup, enrich
from vitrine.runtime import join_counted, join_keyed


@pytest.fixture(scope="module")
def rows(spark):
    n = 40_000
    return spark.range(n).select(F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "Hot Maker").when(F.col("id") % 1001 == 0, None).otherwise(F.concat(F.lit("maker "), F.col("id") % 700)).alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_keyed_is_a_join(spark, rows, how):
    right = spark.createDataFrame([("Hot Maker", 1), ("maker 7", 2), (None, 3), ("nobody", 4)], "k string, v int")
    got, want = join_keyed(rows, right, ["k"], how), rows.join(right, ["k"], how)
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
    assert join_keyed(rows.limit(0), right, ["k"], how).count() == 0


@pytest.mark.parametrize("bound", [0, 100])
def test_join_counted_is_a_join_either_way(spark, rows, bound):
    right = spark.createDataFrame([("Hot Maker",), ("maker 7",)], "k string")
    assert join_counted(rows, right, ["k"], "left_semi", bound).count() == rows.where("k IN ('Hot Maker', 'maker 7')").count()


def test_last_known_against_one_window(spark, rows):
    values = rows.withColumn("v", F.when(F.col("seq") % 997 == 3, F.concat(F.lit("Q"), "seq")))
    spread = values.withColumn("seq", F.col("seq") * 50)  # many stretches
    got = {r.seq: r.known for r in changes.last_known(spread, "k", "v", "seq").collect()}
    last: dict = {}
    for r in spread.orderBy("seq").collect():
        last[r.k] = r.v or last.get(r.k)
        assert got[r.seq] == last[r.k]
    assert len(got) == rows.count()


def test_last_known_spreads_a_hot_key(spark, rows):
    spread = rows.select((F.col("seq") * 5000).alias("seq"), F.lit("one").alias("k"), F.lit(None).cast("string").alias("v"))
    parts = changes.last_known(spread, "k", "v", "seq").groupBy(F.shiftright("seq", changes.STRETCH_BITS)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert parts <= (1 << changes.STRETCH_BITS) // 5000 + 1


def test_merge_and_translate_with_a_hot_key(spark, rows):
    df = rows.select("seq", F.col("k").alias("artist"), *[F.lit("").alias(c) for c in ("artist_wikidata_id", "artist_birth", "artist_death", "artist_bio", "artist_wikipedia_summary", "artist_enriched_at")])
    found = spark.createDataFrame([("hot maker", "Q1", "1900", "", "", "")], "artist_norm string, artist_wikidata_id string, artist_birth string, artist_death string, artist_bio string, artist_wikipedia_summary string")
    out = enrich.merge(df, found, "2026-01-01")
    assert out.count() == rows.count()
    assert out.where("artist_wikidata_id = 'Q1' AND artist_enriched_at = '2026-01-01'").count() == rows.where("k = 'Hot Maker'").count()
    cache = spark.createDataFrame([("Hot Maker", "热")], "source string, target string")
    assert enrich.translate(df, cache, ["artist"]).where("artist = '热'").count() == rows.where("k = 'Hot Maker'").count()


def test_dedup_with_blank_ids(spark):
    df = spark.range(3000).select(F.col("id").alias("seq"), F.lit(1).alias("museum_id"), F.when(F.col("id") < 2000, "").otherwise(F.col("id").cast("string")).alias("object_id"), F.lit("").alias("detail_url"), F.lit(None).cast("string").alias("accession_number"))
    out = dedup.artifacts(df)
    assert out.count() == 3000
    assert out.where("reason = 'duplicate_object_id' AND kept_by.seq = 0").count() == 1999
    assert out.where("reason IS NULL AND kept_by.seq = seq").count() == 1001


def test_best_by_key(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (3, "a", 7), (4, "b", None), (5, None, 1), (6, None, None)], "i int, k string, s int")
    assert sorted((str(r.k), r.i, r.s) for r in dedup.best_by_key(df, ["k"], "s", "i").collect()) == [("None", 5, 1), ("a", 2, 7), ("b", 4, None)]
    assert dedup.best_by_key(df.limit(0), ["k"], "s", "i").columns == df.columns


@pytest.mark.parametrize(
    ("text", "found", "main", "clean"),
    [
        ("Album leaf; ink, color and gold on silk", ["silk", "pigment", "gold", "ink"], "silk", "Album leaf; ink, color and gold on silk"),
        ("Gilt bronze", ["bronze", "gold"], "bronze", "Gilt bronze"),
        ("Overall: 12 cm; jade", ["jade"], "jade", "jade"),
        ("mother of pearl inlay on wood", ["wood", "shell"], "wood", "mother of pearl inlay on wood"),
        ("rhino horn, rhino horn", ["rhinoceros horn", "horn"], "rhinoceros horn", "rhino horn, rhino horn"),
        ("inscribed", [], "", "inscribed"),
        ("Gansu province", [], "", "Gansu province"),
        ("paper; Paper; 12 x 5 cm", ["paper"], "paper", "paper"),
        ("", [], "", ""),
        (None, [], "", ""),
    ],
)
def test_materials(spark, text, found, main, clean):
    df = spark.createDataFrame([(text,)], "m string").select(materials("m").alias("m"), cleaned("m").alias("c"))
    r = df.select("m", "c", primary(F.col("m")).alias("p")).first()
    assert (list(r.m), r.p, r.c) == (found, main, clean)
