import pytest
from pyspark.sql import functions as F

from vitrine.functions import classify, periods, records, text, urls
from vitrine.functions.materials import cleaned, materials, primary, with_materials


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("period", "years"),
    [("Tang dynasty, 618-907", (618, 907)), ("206 BCE - 220 CE", (-206, 220)), ("c. 2600-2000 BCE", (-2600, -2000)), ("late 1700s", (1700, 1700)), ("11th-early 12th century", (1101, 1200)), ("5th century BCE", (-500, -401)), ("Qing - Qianlong, 1736-1795", (None, None)), ("", (None, None)), (None, (None, None))],
)
def test_period_years(spark, period, years):
    r = one(spark, periods.period_years(F.lit(period).cast("string")))
    assert (r.start, r.end) == years


@pytest.mark.parametrize(("years", "era"), [((618, 907), "Tang（唐）"), ((1700, 1700), "Qing（清）"), ((-10000, -9000), ""), ((1101, 1200), "Southern Song（南宋）"), ((960, 960), "Five Dynasties（五代）"), ((907, 618), "Tang（唐）")])
def test_era_of_years(spark, years, era):
    assert one(spark, periods.era_of_years(F.lit(years[0]), F.lit(years[1]))) == era


def test_era_prefers_early_cultures_in_words(spark):
    assert one(spark, periods.era(F.lit("Longshan, Neolithic, 1900"), F.lit(1900), F.lit(1900))) == "Neolithic（新石器时代）"
    assert one(spark, periods.era(F.lit("Ming style, 1800"), F.lit(None).cast("int"), F.lit(None).cast("int"))) == "Qing（清）"


@pytest.mark.parametrize(("value", "day"), [("1720", "1720-01-01"), ("1720-05", "1720-05-01"), ("-519", "-0519-01-01"), ("2024-01-02T03:04", "2024-01-02"), ("soon", "soon"), (None, "")])
def test_iso_date(spark, value, day):
    assert one(spark, periods.iso_date(F.lit(value).cast("string"))) == day


def test_keys(spark):
    assert one(spark, text.norm_key(F.lit("Smith, John ()"))) == "smith john "
    assert one(spark, text.slug(F.lit("Washington, DC, USA"))) == "washington-dc-usa"
    assert one(spark, text.slug(F.lit("!!"))) == "unknown"
    assert one(spark, text.entity_uri("http://b", F.lit("entity:artist:Q123"))) == "http://b/entity/artist/Q123"
    assert one(spark, text.split_artists(F.lit("San, Lee Chiao"))) == ["San", "Lee Chiao"]
    assert one(spark, text.lookup_name(F.lit("San, Lee Chiao; Field Gallery"))) == "San, Lee Chiao"
    assert one(spark, text.split_cultures(F.lit("A1; a1; B2; x"))) == ["A1", "B2"]
    assert one(spark, text.strip_html(F.lit("a &lt;b&gt;c&lt;/b&gt;<br>d"))) == "a c d"


@pytest.mark.parametrize(("value", "found", "main"), [("Ink on paper", ["paper", "ink"], "paper"), ("Gilt bronze", ["bronze", "gold"], "bronze"), ("Album leaf; ink, color and gold on silk", ["silk", "pigment", "gold", "ink"], "silk"), ("handscroll", [], ""), ("", [], "")])
def test_materials(spark, value, found, main):
    assert one(spark, materials(F.lit(value))) == found and one(spark, primary(materials(F.lit(value)))) == main


def test_cleaned_material(spark):
    assert one(spark, cleaned(F.lit("Bronze; H x W x D: 10 x 20 cm; bronze"))) == "Bronze"
    assert one(spark, cleaned(F.lit(None).cast("string"))) == ""


def test_material_columns(spark):
    df = spark.createDataFrame([(1, "Ink on silk", "old"), (2, None, "old")], "seq int, material string, primary_material string")
    assert [(r.primary_material, r.materials) for r in with_materials(df).orderBy("seq").collect()] == [("silk", ["silk", "ink"]), ("", [])]


def test_types_and_places(spark):
    assert [one(spark, classify.standard_type(F.lit(t))) for t in ("lacework", "marigold", "footprint", "Odd thing", "")] == ["Textiles", "Metalwork", "Prints", "Odd thing", ""]
    assert one(spark, classify.province(F.lit("from Hunan"))) == "Hunan" and one(spark, classify.province(F.lit("Old Kent Province"))) == "Old Kent"


def test_urls(spark):
    assert one(spark, urls.extension(F.lit("http://a.example/b.JPEG?x"))) == "jpeg" and one(spark, urls.extension(F.lit("not a url"))) == "jpg"
    assert one(spark, urls.image_key(F.lit("http://a.example/d?id=HS-1.jpg&max=3"))) == "HS-1"
    assert one(spark, urls.without_param(F.lit("http://a.example/d?id=1&max=3"), "max")) == "http://a.example/d?id=1"


def test_object_api_record(spark):
    v = '{"id": 7, "title": " Bowl ", "period": {"name": "Tang dynasty, 618-907"}, "classification": {"name": "Vessels"}, "people": [{"name": "Wu"}, {"displayname": "Xu"}], "culture": ["Chinese", {"name": "Yi"}], "url": "http://a.example/7", "primaryimageurl": "http://i.example/1", "images": [{"iiifbaseurl": "http://i.example/1"}, {"baseimageurl": "http://i.example/2"}]}'
    r = records.from_objects(spark.createDataFrame([(v,), ("broken",), (None,)], "value string")).collect()
    assert len(r) == 1
    assert (r[0].title, r[0].artist, r[0].dynasty, r[0].type, r[0].culture, r[0].detail_url, r[0].image_count) == ("Bowl", "Wu; Xu", "Tang（唐）", "Vessels", "Chinese; Yi", "https://a.example/7", "2")


def test_open_access_record(spark):
    v = '{"id": "x1", "title": "Cup", "content": {"descriptiveNonRepeating": {"record_ID": "r1", "online_media": {"media": [{"label": "thumb", "content": "http://i.example/d?id=A.jpg&max=9"}, {"label": "full", "content": "http://i.example/d?id=A.jpg"}]}}, "indexedStructured": {"culture": ["Chinese"]}, "freetext": {"name": [{"content": "Wu"}], "date": [{"content": "1720"}]}}}'
    r = records.from_open_access(spark.createDataFrame([(v,), ("[]",), ("{",)], "value string")).collect()
    assert [(x.object_id, x.artist, x.period_start_year, x.image_count) for x in r] == [("r1", "Wu", "1720", "1")]


def test_page_record(spark):
    page = '<html><meta property="og:image" content="http://i.example/p"><div class="detailField titleField"><h1>Vase</h1></div><div class="detailField invnolineField"><span class="detailFieldLabel">No</span><span class="detailFieldValue">12.3</span></div></html>'
    rows = [("http://m.example/objects/5/vase;x", page), ("http://m.example/objects/6", "Access denied")]
    r = records.from_pages(spark.createDataFrame(rows, "url string, html string")).collect()
    assert [(x.object_id, x.title, x.accession_number, x.image_url, x.detail_url) for x in r] == [("12.3", "Vase", "12.3", "http://i.example/p", "http://m.example/objects/5/vase")]
    links = spark.createDataFrame([('<a href="/objects/5/a;1">x</a><a href="/objects/5/a?q">y</a>',)], "html string")
    assert [x.detail_url for x in records.page_links(links, base="http://m.example").collect()] == ["http://m.example/objects/5/a"]
