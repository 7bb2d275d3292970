"""Registered queries of single functions and small operators over the artifact tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schema
from vitrine.functions import classify, materials, pages, periods, records, text, urls
from vitrine.operators import enrich, images, listing, quality, registry, repair, summary
from vitrine.plans import jobs
from vitrine.plans.queries import S_ERAS, S_ID, SQL, artifact, era_sql, query, s_norm, s_slug, s_strip
from vitrine.runtime import table


#: DuckDB: the parts of a field at a pattern, stripped, blank ones dropped.
def s_parts(field: str, pattern: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array(coalesce({field}, ''), '{pattern}'), lambda x: {s_strip('x')}), lambda x: x <> '')"


# ---- texts -----------------------------------------------------------------------------------------------------------


@query(rf"""SELECT seq, CASE WHEN lower({s_strip('period')}) IN ('none', 'null', 'nan') THEN '' ELSE {s_strip('period')} END AS value,
substr(lower(regexp_replace({s_strip('artist')}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), 1, 400) AS key,
substr(regexp_replace(title, '[<>:"/\\|?*\s\x{{00a0}}\x{{3000}}\x00-\x1f]', '_', 'g'), 1, 160) AS fragment FROM artifact""")
def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as values, as maker keys, as parts of file names."""
    return artifact(spark, sf_dir).select("seq", text.value("period").alias("value"), text.artist_key("artist").alias("key"), text.safe_fragment("title").alias("fragment"))


@query(rf"""SELECT seq, CASE WHEN len(d) > 120 THEN concat(regexp_replace(substr(d, 1, 119), '\s+$', ''), '…') ELSE d END AS short FROM (SELECT seq, {s_strip('description')} AS d FROM artifact)""")
def shortened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions cut to 120 characters."""
    return artifact(spark, sf_dir).select("seq", text.shorten("description", 120).alias("short"))


@query(rf"""SELECT seq, array_to_string({s_parts('image_paths', chr(92) + '|')}, '; ') AS paths, len({s_parts('image_urls', chr(92) + '|')}) AS urls FROM artifact""")
def listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed paths as a list joined by semicolons, and the number of addresses."""
    return artifact(spark, sf_dir).select("seq", text.join_list(text.split_paths("image_paths")).alias("paths"), F.size(text.split_paths("image_urls")).alias("urls"))


S_TAGS = r"regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(coalesce(description, ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'), '<br\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g')"


@query(rf"""SELECT seq, regexp_replace({s_strip('t')}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g') AS plain FROM (SELECT seq, {S_TAGS} AS t FROM artifact)""".replace('\\"', '"'))
def without_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions without entities and tags."""
    return artifact(spark, sf_dir).select("seq", text.strip_html("description").alias("plain"))


S_KEPT = "list_filter([{0}], lambda x: x <> '' AND x <> t)"
S_VALUES = {c: f"CASE WHEN lower({s_strip(c)}) IN ('none', 'null', 'nan') THEN '' ELSE {s_strip(c)} END" for c in ("title", "period", "type", "culture")}


@query(f"""WITH v AS (SELECT seq, {S_VALUES['title']} AS t, {S_VALUES['period']} AS p, {S_VALUES['type']} AS y, {S_VALUES['culture']} AS c FROM artifact),
k AS (SELECT seq, {S_KEPT.format('p, y, c')} AS l FROM v)
SELECT seq, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS merged FROM k""")
def merged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of several columns as one text."""
    return artifact(spark, sf_dir).select("seq", text.merge_texts([F.col("period"), F.col("type"), F.col("culture")], text.value("title")).alias("merged"))


# ---- makers ------------------------------------------------------------------------------------------------------------

S_SEGMENTS = "list_transform(" + s_parts("artist", r"(?i)\s*(?:;|、|/|\band\b)\s*") + ", lambda x: substr(x, 1, 200))"
S_KNOWN = "(" + ", ".join("'" + " ".join(k.split()).lower().replace("'", "''") + "'" for k in text.COLLECTORS) + ")"
S_DEALER = r"(len(x) < 2 OR regexp_matches(x, '(?i)(?:&\s*co\.?|company|guild|gallery|museum|dealer|foundation|trust)\b') OR regexp_matches(x, '(?i)^freer(?:\s*,\s*charles\s+lang|\s+gallery)?\b|charles\s+lang\s+freer') OR substr(lower(regexp_replace(x, '[\s\x{00a0}\x{3000}]+', ' ', 'g')), 1, 400) IN " + S_KNOWN + ")"
S_POINTS = r"(CASE WHEN regexp_matches(x, '[\x{4e00}-\x{9fff}]') THEN 12 ELSE 0 END + CASE WHEN regexp_matches(x, '[A-Za-z]{2,}') THEN 4 ELSE 0 END + CASE WHEN regexp_matches(x, ',\s*[A-Za-z]') THEN 2 ELSE 0 END + CASE WHEN len(x) >= 8 THEN 1 ELSE 0 END)"
S_BARE = r"substr(" + s_strip(r"regexp_replace({0}, '(?i)^(?:(?:traditionally\s+)?(?:attributed|formerly\s+attributed|possibly|probably)\s+to|style\s+of|circle\s+of|workshop\s+of|follower\s+of|copy\s+of|after|before)\s*:?\s*', '')").replace("{{", "{").replace("}}", "}") + ", 1, 200)"


@query(rf"""WITH s AS (SELECT seq, unnest({S_SEGMENTS}) AS x, generate_subscripts({S_SEGMENTS}, 1) AS pos FROM artifact)
SELECT seq, pos, x AS segment, {S_DEALER} AS dealer, {S_POINTS} AS points FROM s""")
def maker_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of maker fields: is it a dealer, and how much does it look like a maker?"""
    s = artifact(spark, sf_dir).select("seq", F.posexplode(text.artist_segments("artist")).alias("pos", "segment"))
    return s.select("seq", (F.col("pos") + 1).cast("long").alias("pos"), "segment", text.is_dealer("segment").alias("dealer"), text.segment_priority("segment").alias("points"))


S_CHOSEN = rf"""SELECT seq, x FROM (SELECT seq, x, pos, {S_POINTS} AS points, {S_DEALER} AS dealer FROM (SELECT seq, unnest({S_SEGMENTS}) AS x, generate_subscripts({S_SEGMENTS}, 1) AS pos FROM artifact)) WHERE NOT dealer QUALIFY row_number() OVER (PARTITION BY seq ORDER BY points DESC, pos) = 1"""
S_LOOKUP = "WITH n AS (SELECT seq, " + S_BARE.replace("{0}", "x") + f" AS name FROM ({S_CHOSEN}))"


@query(S_LOOKUP + "SELECT a.seq, coalesce(n.name, '') AS name FROM artifact a LEFT JOIN n USING (seq)")
def lookup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name each record's maker would be looked up by."""
    return artifact(spark, sf_dir).select("seq", text.lookup_name("artist").alias("name"))


S_GAP = "(" + " OR ".join(f"{s_strip(c)} = ''" for c in schema.ENRICHED) + ")"


SQL["maker_lookups"] = (S_LOOKUP + rf""", w AS (SELECT a.seq, substr(lower(regexp_replace({s_strip('artist')}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), 1, 400) AS artist_norm, n.name FROM artifact a JOIN n USING (seq) WHERE {s_strip('artist')} <> '' AND {S_GAP} AND n.name <> '')
SELECT artist_norm, arg_min(name, seq) AS name, count(*) AS "rows" FROM w GROUP BY artist_norm""")


@query(rf"""SELECT seq, {S_BARE.replace('{0}', 'artist')} AS bare, substr(trim(regexp_replace(regexp_replace({s_strip('artist')}, '(?i)\s*\((?:Chinese|Sino-Tibetan|active|born|after)[^)]*\)\s*', ' ', 'g'), '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), 1, 200) AS plain FROM artifact""")
def bare_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Makers without attributions, and without what brackets say."""
    return artifact(spark, sf_dir).select("seq", text.without_attribution("artist").alias("bare"), text.without_brackets("artist").alias("plain"))


# ---- addresses ---------------------------------------------------------------------------------------------------------


@query(r"""WITH u AS (SELECT seq, lower(image_url) AS u, image_url AS x, lower(coalesce(title, '')) AS n FROM artifact WHERE image_url IS NOT NULL)
SELECT seq, CASE WHEN contains(u, 'thumb') OR contains(n, 'thumb') OR contains(n, 'small') OR contains(u, '150') THEN -70 ELSE 0 END + CASE WHEN contains(u, 'deliver') THEN 50 ELSE 0 END
+ CASE WHEN regexp_matches(n, 'high|full|original|large|tiff|master') THEN 40 ELSE 0 END + CASE WHEN regexp_matches(u, '\.(?:jpe?g|png)$') THEN 20 ELSE 0 END + CASE WHEN contains(u, '/download?') AND contains(u, '.tif') THEN 5 ELSE 0 END AS score,
regexp_replace(regexp_replace(x, '([?&])id=[^&#]*&?', '\1', 'gi'), '[?&]$', '') AS without_id,
regexp_replace(regexp_replace(regexp_replace(x, '[\s/]+$', ''), '/full/[^/]+/\d+/default\.(?:jpe?g|png|webp)$', '', 'i'), '_dynmc$', '') AS base FROM u""")
def image_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good a rendition is, its address without one parameter, and the base of its service."""
    a = artifact(spark, sf_dir).where("image_url IS NOT NULL")
    return a.select("seq", urls.image_score("title", "image_url").alias("score"), urls.without_param("image_url", "id").alias("without_id"), urls.iiif_base("image_url").alias("base"))


S_LIST = s_parts("image_urls", r"\|")


@query(rf"""WITH f AS (SELECT seq, l, list_filter(l, lambda x: contains(lower(x), 'deliver') OR regexp_matches(x, '(?i)\.(?:jpe?g|png|webp)(?:\?|$)')) AS s FROM (SELECT seq, {S_LIST} AS l FROM artifact)),
k AS (SELECT seq, CASE WHEN len(s) > 0 THEN s[1:8] ELSE l[1:1] END AS k FROM f)
SELECT seq, coalesce(k[1], '') AS image_url, array_to_string(k, ' | ') AS image_urls, len(k)::varchar AS image_count FROM k""")
def folded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image columns of a record from its list: what a browser shows, eight at most."""
    folded = urls.fold_images(urls.web_images(text.split_paths("image_urls")))
    return artifact(spark, sf_dir).select("seq", *[x.alias(c) for c, x in folded.items()])


@query(rf"""SELECT seq, CASE WHEN u NOT LIKE 'http%' THEN '' WHEN regexp_matches(u, '(?i)\.(?:jpe?g|png|webp)(?:\?|$)|/full/') THEN u
WHEN regexp_replace(u, '_dynmc$', '') <> u THEN concat_ws(' | ', u || '/full/!800,800/0/default.jpg', u || '/full/full/0/default.jpg', regexp_replace(u, '_dynmc$', '') || '/full/!800,800/0/default.jpg', regexp_replace(u, '_dynmc$', '') || '/full/full/0/default.jpg')
ELSE concat_ws(' | ', u || '/full/!800,800/0/default.jpg', u || '/full/full/0/default.jpg') END AS variants FROM (SELECT seq, regexp_replace({s_strip("coalesce(nullif(trim(iiif_manifest_url), ''), image_url)")}, '/+$', '') AS u FROM artifact)""")
def service_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renditions of an image service's address."""
    u = F.coalesce(F.nullif(F.trim("iiif_manifest_url"), F.lit("")), "image_url")
    return artifact(spark, sf_dir).select("seq", F.array_join(pages.iiif_variants(u), " | ").alias("variants"))


@query(rf"""SELECT seq, CASE WHEN u NOT LIKE 'http%' THEN '' WHEN contains(u, 'ids.lib.harvard.edu/mps/') THEN u || '/info.json' WHEN contains(u, 'nrs.harvard.edu') OR contains(lower(u), 'iiif') THEN u || '/manifest' ELSE '' END AS manifest
FROM (SELECT seq, regexp_replace(regexp_replace(regexp_replace({s_strip('image_url')}, '/+$', ''), '/full/[^/]+/\d+/default\.(?:jpe?g|png|webp)$', '', 'i'), '_dynmc$', '') AS u FROM artifact)""")
def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the images of a record are described, as far as its main image tells."""
    none = F.array().cast("array<string>")
    return artifact(spark, sf_dir).select("seq", pages.iiif_manifest(none, none, "image_url").alias("manifest"))


@query(rf"""SELECT seq, regexp_replace(regexp_replace({s_strip('detail_url')}, '[;?].*$', ''), '/+$', '') AS page, regexp_extract(coalesce(detail_url, ''), '/objects/(\d+)(?:/|$)', 1) AS number FROM artifact""")
def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of object pages and the numbers in their addresses."""
    return artifact(spark, sf_dir).select("seq", pages.page_key("detail_url").alias("page"), pages.number_in_address("detail_url").alias("number"))


@query(r"""SELECT seq, array_to_string(list_transform(list_filter(string_split(coalesce(image_paths, ''), '|'), lambda x: true), lambda x: x), '|') IS NOT NULL AS ok, CASE WHEN image_path IS NULL THEN NULL ELSE regexp_replace(image_path, '^([^/\s|:][^|:]*|[^/\s|:])', 'store/\1') END AS image_path FROM artifact""")
def moved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative main image paths put under a prefix."""
    m = images.moved(artifact(spark, sf_dir).select("seq", "image_path"), "store/", ("image_path",))
    return m.select("seq", F.lit(True).alias("ok"), "image_path")


# ---- pages -------------------------------------------------------------------------------------------------------------

S_CONTROLS = "(" + ", ".join("'" + c + "'" for c in pages.CONTROLS) + ")"


@query(rf"""SELECT doc_id, CASE WHEN len(t) > 2000 THEN substr(t, 1, 1999) || '…' ELSE t END AS value FROM (SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce("text", ''), '\r\n|[\n\r]'), lambda x: {s_strip('x')}), lambda x: x <> '' AND lower(x) NOT IN {S_CONTROLS}), ' ') AS t FROM documents)""")
def field_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of pages without blank lines and controls, 2,000 characters at most."""
    return table(spark, sf_dir, "documents").select("doc_id", pages.field_value("text").alias("value"))


@query(r"""SELECT seq, len(trim(t)) < 40 OR regexp_matches(t, 'access denied|request blocked|verify you are human|captcha|checking your browser|enable javascript|unusual traffic') AS blocked, regexp_matches(concat_ws(' ', title, description), '(?i)\b(?:bowl|vase)\b') AS about FROM (SELECT *, lower(substr(coalesce(description, ''), 1, 20000)) AS t FROM artifact)""")
def page_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does a text turn the reader away, and is a record about bowls or vases?"""
    a = artifact(spark, sf_dir)
    return a.select("seq", classify.is_blocked_page("description").alias("blocked"), classify.about("bowl|vase", "title", "description").alias("about"))


# ---- periods -----------------------------------------------------------------------------------------------------------

S_YEAR = "CASE WHEN {0} < 0 THEN concat('公元前', abs({0}), '年') ELSE concat({0}, '年') END"


@query(f"""SELECT seq, CASE WHEN y IS NULL THEN t WHEN t = '' THEN y ELSE concat(t, ' [', y, ']') END AS shown FROM (SELECT seq, {s_strip('period')} AS t, CASE WHEN s IS NOT NULL AND e IS NOT NULL AND s <> e THEN concat({S_YEAR.format('s')}, '-', {S_YEAR.format('e')}) WHEN coalesce(s, e) IS NULL THEN NULL ELSE {S_YEAR.format('coalesce(s, e)')} END AS y FROM (SELECT *, period_start_year AS s, period_end_year AS e FROM artifact))""")
def periods_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods with their years behind them."""
    return artifact(spark, sf_dir).select("seq", periods.period_shown("period", "period_start_year", "period_end_year").alias("shown"))


@query(rf"""SELECT term_id, CASE WHEN i <> '' THEN i WHEN t LIKE 'Late%' THEN '晚' WHEN t LIKE 'La%' THEN '拉' ELSE t END AS zh FROM (SELECT term_id, {s_strip("regexp_extract(label, '（([^）]+)）', 1)")} AS i, {s_strip('label')} AS t FROM vocab_term)""")
def eras_in_chinese(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in full-width brackets, else by the longest prefix, else the text."""
    return table(spark, sf_dir, "vocab_term").select("term_id", text.zh_of_era("label", {"La": "拉", "Late": "晚"}).alias("zh"))


# ---- rows and tables ---------------------------------------------------------------------------------------------------


@query("SELECT seq, len(string_split(coalesce(image_urls, ''), '|')) >= 0 AND u > 0 AND p >= u AS images_complete FROM (SELECT *, len(" + S_LIST + ") AS u, len(" + s_parts("image_paths", r"\|") + ") AS p FROM artifact)")
def images_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with as many local files as addresses."""
    return images.complete(artifact(spark, sf_dir)).select("seq", "images_complete")


@query(f"SELECT seq, detail_url FROM artifact WHERE len({S_LIST}) = 0")
def unfilled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records a repair has still to visit."""
    return repair.unfilled(artifact(spark, sf_dir)).select("seq", "detail_url")


@query("SELECT seq, '' AS image_path, '' AS image_paths, 0 AS image_count, title FROM artifact")
def cleared_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records before their images are fetched anew."""
    return repair.without_images(artifact(spark, sf_dir)).select("seq", "image_path", "image_paths", "image_count", "title")


S_WEB = "list_filter(" + S_LIST + ", lambda x: regexp_matches(x, '^http'))"


@query(f"""SELECT seq, '2026-01-01' AS crawl_date, coalesce(w[1], '') AS image_url, array_to_string(w, ' | ') AS image_urls, '' AS image_paths, len(w)::varchar AS image_count FROM (SELECT seq, {S_WEB} AS w FROM artifact)""")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as a crawl compares them before it fetches images."""
    web = F.filter(text.split_paths("image_urls"), lambda u: u.startswith("http"))
    return repair.preview(artifact(spark, sf_dir), web, web, "2026-01-01").select("seq", "crawl_date", "image_url", "image_urls", "image_paths", "image_count")


S_PAGE = "regexp_replace(regexp_replace(" + s_strip("detail_url") + ", '[;?].*$', ''), '/+$', '')"


@query(f"""WITH r AS (SELECT {S_PAGE} AS page, arg_max(title, seq) AS title, arg_max(image_url, seq) AS image_url FROM artifact WHERE seq % 3 = 0 AND {S_PAGE} <> '' GROUP BY 1)
SELECT a.seq, CASE WHEN r.page IS NULL THEN a.title ELSE concat('new ', coalesce({s_strip('r.title')}, '')) END AS title, CASE WHEN r.page IS NULL THEN a.image_url WHEN {s_strip('r.image_url')} = '' AND {s_strip('a.image_url')} <> '' THEN a.image_url ELSE {s_strip('r.image_url')} END AS image_url,
CASE WHEN r.page IS NULL OR {s_strip('a.image_urls')} <> '' THEN a.image_urls ELSE '' END AS image_urls FROM artifact a LEFT JOIN r ON r.page = {S_PAGE.replace('detail_url', 'a.detail_url')}""")
def refreshed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records refreshed from pages read anew: here every third record's page, with a new title."""
    a = artifact(spark, sf_dir)
    read = a.where("seq % 3 = 0").select("seq", "detail_url", F.concat(F.lit("new "), text.strip("title")).alias("title"), "image_url")
    return repair.refreshed(a.select("seq", "detail_url", "title", "image_url", "image_urls"), read, "seq").select("seq", "title", "image_url", "image_urls")


@query("""WITH c AS (SELECT check_id, image_url, local_file_ok FROM image_check), d AS (SELECT image_url, min(check_id)::varchar AS found FROM image_check WHERE check_id % 2 = 0 AND image_url IS NOT NULL GROUP BY 1), e AS (SELECT check_id::varchar AS id, min(check_id)::varchar AS found FROM image_check WHERE check_id % 2 = 0 GROUP BY 1)
SELECT a.check_id, coalesce(e.found, d.found) AS found FROM image_check a LEFT JOIN e ON e.id = a.check_id::varchar LEFT JOIN d ON d.image_url = a.image_url""")
def captured_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookups by id, else by address, in a table of captured answers: here the even checks."""
    c = table(spark, sf_dir, "image_check").select("check_id", F.col("check_id").cast("string").alias("id"), F.col("image_url").alias("url"))
    captured = c.where("check_id % 2 = 0").withColumn("value", F.col("id"))
    # values compare as texts of one length, so the smallest is the first
    return repair.by_id(c, captured).select("check_id", "found")


@query("""SELECT seq, substr(crawl_date::varchar, 1, 10) AS crawl_date, coalesce(museum_id::varchar, '') AS museum_id, coalesce(image_count::varchar, '') AS image_count, '' AS iiif FROM artifact""")
def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as a file holds them: all cells text, NULL as empty, missing columns empty."""
    a = artifact(spark, sf_dir).drop("iiif_manifest_url").withColumn("detail_url", F.col("seq"))
    return schema.texts(a).select(F.col("detail_url").cast("long").alias("seq"), "crawl_date", "museum_id", "image_count", F.col("iiif_manifest_url").alias("iiif"))


@query("SELECT c_custkey::bigint AS id, c_name AS label, 'x' AS note, c_acctbal::double AS balance FROM customer")
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table brought into another one's columns: renamed, widened, added with a default."""
    from pyspark.sql import types as T  # noqa: PLC0415

    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.StringType()), T.StructField("note", T.StringType()), T.StructField("balance", T.DoubleType())])
    return schema.reconcile(table(spark, sf_dir, "customer"), target, {"c_custkey": "id", "c_name": "label", "c_acctbal": "balance"}, {"note": "x"})


@query("SELECT count(*) FILTER (n > 0) AS changed_rows, coalesce(sum(n), 0)::bigint AS changed_cells FROM (SELECT CASE WHEN coalesce(type, '') = '' OR type NOT IN (SELECT label FROM vocab_term) THEN 0 ELSE 1 END AS n FROM artifact)")
def changed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that a translation of labels changes, by key."""
    a = artifact(spark, sf_dir).select("seq", "type")
    v = table(spark, sf_dir, "vocab_term").select(F.col("label").alias("source"), F.concat(F.lit("zh "), "label").alias("target"))
    return quality.changed_cells(a, a.withColumn("k", F.nullif(F.col("type"), F.lit(""))).join(v.groupBy("source").agg(F.max("target").alias("target")), F.col("k") == F.col("source"), "left").select("seq", F.coalesce("target", "type").alias("type")), "seq", ["type"])


@query("SELECT seq, museum_id, object_id, title FROM artifact WHERE trim(title) <> '' ORDER BY museum_id, object_id, seq LIMIT 6")
def ordered_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six titled records."""
    return summary.sample(artifact(spark, sf_dir).select("seq", "museum_id", "object_id", "title"), ["museum_id", "object_id", "seq"], 6, F.trim("title") != "")


@query("SELECT batch, count(*) AS n, min(seq) AS first, max(seq) AS last FROM (SELECT seq, floor(seq / 500)::bigint AS batch FROM artifact) GROUP BY batch")
def write_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in which rows are written."""
    b = summary.batches(artifact(spark, sf_dir).select("seq"), 500)
    return b.groupBy("batch").agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last"))


@query(f"SELECT museum_id::varchar AS museum_id, {s_strip('object_id')} AS object_id, {S_ID} AS artifact_id FROM artifact")
def artifact_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which record is which artifact."""
    return summary.artifact_map(artifact(spark, sf_dir))


# ---- runs and jobs -----------------------------------------------------------------------------------------------------

S_TEXTS = {c: s_strip(c) for c in ("title", "dynasty", "type", "material")}
S_SIDE = "SELECT museum_id, object_id, k, " + ", ".join(f"{x} AS {c}" for c, x in S_TEXTS.items()) + " FROM (SELECT *, concat(museum_id, '/', trim(object_id)) AS k FROM artifact) WHERE crawl_date @@ DATE '2024-01-01' QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1"
S_KINDS = f"""WITH o AS ({S_SIDE.replace('@@', '<')}), n AS ({S_SIDE.replace('@@', '>=')}), d AS (SELECT n.museum_id, CASE WHEN o.k IS NULL THEN 'new' WHEN n.title <> o.title OR n.dynasty <> o.dynasty OR n.type <> o.type OR n.material <> o.material THEN 'updated' ELSE 'unchanged' END AS t FROM n LEFT JOIN o USING (k))"""


def _crawls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = artifact(spark, sf_dir).withColumn("k", F.concat_ws("/", F.col("museum_id").cast("string"), F.trim("object_id"))).select("k", "seq", "museum_id", *S_TEXTS, "crawl_date")
    return a.where("crawl_date < DATE '2024-01-01'"), a.where("crawl_date >= DATE '2024-01-01'")


@query(S_KINDS + ", c AS (SELECT coalesce(museum_id::varchar, 'total') AS museum_id, count(*) AS records, 0 AS images_downloaded, count(*) FILTER (t = 'new') AS new, count(*) FILTER (t = 'updated') AS updated, count(*) FILTER (t = 'unchanged') AS unchanged FROM d GROUP BY ROLLUP (museum_id)) SELECT *, new + updated AS changed FROM c")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl's counts by museum and in all."""
    old, new = _crawls(spark, sf_dir)
    return jobs.loaded(old, new, "k", list(S_TEXTS), "seq").report


@query(f"""WITH o AS (SELECT * FROM (SELECT *, concat(museum_id, '/', trim(object_id)) AS k FROM artifact) WHERE crawl_date < DATE '2024-01-01'), n AS (SELECT * FROM (SELECT *, concat(museum_id, '/', trim(object_id)) AS k FROM artifact) WHERE crawl_date >= DATE '2024-01-01' QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS r FROM o), c AS (SELECT n.* FROM n LEFT JOIN f ON f.k = n.k AND f.r = 1 WHERE f.k IS NULL OR {" OR ".join(f"{s_strip('n.' + c)} <> {s_strip('f.' + c)}" for c in S_TEXTS)})
SELECT o.k, coalesce(c.seq, o.seq) AS seq, CASE WHEN c.k IS NULL THEN o.title ELSE c.title END AS title FROM o LEFT JOIN c USING (k) UNION ALL SELECT k, seq, title FROM c WHERE k NOT IN (SELECT k FROM o)""")
def loaded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after a crawl."""
    old, new = _crawls(spark, sf_dir)
    return jobs.loaded(old, new, "k", list(S_TEXTS), "seq").records.select("k", "seq", "title")


@query(rf"""WITH a AS (SELECT *, substr(lower(regexp_replace({s_strip('artist')}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), 1, 400) AS norm FROM artifact)
SELECT seq, CASE WHEN {s_strip('artist')} <> '' AND {s_strip('artist_birth')} = '' AND contains(norm, 'a') THEN '1600' ELSE artist_birth END AS artist_birth, CASE WHEN {s_strip('artist')} <> '' AND {s_strip('artist_birth')} = '' AND contains(norm, 'a') THEN '2026-01-01' ELSE artist_enriched_at END AS artist_enriched_at FROM a""")
def enriched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records filled from answers about makers: here a year for every key with an a."""
    a = artifact(spark, sf_dir)
    blank = [F.lit("").alias(c) for c in schema.ENRICHED if c != "artist_birth"]
    answers = a.select(text.artist_key("artist").alias("artist_norm")).where("artist_norm LIKE '%a%'").distinct().select("artist_norm", F.lit("1600").alias("artist_birth"), *blank)
    return jobs.enriched(a, answers, "2026-01-01").records.select("seq", "artist_birth", "artist_enriched_at")


@query(f"SELECT a.seq, coalesce(v.z, a.type) AS type, coalesce(w.z, a.material) AS material FROM artifact a LEFT JOIN (SELECT label, max(label_zh) AS z FROM vocab_term GROUP BY label) v ON {s_strip('a.type')} = v.label LEFT JOIN (SELECT label, max(label_zh) AS z FROM vocab_term GROUP BY label) w ON {s_strip('a.material')} = w.label")
def translated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records translated by a cache of labels."""
    v = table(spark, sf_dir, "vocab_term").select(F.col("label").alias("source"), F.col("label_zh").alias("target"))
    return jobs.translated(artifact(spark, sf_dir).select("seq", "type", "material"), v, ["type", "material"]).records


# ---- entities and graph ------------------------------------------------------------------------------------------------

S_CULTURES = "list_filter(list_transform(CASE WHEN contains(c, ';') THEN string_split(c, ';') ELSE string_split(c, ' / ') END, lambda x: " + s_strip("x") + "), lambda x: len(" + s_norm("x") + ") >= 2)"
S_MAKERS = s_parts("artist", r"(?i)\s*(?:;|,|、| and |&|/)\s*")
S_ALONE = f"len({S_SEGMENTS}) = 1"
S_AKEY = r"substr(lower(regexp_replace({0}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')), 1, 400)"

#: Mentions in the order of records and, in a record, of registration: museum, location, type, culture, artist.
S_MENTIONS = rf"""{S_LOOKUP}, b AS (SELECT a.*, coalesce(n.name, '') AS lookup, {s_strip('culture')} AS c FROM artifact a LEFT JOIN n USING (seq)),
raw AS (SELECT seq, museum_id, object_id, 1 AS s, 0 AS i, 'Museum' AS kind, CASE WHEN {s_strip('museum')} <> '' THEN {s_strip('museum')} ELSE concat('Museum-', museum_id) END AS label, museum_id::varchar AS norm, '' AS ext, 'museum' AS role FROM b
UNION ALL SELECT seq, museum_id, object_id, 2, 0, 'Location', {s_strip('location')}, {s_norm('location')}, '', 'location' FROM b WHERE {s_strip('location')} <> ''
UNION ALL SELECT seq, museum_id, object_id, 3, 0, 'ArtifactType', {s_strip('type')}, {s_norm('type')}, '', 'type' FROM b WHERE {s_strip('type')} <> ''
UNION ALL SELECT seq, museum_id, object_id, 4, i, 'Culture', x, {s_norm('x')}, '', 'culture' FROM (SELECT *, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT *, list_filter(l0, lambda x, j: list_position(list_transform(l0, lambda y: {s_norm('y')}), {s_norm('x')}) = j)[1:12] AS l FROM (SELECT *, {S_CULTURES} AS l0 FROM b)))
UNION ALL SELECT seq, museum_id, object_id, 5, i, 'Artist', x, {s_norm('x')}, CASE WHEN trim(artist_wikidata_id) LIKE 'Q%' AND lookup <> '' AND ({S_AKEY.format('x')} = {S_AKEY.format('lookup')} OR alone) THEN trim(artist_wikidata_id) ELSE '' END, 'artist' FROM (SELECT *, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT *, {S_MAKERS} AS l, {S_ALONE} AS alone FROM b))),
m AS (SELECT *, last_value(nullif(ext, '') IGNORE NULLS) OVER (PARTITION BY kind, norm ORDER BY seq, s, i ROWS UNBOUNDED PRECEDING) AS q FROM raw WHERE norm <> '' OR ext <> ''),
r AS (SELECT *, CASE kind WHEN 'Artist' THEN concat('entity:artist:', coalesce(q, {s_slug('label')})) WHEN 'Museum' THEN concat('entity:museum:', norm) WHEN 'Location' THEN concat('entity:location:', {s_slug('label')}) ELSE concat('entity:', lower(kind), ':', {s_slug('norm')}) END AS id FROM m)"""
ROLES = ("museum", "location", "type", "culture", "artist")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.resolve(registry.mentions(artifact(spark, sf_dir), ROLES))


@query(S_MENTIONS + " SELECT id AS canonical_id, arg_min(kind, (seq, s, i)) AS entity_type, arg_min(label, (seq, s, i)) AS label, arg_min(norm, (seq, s, i)) AS norm_label, coalesce(arg_min(nullif(ext, ''), (seq, s, i)) FILTER (ext <> ''), '') AS external_id, count(*) AS source_count FROM r GROUP BY id")
def resolved_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Museums, places, types, cultures and makers: first label, key, external id, how often met."""
    return registry.masters(_resolved(spark, sf_dir)).drop("uri")


@query(S_MENTIONS + ", f AS (SELECT id, norm, arg_min({'l': label, 'k': kind, 'e': ext}, (seq, s, i)) AS f FROM r GROUP BY id, norm) SELECT id AS canonical_id, f.l AS alias, norm AS norm_alias, CASE WHEN f.k = 'Artist' AND f.e <> '' THEN 'external_id' ELSE 'norm_label' END AS match_method, CASE WHEN f.k <> 'Artist' THEN 1.0 WHEN f.e <> '' THEN 0.95 ELSE 0.8 END::double AS confidence FROM f")
def resolved_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First spellings of their keys."""
    return registry.aliases(_resolved(spark, sf_dir))


@query(S_MENTIONS + " SELECT id AS canonical_id, museum_id::varchar AS museum_id, trim(object_id) AS object_id, role AS field_name, label AS raw_value FROM r")
def resolved_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every entity was met."""
    return registry.sources(_resolved(spark, sf_dir))


S_PREDICATES = "CASE role WHEN 'museum' THEN 'belongsToMuseum' WHEN 'location' THEN 'locatedIn' WHEN 'type' THEN 'hasType' WHEN 'culture' THEN 'hasCulture' ELSE 'createdBy' END"
S_EDGES = S_MENTIONS + f", t AS (SELECT DISTINCT {S_ID} AS \"from\", {S_PREDICATES} AS relation, id AS \"to\" FROM r)"


@query(S_EDGES + ' SELECT "from", relation, "to" FROM t')
def entity_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of artifacts to museums, places, types, cultures and makers."""
    return registry.relations(_resolved(spark, sf_dir))


S_LABELS = {"artist": "Artist", "museum": "Museum", "location": "Location", "dynasty": "Dynasty", "artifacttype": "ArtifactType", "material": "Material", "culture": "Culture", "artifact": "Artifact"}
S_LABEL = "CASE split_part({0}, ':', 2) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S_LABELS.items()) + " ELSE 'Entity' END"


@query(S_EDGES + f' SELECT {S_LABEL.format(chr(34) + "from" + chr(34))} AS from_label, relation, {S_LABEL.format(chr(34) + "to" + chr(34))} AS to_label, count(*) AS n FROM t GROUP BY ALL')
def edge_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges by the labels of their ends."""
    return summary.edge_kinds(registry.relations(_resolved(spark, sf_dir)))


@query(S_MENTIONS + f", d AS (SELECT DISTINCT id FROM r UNION SELECT DISTINCT {S_ID} FROM r) SELECT {S_LABEL.format('id')} AS label, count(*) AS n FROM d GROUP BY label ORDER BY n DESC, label LIMIT 4")
def top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four most frequent labels of nodes."""
    r = _resolved(spark, sf_dir)
    return summary.top_labels(r.select(F.col("canonical_id").alias("id")).unionByName(r.select(F.col("artifact_id").alias("id"))).distinct(), 4)


@query(S_EDGES + f""", k AS (SELECT id, min(kind) AS kind, max(ext) AS ext FROM r GROUP BY id) SELECT (SELECT count(*) FROM k) AS entity_count, (SELECT count(*) FROM k) AS shared_entity_count, (SELECT count(*) FROM k WHERE kind = 'Artist') AS artist_entity_count,
(SELECT count(*) FROM k WHERE kind = 'Artist' AND ext <> '') AS artist_with_external_id, (SELECT count(*) FROM t) AS relation_count, (SELECT count(*) FROM (SELECT DISTINCT {S_ID}, {s_strip('title')} FROM artifact WHERE {s_strip('title')} <> '')) AS property_count""")
def registry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry in numbers; of the properties, titles."""
    r = _resolved(spark, sf_dir)
    return summary.of_registry(registry.masters(r), registry.relations(r), registry.properties(artifact(spark, sf_dir)).where("relation = 'title'"))


@query(S_EDGES + ', d AS (SELECT DISTINCT id FROM r WHERE kind = \'Museum\') SELECT DISTINCT id, ' + S_LABEL.format("id") + ' AS label FROM (SELECT unnest(["from", "to"]) AS id FROM t) WHERE id NOT IN (SELECT id FROM d)')
def implied_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of edges that aren't nodes yet, where museums are."""
    r = _resolved(spark, sf_dir)
    nodes = r.where("entity_type = 'Museum'").select(F.col("canonical_id").alias("id")).distinct()
    return registry.implied_nodes(nodes, registry.relations(r))


S_PROPS = [c for c in registry.PROPERTIES]
S_UNPIVOT = ", ".join(s_strip(f"{c}::varchar") for c in S_PROPS)


@query(f"""SELECT DISTINCT {S_ID} AS "from", r AS relation, v AS "to" FROM (SELECT museum_id, object_id, unnest([{', '.join(f"'{registry.camel(c)}'" for c in S_PROPS)}]) AS r, unnest([{S_UNPIVOT}]) AS v FROM artifact) WHERE v <> ''""")
def all_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All property columns as triples, but for the three that are read out of the material."""
    return registry.properties(artifact(spark, sf_dir)).where(~F.col("relation").isin("materialSummary", "materialBase", "materialPrimary"))


@query(f"""WITH p AS (SELECT DISTINCT {S_ID} AS id, {s_strip('title')} AS t, {s_strip('credit_line')} AS c FROM artifact) SELECT id, substr(max(nullif(t, '')), 1, 20) AS title, substr(max(nullif(c, '')), 1, 20) AS "creditLine" FROM p GROUP BY id""")
def node_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact nodes with two properties, cut to 20 characters."""
    a = artifact(spark, sf_dir)
    nodes = summary.artifact_map(a).select(F.col("artifact_id").alias("id")).distinct()
    return registry.with_properties(nodes, registry.properties(a), ["title", "creditLine"], 20)


S_SPLIT = s_parts("image_urls", r"\|")
S_CHECKS = "SELECT image_url, arg_max(valid, (checked_at, check_id)) AS valid FROM (SELECT image_url, checked_at, check_id, CASE WHEN valid IS NULL THEN -1 WHEN valid THEN 1 ELSE 0 END AS valid FROM image_check WHERE image_url IS NOT NULL) GROUP BY image_url"


SQL["image_repair"] = (f"""WITH u AS (SELECT seq, list_filter(list_concat([trim(coalesce(image_url, ''))], {S_SPLIT}), lambda x: x <> '') AS l FROM artifact), e AS (SELECT seq, unnest(list_filter(l, lambda x, j: list_position(l, x) = j)) AS x, generate_subscripts(list_filter(l, lambda x, j: list_position(l, x) = j), 1) AS pos FROM u),
s AS (SELECT seq, bool_or(pos = 1 AND coalesce(c.valid, -1) = 0) AS bad, list(x ORDER BY pos) FILTER (c.valid = 1) AS ok FROM e LEFT JOIN ({S_CHECKS}) c ON c.image_url = e.x GROUP BY seq)
SELECT a.seq, CASE WHEN coalesce(bad, false) THEN coalesce(ok[1], '') ELSE a.image_url END AS image_url, CASE WHEN coalesce(bad, false) THEN coalesce(array_to_string(ok, ' | '), '') ELSE a.image_urls END AS image_urls FROM artifact a LEFT JOIN s USING (seq)""")


@query("SELECT museum_id, object_id, string_agg(DISTINCT p, ' | ' ORDER BY p) AS image_paths, count(DISTINCT p) AS image_count FROM (SELECT museum_id, trim(object_id) AS object_id, image_path AS p FROM artifact WHERE trim(image_path) <> '') GROUP BY ALL")
def files_of_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with the files that lie in their folders."""
    a = artifact(spark, sf_dir).select("museum_id", F.trim("object_id").alias("object_id"), F.col("image_path").alias("path")).where("trim(path) <> ''")
    out = images.with_files(a.select("museum_id", "object_id").distinct(), a)
    return out.select("museum_id", "object_id", "image_paths", F.col("image_count").cast("long").alias("image_count"))


@query("""WITH f AS (SELECT DISTINCT image_path AS p FROM artifact WHERE trim(image_path) <> '') SELECT p AS path, 'root/' || replace(p, chr(92), '/') AS file FROM f""")
def found_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored paths looked up among the files under two roots."""
    p = artifact(spark, sf_dir).select(F.col("image_path").alias("path")).where("trim(path) <> ''")
    return listing.resolve_paths(p, ["nowhere", "root/"], p.select(F.concat(F.lit("root/"), F.replace("path", F.lit("\\"), F.lit("/"))).alias("path")))





# ---- years and eras out of periods --------------------------------------------------------------------------------------

_B = r"(?i)B\.?\s*C\.?|BCE|BC|公元前"
_SPAN = r"(?i)([\d\s,BCEbc.\-]+?)\s*[-–—]\s*([\d\s,BCEbc.\-]+)"


def _s_year(token: str) -> str:
    n = rf"try_cast(nullif(regexp_extract({token}, '(-?\d{{1,4}})', 1), '') AS int)"
    return f"CASE WHEN regexp_matches({token}, '{_B}') AND {n} > 0 THEN -{n} ELSE {n} END"


_CENTURIES = r"list_transform(regexp_extract_all(t, '(?i)(?:(?:early|late|mid(?:dle)?)\s+)?(\d{1,2})(?:st|nd|rd|th)\s+century', 1), lambda d: d::int)"
_DECADES = r"list_transform(regexp_extract_all(t, '(?i)(?:early|late|mid)?\s*(\d{3,4})s\b', 1), lambda d: d::int)"
#: Years of every record's period: around a dash, one year, centuries, decades; the first that can be read.
S_YEARS = rf"""w AS (SELECT seq, period, {s_strip('period')} AS t FROM artifact),
z AS (SELECT *, regexp_matches(t, '(?i)century') AS cent, {_s_year(f"regexp_extract(t, '{_SPAN}', 1)")} AS a0, {_s_year(f"regexp_extract(t, '{_SPAN}', 2)")} AS b0,
regexp_matches(t, '{_B}') AND NOT regexp_matches(regexp_replace(t, '(?i)B\.?\s*C\.?\s*E?\.?|公元前', ' ', 'g'), '(?i)C\.?\s*E\.|\bCE\b|AD|公元') AS neg,
CASE WHEN regexp_matches(replace(t, '公元前', 'BCE'), '(?i)^[\d\s,BCEbc.\-]+$') THEN {_s_year('t')} END AS whole,
CASE WHEN NOT regexp_matches(t, '\d+\s*[-–]\s*\d+') THEN CASE WHEN regexp_extract(t, '(?i)(\d{{3,4}})\s*(B\.?\s*C\.?|BCE|BC|公元前)?', 2) <> '' THEN -1 ELSE 1 END * try_cast(nullif(regexp_extract(t, '(?i)(\d{{3,4}})\s*(B\.?\s*C\.?|BCE|BC|公元前)?', 1), '') AS int) END AS loose,
{_CENTURIES} AS c, {_DECADES} AS d FROM w),
x AS (SELECT *, CASE WHEN neg THEN -abs(a0) ELSE a0 END AS a, CASE WHEN neg THEN -abs(b0) ELSE b0 END AS b, coalesce(whole, loose) AS one FROM z),
v AS (SELECT seq, period, t, CASE WHEN NOT cent AND a IS NOT NULL AND b IS NOT NULL THEN [least(a, b), greatest(a, b)] WHEN NOT cent AND one IS NOT NULL THEN [one, one]
WHEN len(c) > 0 THEN CASE WHEN regexp_matches(t, '(?i)\bB\.?\s*C\.?|BCE|BC|公元前') THEN [-list_max(c) * 100, -((list_min(c) - 1) * 100 + 1)] ELSE [(list_min(c) - 1) * 100 + 1, list_max(c) * 100] END
WHEN len(d) > 0 THEN [floor(list_min(d) / 100)::int * 100, floor(list_max(d) / 100)::int * 100 + 99] END AS y FROM x)"""

SQL["period_years"] = f'WITH {S_YEARS} SELECT seq, period, y[1] AS start, y[2] AS "end" FROM v'

#: The era of every record: the text where it names an early culture, else the years (given or read), else the text.
S_ROW_ERA = f"""{S_YEARS}, e(i, n, a, b, k) AS (VALUES {S_ERAS}),
g AS (SELECT seq, v.t, lower(v.t) AS l, CASE WHEN period_start_year IS NULL AND period_end_year IS NULL THEN y[1] ELSE period_start_year END AS s0, CASE WHEN period_start_year IS NULL AND period_end_year IS NULL THEN y[2] ELSE coalesce(period_end_year, period_start_year) END AS e0 FROM v JOIN artifact USING (seq)),
p AS (SELECT seq, least(s0, e0) AS s, greatest(s0, e0) AS f FROM g WHERE s0 IS NOT NULL AND e0 IS NOT NULL),
near AS (SELECT seq, n FROM p JOIN e ON a <= f AND b >= s WHERE f - s + 1 <= 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY least(f, b) - greatest(s, a) DESC, b - a, i) = 1),
wide AS (SELECT seq, n FROM p JOIN e ON floor((s + f) / 2.0) BETWEEN a AND b WHERE f - s + 1 > 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY k, b - a, i) = 1),
h AS (SELECT g.seq, {era_sql()} AS et, coalesce(near.n, wide.n, '') AS ey, l FROM g LEFT JOIN near USING (seq) LEFT JOIN wide USING (seq)),
row_era AS (SELECT seq, CASE WHEN et <> '' AND regexp_matches(l, '{periods.CULTURES}') THEN et WHEN ey <> '' THEN ey ELSE et END AS era FROM h)"""


@query(f"WITH {S_ROW_ERA} SELECT seq, era FROM row_era")
def row_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The era of every record, out of its period and years."""
    return artifact(spark, sf_dir).select("seq", periods.era("period", "period_start_year", "period_end_year").alias("era"))


@query(f"""WITH {S_ROW_ERA}, m AS (SELECT museum_id, object_id, CASE WHEN {s_strip('dynasty')} <> '' THEN {s_strip('dynasty')} ELSE era END AS label FROM artifact JOIN row_era USING (seq))
SELECT DISTINCT {S_ID} AS "from", 'belongsToDynasty' AS relation, concat('entity:dynasty:', {s_slug(s_norm('label'))}) AS "to" FROM m WHERE label <> '' AND {s_norm('label')} <> ''""")
def era_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of artifacts to eras, given or read."""
    return registry.relations(registry.resolve(registry.mentions(artifact(spark, sf_dir), ("dynasty",))))


# ---- materials ------------------------------------------------------------------------------------------------------------


def _squeezed(x: str) -> str:
    return rf"regexp_replace({s_strip(x)}, '[\s\x{{00a0}}\x{{3000}}]+', ' ', 'g')"


def _bare_of_measures(x: str) -> str:
    return f"trim({_squeezed('regexp_replace(regexp_replace(' + x + ', ' + _MEASURES + ', ' + _SPACE + ', ' + _ALL + '), ' + _UNIT_WORDS + ', ' + _SPACE + ', ' + _ALL + ')')}, ' ,;.')"


def _of_words(words: tuple[str, ...]) -> str:
    return r"'(?i)\b(?:" + "|".join(words) + r")\b'"


_MEASURES, _SPACE, _ALL, _UNIT_WORDS = "'(?i)" + "|".join(materials.MEASURES) + "'", "' '", "'g'", _of_words(materials.UNITS)
_BY_LENGTH = [(a, m) for a, m in sorted(((a, m) for m, names in materials.ALIASES.items() for a in names), key=lambda p: -len(p[0])) if a.isascii()]
_ALIASES = "[" + ", ".join(f"'{a}'" for a, _ in _BY_LENGTH) + "]"
_CANONS = "[" + ", ".join(f"'{m}'" for _, m in _BY_LENGTH) + "]"


def _named_in(x: str) -> str:
    """Materials of the aliases in a lower-case text, longest first."""
    found = f"regexp_extract_all(replace({x}, 'é', 'e'), {_of_words(tuple(a for a, _ in _BY_LENGTH))})"
    horns = f"len(list_filter({found}, lambda o: o LIKE '% horn')) > len(list_filter(list_distinct({found}), lambda o: o LIKE '% horn'))"
    every = f"list_concat({found}, CASE WHEN {horns} THEN ['horn'] ELSE [] END)"
    return f"list_transform(list_sort(list_distinct(list_transform({every}, lambda o: list_position({_ALIASES}, o)))), lambda r: ({_CANONS})[r])"


_ON = r"'(?is)^(.*?)\bon\s+([a-z][a-z\s-]{1,40}?)(?:\s*[;,.]|$)(.*)$'"
_ONLY_SIZE = r"'(?i)^[\d./\s×x]+(?:mm|cm|m|in|ft)?$'"
_NUMBERS = r"'(?i)^[\d./\s]+(?:mm|cm|m|in|ft)?$'"
_KINDS = "(" + ", ".join(f"'{k}'" for k in materials.KINDS) + ")"
_SUPPORTS = "[" + ", ".join(f"'{k}'" for k in materials.SUPPORTS) + "]"


def _without_idle(x: str) -> str:
    return _squeezed(f"regexp_replace(lower({x}), {_of_words(materials.IDLE)}, ' ', 'g')")


SQL["material_extract"] = rf"""WITH t AS (SELECT seq, {_squeezed('material')} AS whole FROM artifact),
p AS (SELECT *, list_filter(list_transform(string_split(whole, ';'), lambda x: {_squeezed('x')}), lambda x: x <> '') AS parts FROM t),
s AS (SELECT seq, unnest(segs) AS seg, generate_subscripts(segs, 1) AS k FROM (SELECT seq, CASE WHEN whole = '' OR list_contains(parts, whole) THEN parts ELSE list_prepend(whole, parts) END AS segs FROM p)),
u AS (SELECT *, lower(seg) AS low, {_bare_of_measures('seg')} AS rest FROM s),
c AS (SELECT *, regexp_extract(rest, {_ON}, 2) AS sup FROM u),
o AS (SELECT *, {_without_idle('sup')} AS x1, {_without_idle(f"CASE WHEN sup = '' THEN rest ELSE regexp_extract(rest, {_ON}, 1) || regexp_extract(rest, {_ON}, 3) END")} AS x2 FROM c),
n AS (SELECT seq, k, CASE WHEN low IN {_KINDS} OR regexp_matches(low, {_of_words(materials.PLACED)}) OR regexp_matches(low, {_NUMBERS}) OR (regexp_matches(low, {_of_words(materials.STYLED + materials.INSCRIBED)}) AND len({_named_in('low')}) = 0) THEN []
ELSE list_concat({_named_in('x1')}, {_named_in('x2')}, CASE WHEN regexp_matches(seg, {_of_words(('color', 'colors', 'colored'))}) THEN ['pigment'] ELSE [] END) END AS m FROM o),
f AS (SELECT seq, flatten(list(m ORDER BY k)) AS every FROM n GROUP BY seq),
d AS (SELECT p.seq, whole, coalesce(list_filter(every, lambda x, i: list_position(every, x) = i)[1:12], []) AS found, list_filter(list_transform(parts, lambda x: {_bare_of_measures('x')}), lambda x: x <> '' AND NOT regexp_matches(x, {_ONLY_SIZE}) AND {_bare_of_measures('x')} <> '') AS kept FROM p LEFT JOIN f USING (seq)),
q AS (SELECT *, array_to_string(list_filter(kept, lambda x, i: list_position(list_transform(kept, lambda y: lower(y)), lower(x)) = i), '; ') AS joined FROM d)
SELECT seq, array_to_string(found, ' | ') AS base, coalesce(list_filter({_SUPPORTS}, lambda x: list_contains(found, x))[1], found[1], '') AS primary_material, CASE WHEN contains(whole, ';') AND joined <> '' THEN joined ELSE {_bare_of_measures('whole')} END AS material_clean FROM q"""


# ---- the whole registry: eras and materials beside the other entities ---------------------------------------------------

_MORE = f"""
UNION ALL SELECT seq, museum_id, object_id, 2.5, 0, 'Dynasty', l, {s_norm('l')}, '', 'dynasty' FROM (SELECT b.*, CASE WHEN {s_strip('dynasty')} <> '' THEN {s_strip('dynasty')} ELSE era END AS l FROM b JOIN eras USING (seq)) WHERE l <> ''
UNION ALL SELECT seq, museum_id, object_id, 3.3, i, 'Material', x, {s_norm('x')}, '', 'material' FROM (SELECT b.*, unnest(string_split(base, ' | ')) AS x, generate_subscripts(string_split(base, ' | '), 1) AS i FROM b JOIN mats USING (seq)) WHERE x <> ''
UNION ALL SELECT seq, museum_id, object_id, 3.6, 0, 'Material', primary_material, {s_norm('primary_material')}, '', 'primary' FROM b JOIN mats USING (seq) WHERE primary_material <> ''"""
S_REGISTRY = S_MENTIONS.replace(", b AS (SELECT a.*", f", eras AS (WITH {S_ROW_ERA} SELECT seq, era FROM row_era), mats AS ({SQL['material_extract']}), b AS (SELECT a.*", 1)
S_REGISTRY = S_REGISTRY.replace("),\nm AS (SELECT *, last_value", _MORE + "),\nm AS (SELECT *, last_value", 1)

SQL["entity_masters"] = S_REGISTRY + """ SELECT id AS canonical_id, arg_min(kind, (seq, s, i)) AS entity_type, arg_min(label, (seq, s, i)) AS label, arg_min(norm, (seq, s, i)) AS norm_label, coalesce(arg_min(nullif(ext, ''), (seq, s, i)) FILTER (ext <> ''), '') AS external_id, count(*) AS source_count,
'https://data.example/' || replace(url_encode(replace(id, ':', '/')), '%2F', '/') AS uri FROM r GROUP BY id"""
SQL["entity_aliases"] = S_REGISTRY + SQL["resolved_aliases"].removeprefix(S_MENTIONS)

_RELATION = "CASE role " + " ".join(f"WHEN '{role}' THEN '{name}'" for role, name in registry.RELATIONS.items()) + " END"


@query(S_REGISTRY + f' SELECT DISTINCT {S_ID} AS "from", {_RELATION} AS relation, id AS "to" FROM r')
def all_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight relations of the graph."""
    return registry.relations(registry.resolve(registry.mentions(artifact(spark, sf_dir))))


@query(f"""SELECT DISTINCT {S_ID} AS "from", r AS relation, v AS "to" FROM (SELECT museum_id, object_id, unnest(['materialSummary', 'materialBase', 'materialPrimary']) AS r, unnest([{s_strip('material')}, base, primary_material]) AS v FROM artifact JOIN ({SQL['material_extract']}) USING (seq)) WHERE v <> ''""")
def material_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three properties that are read out of the material."""
    return registry.properties(artifact(spark, sf_dir)).where(F.col("relation").isin("materialSummary", "materialBase", "materialPrimary"))


# ---- standard records -----------------------------------------------------------------------------------------------------


def _s_value(x: str) -> str:
    return f"CASE WHEN lower({s_strip(x)}) IN ('none', 'null', 'nan') THEN '' ELSE {s_strip(x)} END"


_CELLS = ("title", "period", "artist", "culture", "provenance", "description", "location", "artist_province", "accession_number", "object_id")
_PROVINCE = SQL["provinces"].replace("concat_ws(' ', artist_province, culture, provenance) AS t FROM artifact", "concat_ws(' ', culture, provenance, description, artist, location) AS t FROM g")


@query(f"""WITH yr AS (WITH {S_YEARS} SELECT seq, y FROM v), st AS ({SQL['standard_types']}), me AS (SELECT seq, material_clean FROM ({SQL['material_extract']})),
k AS (SELECT a.*, st.standard, me.material_clean, coalesce(y[1]::varchar, coalesce(period_start_year::varchar, '')) AS y1, coalesce(y[2]::varchar, coalesce(period_end_year::varchar, '')) AS y2 FROM artifact a JOIN yr USING (seq) JOIN st USING (seq) JOIN me USING (seq)),
g AS (SELECT seq, {', '.join(f'{_s_value(c)} AS {c}' for c in _CELLS)}, {_s_value('standard')} AS type, {_s_value('material_clean')} AS material, standard, material_clean, y1, y2, try_cast(trim(y1) AS int) AS s0, try_cast(trim(y2) AS int) AS e0 FROM k),
e(i, n, a, b, r) AS (VALUES {S_ERAS}), p AS (SELECT seq, least(s0, coalesce(e0, s0)) AS s, greatest(s0, coalesce(e0, s0)) AS f FROM g WHERE s0 IS NOT NULL),
near AS (SELECT seq, n FROM p JOIN e ON a <= f AND b >= s WHERE f - s + 1 <= 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY least(f, b) - greatest(s, a) DESC, b - a, i) = 1),
wide AS (SELECT seq, n FROM p JOIN e ON floor((s + f) / 2.0) BETWEEN a AND b WHERE f - s + 1 > 80 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY r, b - a, i) = 1),
h AS (SELECT seq, {era_sql()} AS et, l FROM (SELECT seq, period AS t, lower(period) AS l FROM g)),
pr AS ({_PROVINCE}), ty AS ({SQL['inferred_types'].replace(' FROM artifact', ' FROM g')}),
o AS (SELECT g.*, coalesce(near.n, wide.n, '') AS ey, et, l, CASE WHEN g.artist_province = '' THEN pr.province ELSE {s_strip('a.artist_province')} END AS place, ty.inferred, a.culture AS culture0, a.accession_number AS acc0, a.artist_birth, a.crawl_date FROM g LEFT JOIN near USING (seq) LEFT JOIN wide USING (seq) JOIN h USING (seq) JOIN pr USING (seq) JOIN ty USING (seq) JOIN artifact a USING (seq))
SELECT seq, y1 AS period_start_year, y2 AS period_end_year, CASE WHEN et <> '' AND regexp_matches(l, '{periods.CULTURES}') THEN et WHEN ey <> '' THEN ey ELSE et END AS dynasty, place AS artist_province, CASE WHEN type = '' AND material <> '' THEN inferred ELSE standard END AS type, CASE WHEN material = '' AND type <> '' THEN type ELSE material_clean END AS material,
CASE WHEN culture = '' AND {_s_value('place')} <> '' THEN 'China' ELSE {s_strip('culture0')} END AS culture, CASE WHEN accession_number = '' AND regexp_matches(object_id, '[\\d.]') THEN object_id ELSE {s_strip('acc0')} END AS accession_number, crawl_date::varchar AS crawl_date FROM o""")
def standard_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in standard form, with their gaps filled from their other fields."""
    out = records.standardise(artifact(spark, sf_dir), ("seq",))
    return out.select("seq", "period_start_year", "period_end_year", "dynasty", "artist_province", "type", "material", "culture", "accession_number", "crawl_date")


# ---- records built from what sources deliver ------------------------------------------------------------------------------


@query(f"""SELECT rec_id::varchar AS object_id, '4' AS museum_id, CASE WHEN {_s_value('title')} = '' THEN '(untitled)' ELSE {_s_value('title')} END AS title, {_s_value('people')} AS artist,
{_s_value(f"CASE WHEN {s_strip('period')} <> '' THEN {s_strip('period')} ELSE {s_strip('dated')} END")} AS period, {_s_value('creditline')} AS credit_line, {_s_value('lastupdate')} AS source_updated_at FROM object_record""")
def built_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records built from an object API's JSON: what no gap is filled in."""
    from vitrine.plans.queries import object_records  # noqa: PLC0415

    return object_records(spark, sf_dir).select("object_id", "museum_id", "title", "artist", "period", "credit_line", "source_updated_at")


@query(f"""SELECT concat('S', seq) AS object_id, CASE WHEN {_s_value('title')} = '' THEN '(untitled)' ELSE {_s_value('title')} END AS title, {_s_value('credit')} AS credit_line, concat('https://x.example/objects/', seq) AS detail_url, '3' AS museum_id
FROM (SELECT seq, {_squeezed('title')} AS title, {_squeezed('credit_line')} AS credit FROM artifact)""")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read out of object pages, here pages made of every record."""
    a = artifact(spark, sf_dir)
    shown = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    field = lambda name, value: F.concat(F.lit(f'<div class="detailField {name}"><span class="detailFieldLabel">Label</span><span class="detailFieldValue">'), value, F.lit("</span></div>"))
    html = F.concat(F.lit("<html><body>"), field("titleField", shown("title")), field("creditlineField", shown("credit_line")), field("invnolineField", F.concat(F.lit("S"), "seq")), F.lit("</body></html>"))
    pages_of = a.select(F.concat(F.lit("https://x.example/objects/"), "seq", F.lit(";jsession?x=1")).alias("url"), html.alias("html"))
    return records.from_pages(pages_of).select("object_id", "title", "credit_line", "detail_url", "museum_id")


@query(f"""SELECT concat('edan-', seq) AS object_id, CASE WHEN {_s_value('title')} = '' THEN '(untitled)' ELSE {_s_value('title')} END AS title, {_s_value('artist')} AS artist, {_s_value('credit_line')} AS credit_line, CASE WHEN {_s_value('accession_number')} = '' THEN concat('edan-', seq) ELSE {_s_value('accession_number')} END AS acc, concat('https://x.example/', seq, '.jpg') AS image_url, '1' AS museum_id FROM artifact""")
def open_access_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records built from open-access JSON lines, here lines made of every record."""
    a = artifact(spark, sf_dir)
    media = F.struct(F.array(F.struct(F.lit("Screen Image").alias("label"), F.concat(F.lit("https://x.example/"), "seq", F.lit(".jpg")).alias("url"))).alias("media"))
    d = F.struct(F.concat(F.lit("edan-"), "seq").alias("record_ID"), media.alias("online_media"), F.col("accession_number").alias("accessionNumber"))
    content = F.struct(d.alias("descriptiveNonRepeating"), F.struct(F.array(F.struct(F.col("artist").alias("content"))).alias("name"), F.array(F.struct(F.col("credit_line").alias("content"))).alias("creditLine")).alias("freetext"))
    lines = a.select(F.to_json(F.struct(F.col("title"), content.alias("content"))).alias("value"))
    return records.from_open_access(lines).select("object_id", "title", "artist", "credit_line", F.col("accession_number").alias("acc"), "image_url", "museum_id")
