"""Index scans, predicates, limits and grid joins over the crawl index view."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gleaner.functions import numbers, text, urls
from gleaner.operators import lookups, predicates, ranking, reports
from gleaner.plans import steps
from gleaner.schema import INDEX_COLUMNS, SUMMARY_COLUMNS, select_ordered
from gleaner.session import scratch_dir
from gleaner.sources import index as ix
from gleaner.sources import layout, slices
from workload import fixtures as fx
from workload.fixtures import INDEX_SQL, LANGUAGES, SCOPE_SQL
from workload.registry import Tables, query

_FT = "strftime(fetch_time, '%Y-%m-%d %H:%M:%S') AS fetch_time"
_PLAIN = "url, fetch_status, content_mime_detected, warc_filename, warc_record_offset, warc_record_length"


def _time_text(df):
    return df.withColumn("fetch_time", F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss"))


def _rows(t: Tables):
    return ix.source_rows(fx.index(t), None, LANGUAGES)


@query("s01_index_scan", f"""
WITH {INDEX_SQL} SELECT {_PLAIN}, {_FT} FROM fx_index WHERE crawl = 'CC-MAIN-2023-05' AND subset = 'warc'
""")
def _(t: Tables):
    return _time_text(ix.scan_crawl(fx.index(t), "CC-MAIN-2023-05"))


@query("f01_index_predicate", f"""
WITH {INDEX_SQL} SELECT {_PLAIN}, {_FT}, crawl AS crawl_id, lang AS platform FROM fx_index WHERE {SCOPE_SQL}
""")
def _(t: Tables):
    return _time_text(_rows(t))


@query("f02_host_filter", f"""
WITH {INDEX_SQL} SELECT url, url_host_name FROM fx_index WHERE {SCOPE_SQL} AND lang = 'en'
  AND url_host_name = (SELECT max(url_host_name) FROM fx_index
    WHERE url_host_registered_domain = 'example.com' AND url_path LIKE '/en/%')
""")
def _(t: Tables):
    # The host is a setting of the profile; here it is the last English host of the data.
    df = fx.index(t)
    en = LANGUAGES[0]
    host = df.where(predicates.source_scope(en)).agg(F.max("url_host_name")).first()[0]
    rows = ix.source_rows(df, None, (replace(en, host=host),))
    return rows.select("url", urls.host(F.col("url")).alias("url_host_name"))


_LISTING_SQL = r"""
CASE lang
  WHEN 'en' THEN regexp_matches(url, '/en/\d+/?$') OR regexp_matches(url, '/en/\d+\?page=')
  WHEN 'de' THEN regexp_matches(url, '/de/\d+\?')
  WHEN 'es' THEN regexp_matches(url, '/es/\d+/$')
  WHEN 'fr' THEN regexp_matches(url, '/fr/\d{3}')
  ELSE false END
"""
_DETAIL_SQL = r"""
CASE lang
  WHEN 'en' THEN regexp_matches(url, '/en/\d+\.html$')
  WHEN 'de' THEN regexp_matches(url, '/de/\d+')
  WHEN 'fr' THEN regexp_matches(url, '/fr/\d{1,2}\D')
  ELSE false END
"""


@query("f03_listing_predicate", f"WITH {INDEX_SQL} SELECT page_id, {_LISTING_SQL} AS is_listing FROM fx_index")
def _(t: Tables):
    return fx.index(t).select(
        "page_id", predicates.is_listing(F.col("url"), F.col("lang"), LANGUAGES).alias("is_listing"))


@query("f04_listing_rows", r"""
SELECT url, 'de' AS platform FROM pages WHERE regexp_matches(url, '/de/\d+\?')
""")
def _(t: Tables):
    return predicates.listing_rows(t.pages.select("url"), "de", LANGUAGES)


@query("f05_page_kind", f"""
WITH {INDEX_SQL} SELECT page_id, CASE WHEN {_LISTING_SQL} THEN 'listing' WHEN {_DETAIL_SQL} THEN 'detail'
  ELSE 'other' END AS kind FROM fx_index
""")
def _(t: Tables):
    return fx.index(t).select("page_id", predicates.page_kind(F.col("url"), F.col("lang"), LANGUAGES).alias("kind"))


@query("f06_excluded_paths", """
SELECT page_id, url FROM pages
WHERE NOT (contains(lower(url), '/fr/') OR contains(lower(url), '.html') OR contains(lower(url), 'utm_'))
""")
def _(t: Tables):
    return t.pages.select("page_id", "url").where(~predicates.excluded(F.col("url"), ("/fr/", ".html", "utm_")))


@query("f07_like_predicates", f"""
WITH {INDEX_SQL} SELECT url FROM fx_index WHERE (url_path LIKE '/es/%' OR url_path LIKE '/de/%')
  AND url NOT LIKE '%?%' AND url_path NOT LIKE '%/' AND length(url_path) > 6
""")
def _(t: Tables):
    p = F.col("url_path")
    return fx.index(t).where(
        (p.like("/es/%") | p.like("/de/%")) & ~F.col("url").like("%?%") & ~p.like("%/") & (F.length(p) > 6)
    ).select("url")


_POINTER_SQL = """
  url, strftime(fetch_time, '%Y-%m-%dT%H:%M:%S') AS timestamp, fetch_status AS status,
  content_mime_detected AS mime, warc_filename AS filename, warc_record_offset AS "offset",
  warc_record_length AS length, crawl AS crawl_id, lang AS platform
"""


@query("f08_pointer_projection", f"WITH {INDEX_SQL} SELECT {_POINTER_SQL} FROM fx_index WHERE {SCOPE_SQL}")
def _(t: Tables):
    return ix.to_pointers(_rows(t))


@query("f09_constant_columns", """
SELECT page_id, 'CC-MAIN-2024-51' AS crawl_id, 'web' AS platform FROM pages
""")
def _(t: Tables):
    return t.pages.select("page_id").withColumns({"crawl_id": F.lit("CC-MAIN-2024-51"), "platform": F.lit("web")})


@query("f10_column_order", f"WITH {fx.LISTING_SQL} SELECT date, city, name, platform, rating FROM fx_listing")
def _(t: Tables):
    return select_ordered(fx.listing(t), ["date", "city", "name", "platform", "rating"])


@query("f11_required_fields", f"""
WITH {INDEX_SQL},
p AS (SELECT CASE WHEN page_id % 9 = 0 THEN '' WHEN page_id % 9 = 1 THEN NULL ELSE warc_filename END AS filename,
  CASE WHEN page_id % 8 = 0 THEN 0 WHEN page_id % 8 = 1 THEN NULL ELSE warc_record_length END AS length,
  CASE WHEN page_id % 5 = 0 THEN '' ELSE lang END AS platform, page_id FROM fx_index)
SELECT page_id, filename, length, platform FROM p WHERE coalesce(filename, '') <> '' AND length > 0 AND platform <> ''
""")
def _(t: Tables):
    pid = F.col("page_id")
    df = fx.index(t).select(
        "page_id",
        F.when(pid % 9 == 0, "").when(pid % 9 != 1, F.col("warc_filename")).alias("filename"),
        F.when(pid % 8 == 0, 0).when(pid % 8 != 1, F.col("warc_record_length")).alias("length"),
        F.when(pid % 5 == 0, "").otherwise(F.col("lang")).alias("platform"))
    return df.where(predicates.has_pointer() & predicates.has_platform())


@query("f12_known_platforms", f"""
WITH {INDEX_SQL} SELECT page_id, lang AS platform FROM fx_index WHERE lang IN ('en', 'de')
""")
def _(t: Tables):
    return predicates.known_platform(
        fx.index(t).select("page_id", F.col("lang").alias("platform")), LANGUAGES[:2])


@query("f13_crawl_id_check", f"""
WITH {INDEX_SQL}, c AS (SELECT page_id, crawl || CASE WHEN page_id % 4 = 0 THEN '''; --' ELSE '' END AS crawl FROM fx_index)
SELECT page_id, regexp_matches(crawl, '^[A-Za-z0-9-]+$') AS valid FROM c
""")
def _(t: Tables):
    crawl = F.concat("crawl", F.when(F.col("page_id") % 4 == 0, "'; --").otherwise(""))
    return fx.index(t).select("page_id", predicates.valid_crawl_id(crawl).alias("valid"))


@query("f16_value_filter", f"""
WITH {fx.LISTING_SQL} SELECT crawl_id, city, platform, count(*) AS restaurant_count FROM fx_listing
WHERE city = 'NATION_3' GROUP BY ALL
""")
def _(t: Tables):
    return reports.summary_table(fx.listing(t).where(F.col("city") == "NATION_3")).select(*SUMMARY_COLUMNS)


@query("w01_first_n_per_group", f"""
WITH {INDEX_SQL}, r AS (SELECT crawl AS crawl_id, lang AS platform, url,
  row_number() OVER (PARTITION BY crawl, lang ORDER BY url) AS rn FROM fx_index)
SELECT crawl_id, platform, url, rn FROM r WHERE rn <= 5
""")
def _(t: Tables):
    df = fx.index(t).select(F.col("crawl").alias("crawl_id"), F.col("lang").alias("platform"), "url")
    return ranking.first_n(df, ["crawl_id", "platform"], ["url"], 5)


@query("w02_sort_by_url", f"WITH {INDEX_SQL} SELECT url, warc_filename FROM fx_index WHERE {SCOPE_SQL} ORDER BY url")
def _(t: Tables):
    return _rows(t).orderBy("url").select("url", "warc_filename")


@query("w03_sort_by_keys", f"""
WITH {fx.LISTING_SQL} SELECT crawl_id, platform, city, count(*) AS restaurant_count FROM fx_listing GROUP BY ALL
ORDER BY crawl_id, platform, city
""")
def _(t: Tables):
    return reports.summary_table(fx.listing(t))


@query("w04_top_groups", f"""
WITH {fx.LISTING_SQL} SELECT city, count(*) AS n FROM fx_listing GROUP BY city ORDER BY n DESC, city LIMIT 10
""")
def _(t: Tables):
    return ranking.top_groups(fx.listing(t), "city", 10)


@query("w05_top_per_group", f"""
WITH {fx.LISTING_SQL}, c AS (SELECT platform, name, count(*) AS n FROM fx_listing GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY n DESC, name) AS rn FROM c)
SELECT platform, name, n, rn FROM r WHERE rn <= 7
""")
def _(t: Tables):
    return ranking.top_per_group(fx.listing(t), ["platform"], "name", 7)


@query("w06_limit_sample", """
SELECT page_id, url FROM pages WHERE url LIKE '%/de/%' ORDER BY url LIMIT 20
""")
def _(t: Tables):
    return ranking.limit_by(t.pages.select("page_id", "url").where(F.col("url").like("%/de/%")), ["url"], 20)


@query("w07_seeded_sample", f"""
WITH {INDEX_SQL}, r AS (SELECT crawl, lang, url,
  row_number() OVER (PARTITION BY crawl, lang ORDER BY md5(url || '42'), url) AS rn FROM fx_index)
SELECT crawl, lang, url FROM r WHERE rn <= 10
""")
def _(t: Tables):
    return ranking.seeded_sample(fx.index(t).select("crawl", "lang", "url"), ["crawl", "lang"], "url", 10, 42)


@query("w08_first_k_per_crawl", f"""
WITH {INDEX_SQL}, r AS (SELECT crawl AS crawl_id, url, row_number() OVER (PARTITION BY crawl ORDER BY url) AS rn
  FROM fx_index)
SELECT crawl_id, url, rn FROM r WHERE rn <= 50
""")
def _(t: Tables):
    df = fx.index(t).select(F.col("crawl").alias("crawl_id"), "url")
    return reports.first_per_crawl(df, ["url"], 50)


@query("w09_collision_versions", f"""
WITH {INDEX_SQL},
k AS (SELECT page_id, url, lang AS platform, crawl AS crawl_id, strftime(fetch_time, '%Y-%m-%dT%H:00:00') AS timestamp,
  'p/' || CAST(page_id // 12 AS VARCHAR) AS key FROM fx_index),
v AS (SELECT *, row_number() OVER (PARTITION BY platform, crawl_id, key ORDER BY timestamp, url, page_id) AS version,
  row_number() OVER (PARTITION BY platform, crawl_id, key, timestamp ORDER BY url, page_id) AS same FROM k)
SELECT page_id, version, CASE WHEN version = 1 THEN key
  ELSE key || '_' || replace(replace(timestamp, ':', '-'), 'T', '_') || CASE WHEN same > 1 THEN '_' || same ELSE '' END END
  AS stored_key FROM v
""")
def _(t: Tables):
    df = fx.index(t).select(
        "page_id", "url", F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"),
        F.date_format("fetch_time", "yyyy-MM-dd'T'HH:00:00").alias("timestamp"),
        F.concat(F.lit("p/"), F.floor(F.col("page_id") / 12).cast("string")).alias("key"))
    return ranking.collision_versions(df, ["platform", "crawl_id"], "key", "timestamp", ties=("url", "page_id")).select(
        "page_id", "version", "stored_key")


@query("j06_crawl_grid", f"""
WITH {INDEX_SQL}, f AS (SELECT crawl AS crawl_id, lang AS platform FROM fx_index WHERE {SCOPE_SQL}
    AND url_path LIKE '%.html'),
g AS (SELECT DISTINCT crawl AS crawl_id, p.platform FROM fx_index,
  (VALUES ('en'), ('de'), ('es'), ('fr')) p(platform))
SELECT g.crawl_id, g.platform, count(f.crawl_id) AS n FROM g LEFT JOIN f USING (crawl_id, platform) GROUP BY ALL
""")
def _(t: Tables):
    df = fx.index(t)
    crawls = df.select(F.col("crawl").alias("crawl_id")).distinct()
    return lookups.grid_counts(_rows(t).where(F.col("url").rlike(r"\.html([?#]|$)")), crawls, LANGUAGES)


@query("j08_profile_dispatch", f"""
WITH {INDEX_SQL} SELECT page_id, lang AS platform,
  CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS display_name,
  CASE lang WHEN 'en' THEN 'example.com' WHEN 'de' THEN 'example.org' WHEN 'es' THEN 'example.net' END AS domain
FROM fx_index WHERE lang IN ('en', 'de', 'es')
""")
def _(t: Tables):
    df = fx.index(t).select("page_id", F.col("lang").alias("platform"))
    return lookups.dispatch(df, LANGUAGES[:3], display_name=lambda p: p.name, domain=lambda p: p.domain)


@query("a06_rollup_totals", f"""
WITH {INDEX_SQL} SELECT lang AS platform, crawl AS crawl_id, count(*) AS n,
  CAST(grouping(lang, crawl) AS BIGINT) AS level FROM fx_index GROUP BY ROLLUP (lang, crawl)
""")
def _(t: Tables):
    df = fx.index(t).select(F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"))
    return reports.with_total(df, ["platform", "crawl_id"])


@query("a07_unique_urls", f"""
WITH {INDEX_SQL} SELECT lang AS platform, crawl AS crawl_id, count(*) AS n,
  count(DISTINCT url_path) AS n_unique FROM fx_index GROUP BY ALL
""")
def _(t: Tables):
    return reports.unique_urls(fx.index(t).select(
        F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"), F.col("url_path").alias("url")))


@query("a12_segment_histogram", r"""
WITH s AS (SELECT regexp_replace(regexp_extract(url, '//([^/.]+)[.]', 1), '_\d+$', '') AS segment FROM pages
  WHERE NOT regexp_matches(url, '/en/([^/]+)'))
SELECT segment, count(*) AS n, regexp_matches(segment, 'food|menjar|comida|restaur|cocina|cuina') AS food_like
FROM s WHERE regexp_matches(segment, '^[a-z]') GROUP BY segment ORDER BY n DESC, segment LIMIT 20
""")
def _(t: Tables):
    return reports.segment_histogram(t.pages.select("url"), "//([^/.]+)[.]", "/en/([^/]+)")


@query("a12_category_share", """
SELECT count(*) FILTER (WHERE regexp_matches(url, '/en/([^/]+)')) AS with_category, count(*) AS total,
  round(avg(CASE WHEN regexp_matches(url, '/en/([^/]+)') THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct FROM pages
""")
def _(t: Tables):
    return reports.category_share(t.pages.select("url"), "/en/([^/]+)")


@query("a13_marker_counts", f"""
WITH {INDEX_SQL} SELECT f.crawl AS crawl_id,
  count(*) FILTER (WHERE contains(html, '<article')) AS with_marker,
  count(*) FILTER (WHERE NOT contains(html, '<article')) AS without_marker
FROM fx_index f JOIN pages USING (page_id) GROUP BY ALL
""")
def _(t: Tables):
    crawl = F.concat(F.lit("CC-MAIN-202"), (2 + F.col("page_id") % 3).cast("string"), F.lit("-05"))
    return reports.marker_counts(t.pages.select(crawl.alias("crawl_id"), "html"), "<article")


@query("a17_path_patterns", f"""
WITH {INDEX_SQL} SELECT CASE WHEN url_path LIKE '/de/%' THEN '/de/...' WHEN url_path LIKE '/fr/1%' THEN '/fr/1...'
  ELSE regexp_extract(url_path, '^(/[^/]+/[0-9])', 1) END AS pattern, count(*) AS cnt
FROM fx_index GROUP BY 1 HAVING count(*) > 3 ORDER BY cnt DESC, pattern LIMIT 30
""")
def _(t: Tables):
    bucket = urls.pattern_bucket(
        F.col("url_path"), {"/de/%": "/de/...", "/fr/1%": "/fr/1..."}, "^(/[^/]+/[0-9])")
    return reports.path_patterns(fx.index(t), bucket, 3)


@query("c21_host", "SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", urls.host(F.col("url")).alias("host"))


@query("c22_path_bucket", r"""
SELECT page_id, CASE WHEN regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) LIKE '/en/%' THEN 'english'
  ELSE regexp_extract(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1), '^/([a-z]+/[0-9]+)', 1) END AS bucket FROM pages
""")
def _(t: Tables):
    bucket = urls.pattern_bucket(urls.path(F.col("url")), {"/en/%": "english"}, "^/([a-z]+/[0-9]+)")
    return t.pages.select("page_id", bucket.alias("bucket"))


@query("c23_storage_key", r"""
SELECT page_id, rtrim(ltrim(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1), '/'), '/') || '/caf_é_' ||
  CAST(page_id AS VARCHAR) AS key FROM pages
""")
def _(t: Tables):
    odd = F.concat(
        F.regexp_extract("url", "^([^?#]*)", 1), F.lit("//__caf%20%C3%A9+*"), F.col("page_id").cast("string"),
        F.lit("%21/?q=1#x"))
    return t.pages.select("page_id", urls.storage_key(odd).alias("key"))


@query("c24_short_hash", "SELECT page_id, substring(md5(url), 1, 12) AS h FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", text.short_hash(F.col("url")).alias("h"))


@query("c25_timestamp_text", f"""
WITH {INDEX_SQL} SELECT page_id, strftime(fetch_time, '%Y-%m-%dT%H:%M:%S') AS iso,
  strftime(fetch_time, '%Y-%m-%d_%H-%M-%S') AS suffix FROM fx_index
""")
def _(t: Tables):
    iso = numbers.timestamp_iso(F.date_format("fetch_time", "yyyy-MM-dd HH:mm:ss.SSS"))
    return fx.index(t).select("page_id", iso.alias("iso"), numbers.timestamp_suffix(iso).alias("suffix"))


@query("c26_split_from_right", f"""
WITH {INDEX_SQL} SELECT page_id, crawl || '_x' AS crawl_part, lang AS platform_part FROM fx_index
""")
def _(t: Tables):
    crawl, platform = lookups.split_store_name(F.concat_ws("_", "crawl", F.lit("x"), "lang"))
    return fx.index(t).select("page_id", crawl.alias("crawl_part"), platform.alias("platform_part"))


@query("c27_reversed_domain", """
SELECT page_id, array_to_string(list_reverse(string_split(regexp_extract(url, 'https?://([^/]+)', 1), '.')), ',') AS surt
FROM pages
""")
def _(t: Tables):
    return t.pages.select("page_id", urls.reversed_domain(urls.host(F.col("url"))).alias("surt"))


@query("c30_key_sanitising", "SELECT page_id, replace(url, '/', '-') AS safe FROM pages")
def _(t: Tables):
    return t.pages.select("page_id", text.path_safe(F.col("url")).alias("safe"))


@query("d04_distinct_urls", r"SELECT DISTINCT regexp_extract(url, '^([^?#]*/[a-z]+/)', 1) AS url FROM pages")
def _(t: Tables):
    from gleaner.operators.resolve import distinct_urls

    return distinct_urls(t.pages.select(F.regexp_extract("url", "^([^?#]*/[a-z]+/)", 1).alias("url")))


@query("s09_index_document", f"""
WITH {INDEX_SQL} SELECT crawl AS crawl_id, lang AS platform, url, CAST(fetch_status AS VARCHAR) AS status,
  content_mime_detected AS mime, warc_filename AS filename, CAST(warc_record_offset AS VARCHAR) AS "offset",
  CAST(warc_record_length AS VARCHAR) AS length FROM fx_index WHERE {SCOPE_SQL}
""")
def _(t: Tables):
    path = f"{scratch_dir(t.spark, 's09')}/documents"
    ix.write_documents(ix.to_pointers(_rows(t)), path)
    return ix.flatten_document(t.spark.read.text(path))


@query("s16_reuse_results", f"""
WITH {INDEX_SQL}, c AS (SELECT crawl AS crawl_id, lang AS platform, url FROM fx_index WHERE {SCOPE_SQL})
SELECT crawl_id, platform, url, CASE WHEN crawl_id = 'CC-MAIN-2023-05' AND platform <> 'fr' THEN 'stored'
  ELSE 'computed' END AS origin, 2 AS n_reads FROM c WHERE crawl_id <> 'CC-MAIN-2022-05' OR platform <> 'es'
""")
def _(t: Tables):
    crawls = ["CC-MAIN-2022-05", "CC-MAIN-2023-05", "CC-MAIN-2024-05"]
    path, rows, crawl, platform = f"{scratch_dir(t.spark, 's16')}/results", _rows(t), F.col("crawl_id"), F.col("platform")
    here = (crawl == "CC-MAIN-2023-05") & (platform != "fr")
    grid = lookups.crawl_grid(rows.select("crawl_id").distinct(), LANGUAGES)

    def publish(which, mark):
        slices.publish(rows.where(which).withColumn("warc_filename", F.lit(mark)).select(*ix.RESULT.fieldNames()), path, grid.where(which))

    publish(here, "old")
    publish(here, "stored")
    # One slice was computed and is empty; a run that died has staged two slices, one of which is published already.
    slices.publish(rows.where("false").select(*ix.RESULT.fieldNames()), path, grid.where((crawl == "CC-MAIN-2022-05") & (platform == "es")))
    half = rows.where((platform == "fr") | here).withColumn("warc_filename", F.lit("half")).select(*ix.RESULT.fieldNames())
    slices.stage(half, path, slices.new_version())
    ix.reuse_or_scan(fx.index(t), path, crawls, LANGUAGES)
    found = ix.reuse_or_scan(fx.index(t).where("false"), path, crawls, LANGUAGES)  # everything is stored by now
    name = F.col("warc_filename")
    origin = F.when(name == "stored", "stored").when(name.isin("old", "half"), name).otherwise("computed")
    return found.select("crawl_id", "platform", "url", origin.alias("origin"), F.lit(2).alias("n_reads"))


@query("s16_missing_slices", f"""
WITH {INDEX_SQL}, c AS (SELECT DISTINCT crawl AS crawl_id, lang AS platform FROM fx_index)
SELECT crawl_id, platform FROM c WHERE crawl_id <> 'CC-MAIN-2023-05'
""")
def _(t: Tables):
    df = fx.index(t).select(F.col("crawl").alias("crawl_id"), F.col("lang").alias("platform"))
    wanted = lookups.crawl_grid(df.select("crawl_id").distinct(), LANGUAGES)
    return ix.missing_slices(wanted, df.where(F.col("crawl_id") == "CC-MAIN-2023-05"))


@query("p01_index_step", f"""
WITH {INDEX_SQL} SELECT crawl AS crawl_id, lang AS platform, count(*) AS n, sum(warc_record_length)::BIGINT AS bytes
FROM fx_index WHERE {SCOPE_SQL} AND crawl IN ('CC-MAIN-2022-05', 'CC-MAIN-2024-05') GROUP BY ALL
""")
def _(t: Tables):
    rows = steps.index_step(fx.index(t), ["CC-MAIN-2022-05", "CC-MAIN-2024-05"], LANGUAGES)
    return rows.groupBy("crawl_id", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum("warc_record_length").alias("bytes"))


@query("s01_clustered_scan", f"""
WITH {INDEX_SQL} SELECT url, crawl, subset, url_path, true AS fewer_files FROM fx_index
WHERE url_host_registered_domain IN ('example.net', 'absent.example') AND crawl IN ('CC-MAIN-2022-05', 'CC-MAIN-2023-05')
""")
def _(t: Tables):
    path = f"{scratch_dir(t.spark, 's01c')}/index"
    layout.write_clustered_index(fx.index(t), path, file_rows=max(1, t.pages.count() // 16))
    crawls = ["CC-MAIN-2022-05", "CC-MAIN-2023-05"]
    found = layout.read_clustered_index(t.spark, path, ["example.net", "absent.example"], crawls)
    whole = ix.read_index(t.spark, f"{path}/rows").where(F.col("crawl").isin(*crawls))
    fewer = len(found.inputFiles()) < len(whole.inputFiles())
    return found.select("url", "crawl", "subset", "url_path", F.lit(fewer).alias("fewer_files"))
