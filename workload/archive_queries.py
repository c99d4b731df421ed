"""Reading archives and the page store, and the steps that connect them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import lookups
from gleaner.plans import steps
from gleaner.session import scratch_dir
from gleaner.sources import index as ix
from gleaner.sources import gzip_lines, page_store, warc
from workload import archive
from workload import fixtures as fx
from workload.archive import READABLE_SQL
from workload.fixtures import INDEX_SQL, LANGUAGES, SCOPE_SQL
from workload.registry import Tables, query

_CDX_SQL = f"""
WITH {INDEX_SQL} SELECT array_to_string(list_reverse(string_split(url_host_name, '.')), ',') || ')' || url_path AS urlkey,
  strftime(fetch_time, '%Y%m%d%H%M%S') AS timestamp, url, CAST(fetch_status AS VARCHAR) AS status,
  content_mime_detected AS mime, warc_filename AS filename, CAST(warc_record_offset AS VARCHAR) AS "offset",
  CAST(warc_record_length AS VARCHAR) AS length FROM fx_index
"""


@query("s02_cdx_text", f"{_CDX_SQL} WHERE url_host_registered_domain = 'example.com'")
def _(t: Tables):
    path = f"{scratch_dir(t.spark, 's02')}/cdx"
    archive.cdx_lines(t).write.option("compression", "gzip").text(path)
    return ix.read_cdx(t.spark, path, "example.com", reversed_key=True)


@query("s02_split_members", f"""
{_CDX_SQL} WHERE url_host_registered_domain = 'example.com' UNION ALL {_CDX_SQL.replace("WITH", "SELECT * FROM (WITH", 1)}
  WHERE url_host_registered_domain = 'example.com')
""")
def _(t: Tables):
    # Files of 40 members in ranges of 2,000 bytes, and plain files beside them.
    root = archive.write_gzip_members(t, archive.cdx_lines(t), "s02m")
    archive.cdx_lines(t).write.mode("append").text(root)
    lines = gzip_lines.read_lines(t.spark, root, 2000, "*.gz").unionByName(t.spark.read.option("pathGlobFilter", "*[!z]").text(root))
    return ix.parse_cdx(lines, "example.com", reversed_key=True)


@query("s03_cdx_json_lines", f"{_CDX_SQL} WHERE fetch_status = 200")
def _(t: Tables):
    path = f"{scratch_dir(t.spark, 's03')}/cdx"
    lines = archive.cdx_lines(t)
    parts = F.split("value", " ", 3)
    head = F.to_json(F.struct(parts[0].alias("urlkey"), parts[1].alias("timestamp")))
    merged = F.concat(F.expr("substring(h, 1, length(h) - 1)"), F.lit(","), F.expr("substring(j, 2)"))
    docs = lines.select(head.alias("h"), F.get(parts, F.lit(2)).alias("j"))
    docs.select(F.coalesce(merged, F.lit('{"status": "200')).alias("value")).write.text(path)
    return ix.read_cdx_json(t.spark, path)


@query("s04_warc_ranges", f"""
WITH {INDEX_SQL}, {READABLE_SQL} SELECT url, crawl AS crawl_id, lang AS platform, CAST(strlen(html) AS BIGINT) AS n FROM readable
  WHERE page_id % 7 <> 3
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "s04")
    got = warc.read_ranges(ix.to_pointers(rows), root).where(F.col("body").isNotNull())
    return got.where(F.col("body").substr(1, 1) != F.lit(b"\xe9")).select(
        "url", "crawl_id", "platform", F.octet_length("body").cast("bigint").alias("n"))


@query("s04_failed_ranges", f"""
WITH {INDEX_SQL} SELECT lang AS platform, crawl AS crawl_id, count(*) AS n_failed FROM fx_index
WHERE page_id % 13 <> 7 AND (page_id % 11 = 5 OR page_id % 17 = 4) GROUP BY ALL
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "s04f")
    return warc.fetch_issues(warc.read_ranges(ix.to_pointers(rows), root))


@query("s05_response_split", f"""
WITH {INDEX_SQL}, {READABLE_SQL} SELECT url, substring(html, 1, 15) AS head FROM readable WHERE page_id % 7 <> 3
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "s05")
    pages = warc.to_pages(warc.read_ranges(ix.to_pointers(rows), root))
    return pages.where(~F.col("html").startswith("é")).select("url", F.substring("html", 1, 15).alias("head"))


@query("s06_body_decode", f"""
WITH {INDEX_SQL}, {READABLE_SQL} SELECT url, md5(html) AS html_md5, length(html) AS n_chars FROM readable
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "s06")
    pages = warc.to_pages(warc.read_ranges(ix.to_pointers(rows), root))
    return pages.select("url", F.md5(F.col("html").cast("binary")).alias("html_md5"), F.length("html").cast("bigint").alias("n_chars"))


@query("s06_lenient_decode", """
SELECT page_id, strlen(html) + 3 AS n_bytes, '�' AS last FROM pages
""")
def _(t: Tables):
    broken = F.concat(F.col("html").cast("binary"), F.lit(b"\xff"))
    text = warc.decode_replacing(broken)
    return t.pages.select(
        "page_id", F.octet_length(text).cast("bigint").alias("n_bytes"), F.substring(text, -1, 1).alias("last"))


@query("s07_page_sink", f"""
WITH {INDEX_SQL}, k AS (SELECT page_id, url, lang AS platform, crawl AS crawl_id, strftime(fetch_time, '%Y-%m-%dT%H:%M:%S') AS timestamp,
  substring(lang || '/' || regexp_extract(url_path, '([0-9])', 1), 1) AS key FROM fx_index),
v AS (SELECT *, row_number() OVER (PARTITION BY platform, crawl_id, key ORDER BY timestamp, url) AS version FROM k)
SELECT platform, crawl_id, version, CASE WHEN version = 1 THEN key
  ELSE key || '_' || replace(replace(timestamp, ':', '-'), 'T', '_') END AS stored_key, strlen(html) AS n
FROM v JOIN (SELECT page_id, html FROM pages) USING (page_id)
""")
def _(t: Tables):
    short = F.regexp_replace("url", r"^([a-z]+://[^/]+/[a-z]+/[0-9]).*$", "$1")
    slim = fx.index(t).select(
        "page_id", short.alias("url"), F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"),
        F.date_format("fetch_time", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("url").alias("full_url"))
    keyed = page_store.with_stored_key(slim)
    path = f"{scratch_dir(t.spark, 's07')}/pages"
    page_store.write_pages(keyed.join(t.pages.select("page_id", "html"), "page_id"), path)
    return t.spark.read.parquet(page_store.place(path)).select(
        "platform", "crawl_id", "version", "stored_key", F.octet_length("html").cast("bigint").alias("n"))


@query("s08_page_files", f"""
WITH {INDEX_SQL} SELECT CASE WHEN page_id % 3 <> 0 THEN url ELSE '' END AS url,
  CASE WHEN page_id % 3 <> 0 THEN '2022-01-01T' || page_id ELSE 'T0' END AS timestamp,
  crawl AS crawl_id, lang AS platform, page_id % 3 <> 0 AS has_sidecar, length(html) + 1 AS n_chars
FROM fx_index JOIN (SELECT page_id, html FROM pages) USING (page_id)
""")
def _(t: Tables):
    root = archive.write_page_files(t, "s08")
    files = page_store.read_page_files(t.spark, root)
    slim = files.select(
        *lookups.PLACE,
        F.length(warc.decode_replacing(F.col("body"))).cast("bigint").alias("n_chars"))
    side = page_store.read_sidecars(t.spark, root)
    return lookups.with_metadata(slim, side).select(
        "url", "timestamp", "crawl_id", "platform", "has_sidecar", "n_chars")


_P02_SQL = """
f AS (SELECT *, row_number() OVER (PARTITION BY crawl, lang ORDER BY url) AS rn FROM fx_index
  WHERE {scope} AND page_id % 13 <> 7 AND CASE lang WHEN 'en' THEN regexp_matches(url, '/en/\\d+/?$')
    OR regexp_matches(url, '/en/\\d+\\?page=') WHEN 'de' THEN regexp_matches(url, '/de/\\d+\\?')
    WHEN 'es' THEN regexp_matches(url, '/es/\\d+/$') ELSE regexp_matches(url, '/fr/\\d{{3}}') END)
"""


def _fetch(t: Tables, label: str):
    """Two fetches into one store, first the listing pages and then everything."""
    root, rows = archive.write_warcs(t, label)
    out = f"{scratch_dir(t.spark, label)}/pages"
    found = ix.source_rows(rows.drop("crawl_id", "platform"), None, LANGUAGES)
    first = steps.fetch_step(steps.plan_fetch(found, 20, True, LANGUAGES), root, out)
    return root, found, out, first


@query("p02_fetch_step", f"""
WITH {INDEX_SQL}, {_P02_SQL.format(scope=SCOPE_SQL)}, {READABLE_SQL}
SELECT url, crawl AS crawl_id, lang AS platform, md5(html) AS html_md5 FROM readable
WHERE page_id IN (SELECT page_id FROM f WHERE rn <= 20)
""")
def _(t: Tables):
    _, _, out, _ = _fetch(t, "p02")
    return page_store.read_pages(t.spark, out).select(
        "url", "crawl_id", "platform", F.md5(F.col("html").cast("binary")).alias("html_md5"))


# Pointers of which many share address and time, and some lack one of them. The first fetch cannot read anything, the
# second one reads even pages, the third all, the fourth finds nothing new. Versions go on after those that are stored.
_IDENTITY_SQL = f"""
WITH {INDEX_SQL}, w AS (SELECT page_id, lang AS platform, crawl AS crawl_id, page_id % 11 <> 5 AND page_id % 17 <> 4 AS ok,
    page_id % 2 = 0 AS early, CASE WHEN page_id % 9 <> 2 THEN regexp_extract(url, '^([a-z]+://[^/]+/[a-z]+/[0-9])', 1) END AS url,
    CASE WHEN page_id % 10 <> 3 THEN strftime(fetch_time, '%Y-%m-%dT00:00:00') END AS timestamp,
    CASE WHEN page_id % 9 <> 2 THEN lang || '/' || regexp_extract(url_path, '([0-9])', 1) ELSE '{{empty}}' END AS key
  FROM fx_index WHERE page_id % 13 <> 7),
a AS (SELECT *, row_number() OVER (PARTITION BY platform, crawl_id, key ORDER BY coalesce(timestamp, ''), url NULLS FIRST, page_id) AS version,
    row_number() OVER (PARTITION BY platform, crawl_id, key, coalesce(timestamp, '') ORDER BY url NULLS FIRST, page_id) AS number FROM w WHERE early),
l AS (SELECT platform, crawl_id, key, max(version) AS version FROM a WHERE ok GROUP BY ALL),
m AS (SELECT platform, crawl_id, key, coalesce(timestamp, '') AS moment, max(number) AS number FROM a WHERE ok GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY platform, crawl_id, key ORDER BY coalesce(timestamp, ''), url NULLS FIRST, page_id) AS version,
    row_number() OVER (PARTITION BY platform, crawl_id, key, coalesce(timestamp, '') ORDER BY url NULLS FIRST, page_id) AS number
  FROM w WHERE NOT early OR NOT ok),
b2 AS (SELECT b.* REPLACE (b.version + coalesce(l.version, 0) AS version, b.number + coalesce(m.number, 0) AS number)
  FROM b LEFT JOIN l USING (platform, crawl_id, key)
  LEFT JOIN m ON m.platform = b.platform AND m.crawl_id = b.crawl_id AND m.key = b.key AND m.moment = coalesce(b.timestamp, '')),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b2)
"""


def _identity(t: Tables, label: str):
    """The store after the four fetches, and the failures of the third."""
    root, rows = archive.write_warcs(t, label, per_page=True)
    pid, out = F.col("page_id"), f"{scratch_dir(t.spark, label)}/pages"
    short = F.regexp_extract("url", r"^([a-z]+://[^/]+/[a-z]+/[0-9])", 1)
    day = F.date_format("fetch_time", "yyyy-MM-dd'T'00:00:00")
    pointers = archive.table(t.spark, rows.where(pid % 13 != 7).select(
        "page_id", F.when(pid % 9 != 2, short).alias("url"), F.when(pid % 10 != 3, day).alias("timestamp"),
        F.lit(200).alias("status"), F.lit("text/html").alias("mime"), F.col("warc_filename").alias("filename"),
        F.col("warc_record_offset").alias("offset"), F.col("warc_record_length").alias("length"),
        F.col("crawl").alias("crawl_id"), F.col("lang").alias("platform")), label)
    steps.fetch_step(pointers, f"{root}-gone", out)
    steps.fetch_step(pointers.where(pid % 2 == 0), root, out)
    failed = steps.fetch_step(pointers.unionByName(pointers.where(pid % 3 == 0)), root, out)
    steps.fetch_step(pointers, root, out)
    return page_store.read_stored(t.spark, out), failed


@query("p02_second_fetch", f"""
{_IDENTITY_SQL} SELECT url, timestamp, crawl_id, platform, key, version, key || CASE WHEN version = 1 THEN '' ELSE '_' ||
    replace(replace(coalesce(timestamp, ''), ':', '-'), 'T', '_') || CASE WHEN number > 1 THEN '_' || number ELSE '' END END AS stored_key,
  CAST(lpad(CAST(page_id AS VARCHAR), 12, '0') || '.warc.gz' AS VARCHAR) AS filename FROM u WHERE ok
""".replace("{empty}", "index"))
def _(t: Tables):
    return _identity(t, "p02s")[0].select("url", "timestamp", "crawl_id", "platform", "key", "version", "stored_key", "filename")


@query("p02_refetch_failures", f"""
{_IDENTITY_SQL} SELECT url, timestamp, crawl_id, platform, lpad(CAST(page_id AS VARCHAR), 12, '0') || '.warc.gz' AS filename
FROM b WHERE NOT ok
""".replace("{empty}", "index"))
def _(t: Tables):
    return _identity(t, "p02r")[1].select("url", "timestamp", "crawl_id", "platform", "filename")


@query("p02_failures", f"""
WITH {INDEX_SQL} SELECT url, crawl AS crawl_id, lang AS platform FROM fx_index
WHERE {SCOPE_SQL} AND page_id % 13 <> 7 AND (page_id % 11 = 5 OR page_id % 17 = 4)
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "p02f")
    found = ix.source_rows(rows.drop("crawl_id", "platform"), None, LANGUAGES)
    failed = steps.fetch_step(steps.plan_fetch(found, None, False, LANGUAGES), root, f"{scratch_dir(t.spark, 'p02f')}/pages")
    return failed.select("url", "crawl_id", "platform")


@query("p04_sample_download", f"""
WITH {INDEX_SQL}, s AS (SELECT page_id FROM fx_index WHERE url_path LIKE '/de/%' AND url NOT LIKE '%?%'
  AND page_id % 13 <> 7 ORDER BY url, fetch_time LIMIT 15), {READABLE_SQL}
SELECT url, md5(html) AS html_md5, lang AS platform, crawl AS crawl_id, true AS keyed
FROM readable WHERE page_id IN (SELECT page_id FROM s)
""")
def _(t: Tables):
    root, rows = archive.write_warcs(t, "p04")
    wanted = F.col("url_path").like("/de/%") & ~F.col("url").like("%?%")
    out = f"{scratch_dir(t.spark, 'p04')}/samples"
    steps.sample_step(rows, wanted, 15, root, out)
    return page_store.read_stored(t.spark, out).select(
        "url", F.md5(F.col("html").cast("binary")).alias("html_md5"), "platform", "crawl_id",
        (F.length("stored_key") > 0).alias("keyed"))
