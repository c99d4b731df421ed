"""De-duplication, summaries and table rules over the listing view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import heavy, quality, reports, resolve
from gleaner.schema import ENTITY_COLUMNS
from gleaner.session import scratch_dir
from gleaner.sources import entity_store as store
from workload import fixtures as fx
from workload.fixtures import LISTING_ORDER, LISTING_ORDER_SQL, LISTING_SQL
from workload.registry import Tables, query

_KEY_SQL = """
  coalesce(restaurant_url, '') <> '', CASE WHEN coalesce(restaurant_url, '') <> '' THEN restaurant_url ELSE {name} END,
  CASE WHEN coalesce(restaurant_url, '') <> '' THEN '' ELSE platform || '|' || {city} END, crawl_id
"""
_PLAIN_KEY = _KEY_SQL.format(name="lower(name)", city="lower(city)")
_DEDUP_SQL = f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {_PLAIN_KEY} ORDER BY {LISTING_ORDER_SQL}) AS rn FROM fx_listing),
unique_rows AS (SELECT * FROM ranked WHERE rn = 1)
"""
_DEDUP_COLUMNS = ["name", "platform", "city", "crawl_id", "restaurant_url", "source_url", "rating", "date"]


@query("d01_deduplicate", f"""
WITH {LISTING_SQL}, {_DEDUP_SQL} SELECT {', '.join(_DEDUP_COLUMNS)} FROM unique_rows
""")
def _(t: Tables):
    return resolve.drop_duplicates_first(fx.listing_lines(t), LISTING_ORDER, cells=fx.listing_cells()).select(*_DEDUP_COLUMNS)


@query("d02_deduplicate_trimmed", f"""
WITH {LISTING_SQL},
padded AS (SELECT * REPLACE (CASE WHEN l_quantity_odd THEN '  ' || name ELSE name || ' ' END AS name,
    nullif(city, '') AS city) FROM (SELECT *, num_ratings % 2 = 1 AS l_quantity_odd FROM fx_listing)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY
  {_KEY_SQL.format(name="trim(lower(name))", city="trim(lower(coalesce(city, '')))")}
  ORDER BY {LISTING_ORDER_SQL}) AS rn FROM padded)
SELECT name, platform, city, crawl_id, restaurant_url, source_url FROM ranked WHERE rn = 1
""")
def _(t: Tables):
    cells = fx.listing_cells()
    odd, name = cells["num_ratings"] % 2 == 1, cells["name"]
    cells |= {
        "name": F.when(odd, F.concat(F.lit("  "), name)).otherwise(F.concat(name, F.lit(" "))),
        "city": F.nullif(cells["city"], F.lit(""))}
    return resolve.drop_duplicates_first(fx.listing_lines(t), LISTING_ORDER, trim=True, cells=cells).select(
        "name", "platform", "city", "crawl_id", "restaurant_url", "source_url")


@query("d03_first_in_page", f"""
WITH {LISTING_SQL}, r AS (SELECT source_url, name, date, row_number() OVER (
  PARTITION BY source_url, lower(name) ORDER BY {LISTING_ORDER_SQL}) AS rn FROM fx_listing)
SELECT source_url, name, date FROM r WHERE rn = 1
""")
def _(t: Tables):
    df = fx.listing(t).withColumn("pos", F.struct(*LISTING_ORDER))
    return resolve.first_in_page(df, ["source_url"]).select("source_url", "name", "date")


@query("d05_bag_union", f"""
WITH {LISTING_SQL} SELECT name, city, food_type FROM fx_listing WHERE platform = 'A'
UNION ALL SELECT name, city, NULL FROM fx_listing WHERE platform <> 'A'
""")
def _(t: Tables):
    df = fx.listing(t)
    return resolve.bag_union(
        df.where(F.col("platform") == "A").select("name", "city", "food_type"),
        df.where(F.col("platform") != "A").select("city", "name"))


_BRANCH_SQL = """
branches AS (SELECT source_url, name, platform, l_linenumber,
  CASE WHEN l_linenumber % 3 = 0 THEN 'jsonld' WHEN l_linenumber % 3 = 1 THEN 'script' ELSE 'card' END AS branch,
  l_linenumber % 3 AS priority FROM fx_listing)
"""


def _branches(t: Tables):
    line = F.col("l_linenumber")
    return fx.listing(t).select(
        "source_url", "name", "platform", "l_linenumber",
        F.when(line % 3 == 0, "jsonld").when(line % 3 == 1, "script").otherwise("card").alias("branch"),
        (line % 3).alias("priority"))


@query("d06_additive_branches", f"""
WITH {LISTING_SQL}, {_BRANCH_SQL}
SELECT source_url, name, branch, platform FROM branches b WHERE NOT (branch = 'script' AND platform = 'A' AND EXISTS (
  SELECT 1 FROM branches j WHERE j.source_url = b.source_url AND j.branch = 'jsonld' AND j.platform = 'A'))
""")
def _(t: Tables):
    return resolve.additive_branches(_branches(t), ["source_url"], F.col("platform") == "A").select(
        "source_url", "name", "branch", "platform")


@query("d07_first_branch", f"""
WITH {LISTING_SQL}, {_BRANCH_SQL}, b AS (SELECT *, min(priority) OVER (PARTITION BY source_url) AS best FROM branches)
SELECT source_url, name, branch FROM b WHERE priority = best
""")
def _(t: Tables):
    return resolve.first_branch(_branches(t), ["source_url"]).select("source_url", "name", "branch")


@query("d08_missing_names", f"""
WITH {LISTING_SQL}, a AS (SELECT DISTINCT date, name FROM fx_listing WHERE platform = 'A'),
r AS (SELECT DISTINCT date, name FROM fx_listing WHERE platform <> 'A')
SELECT date, name FROM a EXCEPT SELECT date, name FROM r
""")
def _(t: Tables):
    df = fx.listing(t)
    keys = ["date", "name"]
    wanted = df.where(F.col("platform") == "A").select(*keys).distinct()
    return resolve.missing_names(wanted, df.where(F.col("platform") != "A"), keys)


@query("a01_summary_counts", f"""
WITH {LISTING_SQL} SELECT platform, crawl_id, city, date, count(*) AS n,
  CASE WHEN grouping(platform) = 0 THEN 'by_platform' WHEN grouping(crawl_id) = 0 THEN 'by_crawl'
       WHEN grouping(city) = 0 THEN 'by_city' WHEN grouping(date) = 0 THEN 'by_date' ELSE 'total' END AS level
FROM fx_listing GROUP BY GROUPING SETS ((platform), (crawl_id), (city), (date), ())
""")
def _(t: Tables):
    return reports.summary_counts(fx.listing(t))


@query("a02_nested_counts", f"""
WITH {LISTING_SQL} SELECT crawl_id, platform, city, count(*) AS n,
  CASE WHEN grouping(city) = 1 THEN 'by_crawl_platform' ELSE 'by_platform_city' END AS level
FROM fx_listing GROUP BY GROUPING SETS ((crawl_id, platform), (platform, city))
""")
def _(t: Tables):
    return reports.nested_counts(fx.listing(t))


@query("a03_summary_table", f"""
WITH {LISTING_SQL}, {_DEDUP_SQL} SELECT crawl_id, platform, city, count(*) AS restaurant_count FROM unique_rows
GROUP BY ALL ORDER BY ALL
""")
def _(t: Tables):
    rows = resolve.drop_duplicates_first(fx.listing_lines(t), LISTING_ORDER, cells=fx.listing_cells())
    return reports.summary_table(rows)


@query("a04_platform_pivot", f"""
WITH {LISTING_SQL} SELECT crawl_id, count(*) FILTER (WHERE platform = 'A') AS "A",
  count(*) FILTER (WHERE platform = 'N') AS "N", count(*) FILTER (WHERE platform = 'R') AS "R", count(*) AS total
FROM fx_listing GROUP BY ALL
""")
def _(t: Tables):
    return reports.platform_pivot(fx.listing(t), ["A", "N", "R"])


@query("a05_summary_stats", f"""
WITH {LISTING_SQL}, s AS (SELECT crawl_id, platform, city, count(*) AS c FROM fx_listing GROUP BY ALL)
SELECT count(*) AS n_rows, count(DISTINCT crawl_id) AS n_crawls, count(DISTINCT platform) AS n_platforms,
  count(DISTINCT city) AS n_cities, sum(c)::BIGINT AS n_restaurants FROM s
""")
def _(t: Tables):
    return reports.summary_stats(reports.summary_table(fx.listing(t)))


@query("a08_fill_rate", f"""
WITH {LISTING_SQL} SELECT platform, crawl_id, count(*) AS total, count(food_type) AS filled,
  round(count(food_type) * 100.0 / count(*), 4) AS fill_pct,
  CASE WHEN count(food_type) * 100.0 / count(*) > 10 THEN 'OK' ELSE 'LOW' END AS status FROM fx_listing GROUP BY ALL
""")
def _(t: Tables):
    return reports.fill_rate(fx.listing(t), "food_type")


@query("a09_url_presence", f"""
WITH {LISTING_SQL} SELECT platform, round(count(*) FILTER (WHERE restaurant_url <> '') * 100.0 / count(*), 4) AS url_pct
FROM fx_listing GROUP BY ALL
""")
def _(t: Tables):
    return reports.url_presence(fx.listing(t))


_HOST_SQL = """
hosts AS (SELECT platform, CASE l_suppkey % 7 WHEN 0 THEN 'www.a.example' WHEN 1 THEN 'a.example' WHEN 2 THEN 'b.example'
  WHEN 3 THEN 'NO_DOMAIN' ELSE 'c' || CAST(l_suppkey % 7 AS VARCHAR) || '.example' END AS host
  FROM fx_listing WHERE restaurant_url <> '')
"""


@query("a10_host_histogram", f"""
WITH {LISTING_SQL}, {_HOST_SQL}, c AS (SELECT platform, host, count(*) AS n FROM hosts GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY n DESC, host) AS rn FROM c),
f AS (SELECT platform, host, n, rn, host <> 'NO_DOMAIN' AND NOT (platform = 'A' AND host LIKE '%a.example'
  OR platform = 'R' AND host LIKE '%b.example') AS unexpected FROM r)
SELECT * FROM f WHERE rn <= 5 OR unexpected
""")
def _(t: Tables):
    k = F.col("l_suppkey") % 7
    host = (F.when(k == 0, "https://www.a.example/x").when(k == 1, "http://a.example").when(k == 2, "https://b.example/")
            .when(k == 3, "/relative").otherwise(F.concat(F.lit("https://c"), k.cast("string"), F.lit(".example/q"))))
    df = fx.listing(t).withColumn("restaurant_url", F.when(F.col("restaurant_url") != "", host))
    return reports.host_histogram(df, {"A": ("a.example",), "R": ("b.example",)})


@query("a15_issue_histogram", f"""
WITH {LISTING_SQL} SELECT CASE WHEN num_ratings % 3 = 0 THEN 'LONG_NAME' ELSE 'LONG_CITY' END AS category,
  count(*) AS n FROM fx_listing GROUP BY ALL
""")
def _(t: Tables):
    kind = F.when(F.col("num_ratings") % 3 == 0, "LONG_NAME").otherwise("LONG_CITY")
    return reports.issue_histogram(fx.listing(t).select(F.concat(kind, F.lit(": "), "name", F.lit(": x")).alias("issue")))


@query("a16_duplicate_report", f"""
WITH {LISTING_SQL}, {_DEDUP_SQL} SELECT (SELECT count(*) FROM fx_listing) AS rows_before,
  count(*) AS rows_after, (SELECT count(*) FROM fx_listing) - count(*) AS rows_removed FROM unique_rows
""")
def _(t: Tables):
    return resolve.duplicate_report(fx.listing(t))


@query("a18_shared_keys", f"""
WITH {LISTING_SQL}, c AS (SELECT crawl_id, count(*) OVER (PARTITION BY restaurant_url, crawl_id) AS k, restaurant_url
  FROM fx_listing WHERE restaurant_url <> '')
SELECT crawl_id, count(*) AS n_rows, count(DISTINCT restaurant_url) AS n_keys FROM c WHERE k > 1 GROUP BY ALL
""")
def _(t: Tables):
    return quality.shared_key_rows(fx.listing(t))


@query("a19_intra_page_duplicates", f"""
WITH {LISTING_SQL}, p AS (SELECT crawl_id, l_partkey, name FROM fx_listing)
SELECT crawl_id, l_partkey, count(*) AS n_entities, count(*) - count(DISTINCT lower(name)) AS n_repeats,
  count(*) - count(DISTINCT lower(name)) > count(*) * 0.3 AS flagged FROM p GROUP BY ALL
""")
def _(t: Tables):
    return quality.intra_page_duplicates(fx.listing(t), ["crawl_id", "l_partkey"])


# Names and cities with defects, spread by key.
_DIRTY_SQL = """
dirty AS (SELECT CASE l_partkey % 13 WHEN 0 THEN 'Caf&#233; ' || name WHEN 1 THEN 'ab' WHEN 2 THEN repeat(name, 6)
    WHEN 3 THEN '<b>' || name WHEN 4 THEN 'Uber Eats' WHEN 5 THEN repeat('x', 130) ELSE name END AS name,
  CASE l_suppkey % 11 WHEN 1 THEN 'Comida a Domicilio' WHEN 2 THEN 'Restaurants x' WHEN 3 THEN 'M%C3'
    WHEN 4 THEN 'Leon, Spain' WHEN 5 THEN repeat('c', 61) WHEN 6 THEN NULL ELSE city END AS city,
  platform, crawl_id, source_url, restaurant_url FROM fx_listing)
"""
_ON = {"bad_city": "A", "listing_city": "N", "encoded_city": "R"}


def _dirty(t: Tables):
    p, s = F.col("l_partkey") % 13, F.col("l_suppkey") % 11
    name = (F.when(p == 0, F.concat(F.lit("Caf&#233; "), "name")).when(p == 1, "ab").when(p == 2, F.repeat("name", F.lit(6)))
            .when(p == 3, F.concat(F.lit("<b>"), "name")).when(p == 4, "Uber Eats").when(p == 5, "x" * 130)
            .otherwise(F.col("name")))
    city = (F.when(s == 1, "Comida a Domicilio").when(s == 2, "Restaurants x").when(s == 3, "M%C3")
            .when(s == 4, "Leon, Spain").when(s == 5, "c" * 61).when(s == 6, F.lit(None)).otherwise(F.col("city")))
    return fx.listing(t).withColumns({"name": name, "city": city})


_RULES_SQL = """
rules AS (
  SELECT 'HTML_ENTITIES' AS rule, count(*) FILTER (WHERE contains(name, '&#')) AS violations FROM dirty
  UNION ALL SELECT 'SHORT_NAMES', count(*) FILTER (WHERE length(name) <= 2) FROM dirty
  UNION ALL SELECT 'LONG_NAMES', count(*) FILTER (WHERE length(name) > 100) FROM dirty
  UNION ALL SELECT 'HTML_ARTIFACTS', count(*) FILTER (WHERE regexp_matches(name, '[<>{}]')) FROM dirty
  UNION ALL SELECT 'PLATFORM_NAME', count(*) FILTER (WHERE lower(name) IN
    ('glovo', 'just eat', 'uber eats', 'ubereats', 'glovoapp')) FROM dirty
  UNION ALL SELECT 'EMPTY_CITY', count(*) FILTER (WHERE coalesce(city, '') = '') FROM dirty
  UNION ALL SELECT 'BAD_CITIES', count(*) FILTER (WHERE platform = 'A' AND
    regexp_matches(lower(city), 'domicilio|delivery|glovo|banaketa')) FROM dirty
  UNION ALL SELECT 'LISTING_CITY', count(*) FILTER (WHERE platform = 'N' AND city LIKE 'Restaurants%') FROM dirty
  UNION ALL SELECT 'ENCODED_CITY', count(*) FILTER (WHERE platform = 'R' AND contains(city, '%')) FROM dirty
  UNION ALL SELECT 'COUNTRY_SUFFIX', count(*) FILTER (WHERE platform = 'R' AND contains(city, ', Spain')) FROM dirty)
"""


@query("q01_table_rules", f"""
WITH {LISTING_SQL}, {_DIRTY_SQL}, {_RULES_SQL}
SELECT rule, violations, round(violations * 100.0 / (SELECT count(*) FROM dirty), 4) AS pct FROM rules
""")
def _(t: Tables):
    return quality.check_table(_dirty(t), _ON)


@query("q02_row_issues", f"""
WITH {LISTING_SQL}, {_DIRTY_SQL}
SELECT platform, crawl_id, source_url AS subject, name, u.check FROM dirty, unnest(list_filter([
  CASE WHEN length(name) > 120 THEN 'LONG_NAME' END, CASE WHEN regexp_matches(name, '[<>{{}}]') THEN 'HTML_IN_NAME' END,
  CASE WHEN length(city) > 60 THEN 'LONG_CITY' END,
  CASE WHEN lower(name) IN ('glovo', 'just eat', 'uber eats', 'ubereats', 'glovoapp') THEN 'PLATFORM_AS_NAME' END,
  CASE WHEN contains(name, '&#') THEN 'HTML_ENTITY' END], lambda x: x IS NOT NULL)) AS u("check")
""")
def _(t: Tables):
    return quality.row_issues(_dirty(t))


@query("q06_overall", f"""
WITH {LISTING_SQL}, {_DIRTY_SQL}, {_RULES_SQL}
SELECT 'table' AS "check", rule AS subject, violations AS n FROM rules WHERE violations > 0
UNION ALL SELECT 'shared_url', crawl_id, count(*) FROM (SELECT crawl_id, count(*) OVER (
  PARTITION BY restaurant_url, crawl_id) AS k FROM dirty WHERE restaurant_url <> '') WHERE k > 1 GROUP BY crawl_id
""")
def _(t: Tables):
    df = _dirty(t)
    rules = quality.check_table(df, _ON).select(
        F.lit("table").alias("check"), F.col("rule").alias("subject"), F.col("violations").alias("n"))
    shared = quality.shared_key_rows(df).select(
        F.lit("shared_url").alias("check"), F.col("crawl_id").alias("subject"), F.col("n_rows").alias("n"))
    return quality.overall(rules, shared)


_ENTITY_SQL = """
SELECT crawl_id, platform, city, name, restaurant_url, food_type, rating, num_ratings, date, source_url
"""
_ENTITY_COLS = [
    "crawl_id", "platform", "city", "name", "restaurant_url", "food_type", "rating", "num_ratings", "date", "source_url"]


def _stored(t: Tables, label: str, df=None) -> str:
    path = scratch_dir(t.spark, label) + "/entities"
    store.write_entities(fx.listing_entities(t) if df is None else df, path)
    return path


@query("s10_entity_sink", f"""
WITH {LISTING_SQL}, k AS (SELECT * REPLACE (CASE WHEN l_suppkey % 9 = 0 THEN 'unknown' ELSE platform END AS platform)
  FROM fx_listing)
SELECT crawl_id, platform, count(*) AS n, count(DISTINCT name) AS n_names FROM k GROUP BY ALL
""")
def _(t: Tables):
    df = fx.listing_entities(t)
    df = df.withColumn("platform", F.when(F.col("l_suppkey") % 9 != 0, F.col("platform")))
    path = _stored(t, "s10", df)
    return store.read_entities(t.spark, path).groupBy("crawl_id", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("n_names"))


@query("s11_union_scan", f"WITH {LISTING_SQL} {_ENTITY_SQL} FROM fx_listing")
def _(t: Tables):
    return store.read_entities(t.spark, _stored(t, "s11"), merge=True).select(*_ENTITY_COLS)


@query("s12_csv_round_trip", f"""
WITH {LISTING_SQL} SELECT crawl_id, platform, nullif(city, '') AS city, name || ', "x"' AS name,
  nullif(restaurant_url, '') AS restaurant_url, food_type, rating, num_ratings, date, source_url, 'a|b,c' AS categories
FROM fx_listing
""")
def _(t: Tables):
    path = scratch_dir(t.spark, "s12") + "/csv"
    df = fx.listing_entities(t).withColumns({
        "name": F.concat("name", F.lit(', "x"')), "categories": F.array(F.lit("a"), F.lit("b,c"))})
    store.write_csv(df, path)
    return store.read_csv(t.spark, path).withColumn("categories", F.array_join("categories", "|")).select(
        *_ENTITY_COLS, "categories")


_S13_ROWS = """
s13 AS (SELECT platform, crawl_id, CASE WHEN num_ratings % 7 = 0 THEN NULL ELSE city END AS city, date FROM fx_listing)
"""


def _s13(t: Tables):
    return fx.listing(t).withColumn("city", F.when(F.col("num_ratings") % 7 != 0, F.col("city")))


@query("s13_summary_json", f"""
WITH {LISTING_SQL}, {_S13_ROWS}
SELECT 'by_platform' AS level, platform AS key, count(*) AS n FROM s13 GROUP BY platform
UNION ALL SELECT 'by_crawl', crawl_id, count(*) FROM s13 GROUP BY crawl_id
UNION ALL SELECT 'by_city', city, count(*) FROM s13 GROUP BY city
UNION ALL SELECT 'by_date', date, count(*) FROM s13 GROUP BY date
UNION ALL SELECT 'total', 'all', count(*) FROM s13
""")
def _(t: Tables):
    path = scratch_dir(t.spark, "s13") + "/summary"
    store.write_summary_lines(reports.summary_counts(_s13(t)), path)
    return store.read_summary_lines(t.spark, path)


@query("s13_nested_summary_json", f"""
WITH {LISTING_SQL}, {_S13_ROWS}
SELECT 'by_crawl_platform' AS level, crawl_id AS first, platform AS second, count(*) AS n FROM s13 GROUP BY ALL
UNION ALL SELECT 'by_platform_city', platform, city, count(*) FROM s13 GROUP BY ALL
""")
def _(t: Tables):
    path = scratch_dir(t.spark, "s13") + "/nested"
    store.write_nested_summary_lines(reports.nested_counts(_s13(t)), path)
    return store.read_nested_summary_lines(t.spark, path)


@query("s14_summary_sink", f"""
WITH {LISTING_SQL} SELECT crawl_id, platform, nullif(city, '') AS city, count(*) AS restaurant_count
FROM fx_listing GROUP BY ALL
""")
def _(t: Tables):
    path = scratch_dir(t.spark, "s14")
    store.write_summary(reports.summary_table(fx.listing(t)), path)
    return t.spark.read.schema("crawl_id string, platform string, city string, restaurant_count bigint").option(
        "header", "true").csv(f"{path}/csv")


def _published(t: Tables, label: str) -> str:
    path, df = scratch_dir(t.spark, label) + "/entities", fx.listing_entities(t)
    store.publish_entities(df, path, df.select("crawl_id", "platform").distinct())
    return path


def _reloaded(t: Tables, label: str) -> tuple[str, DataFrame]:
    """All slices, and then one crawl again with fewer rows and none at all on one platform."""
    path = _published(t, label)
    fresh = fx.listing_entities(t).where((F.col("num_ratings") > 25) & (F.col("platform") != "A"))
    return path, store.load_crawls(t.spark, fresh, ["CC-MAIN-1998"], path)


_RELOADED_SQL = f"""
WITH {LISTING_SQL}, u AS (SELECT * FROM fx_listing
  WHERE crawl_id <> 'CC-MAIN-1998' OR (num_ratings > 25 AND platform <> 'A'))
"""


@query("s15_incremental_load", f"""
{_RELOADED_SQL} SELECT crawl_id, platform, city, count(*) AS restaurant_count FROM u GROUP BY ALL
""")
def _(t: Tables):
    return _reloaded(t, "s15")[1]


@query("s15_published_rows", f"""
{_RELOADED_SQL} SELECT crawl_id, platform, count(*) AS n, count(DISTINCT name) AS n_names FROM u GROUP BY ALL
""")
def _(t: Tables):
    path, _ = _reloaded(t, "s15r")
    return store.read_published(t.spark, path).groupBy("crawl_id", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("n_names"))


@query("a01_counts_of_slices", f"""
{_RELOADED_SQL} SELECT CASE WHEN grouping(platform) = 0 THEN 'by_platform' WHEN grouping(crawl_id) = 0 THEN 'by_crawl'
  WHEN grouping(city) = 0 THEN 'by_city' WHEN grouping(date) = 0 THEN 'by_date' ELSE 'total' END AS level,
  platform, crawl_id, city, date, count(*) AS n
FROM u GROUP BY GROUPING SETS ((platform), (crawl_id), (city), (date), ())
""")
def _(t: Tables):
    path, _ = _reloaded(t, "a01s")
    return reports.summary_counts_of(store.published_counts(t.spark, path))


@query("a02_nested_counts_of_slices", f"""
{_RELOADED_SQL} SELECT CASE WHEN grouping(city) = 1 THEN 'by_crawl_platform' ELSE 'by_platform_city' END AS level,
  crawl_id, platform, city, count(*) AS n
FROM u GROUP BY GROUPING SETS ((crawl_id, platform), (platform, city))
""")
def _(t: Tables):
    path, _ = _reloaded(t, "a02s")
    return reports.nested_counts_of(store.published_counts(t.spark, path))


# Every estimate must lie within its stated error of the exact number, whatever the scale.
@query("a07_distinct_rollup", f"""
{_RELOADED_SQL}, d AS (SELECT CASE WHEN grouping(platform) = 0 AND grouping(crawl_id) = 0 THEN 'by_crawl_platform'
  WHEN grouping(crawl_id) = 0 THEN 'by_crawl' WHEN grouping(platform) = 0 THEN 'by_platform' ELSE 'total' END AS level,
  crawl_id, platform, count(DISTINCT nullif(restaurant_url, '')) AS n
  FROM u GROUP BY GROUPING SETS ((crawl_id, platform), (crawl_id), (platform), ()))
SELECT level, crawl_id, platform, CASE WHEN level = 'by_crawl_platform' AND crawl_id = 'CC-MAIN-1998' THEN n END AS exact,
  true AS within FROM d
""")
def _(t: Tables):
    path, _ = _reloaded(t, "a07s")
    wanted = F.col("crawl_id") == "CC-MAIN-1998"
    rollup = reports.with_exact(
        reports.distinct_rollup(store.published_sketches(t.spark, path)), store.read_published(t.spark, path, only=wanted), wanted)
    # The truth for each row of the roll-up, to hold the stated bounds against.
    sets = [["crawl_id", "platform"], ["crawl_id"], ["platform"], []]
    known = store.read_published(t.spark, path).withColumn("u", F.nullif("restaurant_url", F.lit("")))
    truth = known.groupingSets([[F.col(c) for c in s] for s in sets], "crawl_id", "platform").agg(
        F.countDistinct("u").alias("truth"))
    same = rollup["crawl_id"].eqNullSafe(truth["crawl_id"]) & rollup["platform"].eqNullSafe(truth["platform"])
    return rollup.join(truth, same).select(
        "level", rollup["crawl_id"], rollup["platform"], "exact", F.col("truth").between(F.col("low"), F.col("high")).alias("within"))


@query("c19_category_text", f"""
WITH {LISTING_SQL} SELECT l_orderkey, l_linenumber, coalesce(food_type, '') || '|x' AS pipe FROM fx_listing
""")
def _(t: Tables):
    from gleaner.functions.text import list_to_pipe, pipe_to_list

    pipe = list_to_pipe(F.array(F.coalesce("food_type", F.lit("")), F.lit("x")))
    return fx.listing(t).select("l_orderkey", "l_linenumber", list_to_pipe(pipe_to_list(pipe)).alias("pipe"))


@query("c31_comparison_key", f"""
WITH {LISTING_SQL} SELECT l_orderkey, l_linenumber, trim(lower(name)) AS k, coalesce(lower(food_type), '') AS f
FROM fx_listing
""")
def _(t: Tables):
    from gleaner.functions.text import comparison_key

    return fx.listing(t).select(
        "l_orderkey", "l_linenumber", comparison_key(F.concat(F.lit(" "), "name", F.lit("  "))).alias("k"),
        comparison_key(F.col("food_type"), trim=False).alias("f"))


# A few keys hold a third of all rows, the others are a long tail.
_HEAVY_SQL = f"""
WITH {LISTING_SQL}, h AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN CASE WHEN l_suppkey % 7 > 0 THEN 'hot ' || (l_suppkey % 7) END
    ELSE source_url || '#' || l_linenumber END AS k, source_url FROM fx_listing)
"""


def _heavy(t: Tables) -> DataFrame:
    hot = F.when(F.col("l_suppkey") % 7 > 0, F.concat(F.lit("hot "), (F.col("l_suppkey") % 7).cast("string")))
    tail = F.concat("source_url", F.lit("#"), F.col("l_linenumber").cast("string"))
    return fx.listing(t).select(F.when(F.col("l_partkey") % 3 == 0, hot).otherwise(tail).alias("k"), "source_url")


@query("w04_two_pass_top", f"""
{_HEAVY_SQL} SELECT k, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, k NULLS FIRST) AS INTEGER) AS rn,
  'candidates' AS method FROM h GROUP BY k QUALIFY rn <= 7
""")
def _(t: Tables):
    top = heavy.top_keys(_heavy(t), "k", 7, capacity=200)
    return top.rows.withColumn("method", F.lit(top.proof["method"]))


@query("w04_two_pass_tail", f"""
{_HEAVY_SQL} SELECT source_url, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, source_url) AS INTEGER) AS rn,
  'full' AS method FROM h GROUP BY source_url QUALIFY rn <= 10
""")
def _(t: Tables):
    # All keys are rare here, so no bounded summary can tell them apart and all are counted.
    top = heavy.top_keys(_heavy(t), "source_url", 10, capacity=20)
    return top.rows.withColumn("method", F.lit(top.proof["method"]))
