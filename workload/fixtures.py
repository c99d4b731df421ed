"""Views that give the test tables the shapes the operators expect, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import urls
from gleaner.profiles import SourceProfile
from gleaner.schema import ENTITY_COLUMNS, entity_struct
from workload.registry import Tables

# One profile per language segment of the page URLs.
LANGUAGES = (
    SourceProfile(
        key="en", name="English", domain="example.com", base_url="https://example.com", path_like="/en/%",
        listing_patterns=(r"/en/\d+/?$", r"/en/\d+\?page="), detail_patterns=(r"/en/\d+\.html$",),
        url_hosts=("example.com",)),
    SourceProfile(
        key="de", name="German", domain="example.org", base_url="https://example.org", path_like="/de/%",
        listing_patterns=(r"/de/\d+\?",), detail_patterns=(r"/de/\d+",), url_hosts=("example.org",)),
    SourceProfile(
        key="es", name="Spanish", domain="example.net", base_url="https://example.net", path_like="/es/%",
        listing_patterns=(r"/es/\d+/$",), url_hosts=("example.net",)),
    SourceProfile(
        key="fr", name="French", domain="example.com", base_url="https://example.com", path_like="/fr/%",
        listing_patterns=(r"/fr/\d{3}",), detail_patterns=(r"/fr/\d{1,2}\D",), url_hosts=("example.com",)),
)

INDEX_SQL = """
fx_index AS (
  SELECT page_id, url, TIMESTAMP '2022-01-01 00:00:00' + to_hours(page_id) AS fetch_time,
    CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS fetch_status,
    CASE WHEN page_id % 7 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_mime_detected,
    'crawl-data/' || CAST(page_id % 13 AS VARCHAR) || '.warc.gz' AS warc_filename,
    page_id * 1000 AS warc_record_offset, length(html) AS warc_record_length,
    regexp_extract(url, '^[a-z]+://(?:[^/?#]*[.])?([^/?#.]+[.][^/?#.]+)', 1) AS url_host_registered_domain,
    regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS url_host_name,
    regexp_extract(url, '^([a-z]+)://', 1) AS url_protocol,
    regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) AS url_path,
    'CC-MAIN-202' || CAST(2 + page_id % 3 AS VARCHAR) || '-05' AS crawl,
    CASE WHEN page_id % 11 = 0 THEN 'robotstxt' ELSE 'warc' END AS subset,
    regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS lang
  FROM pages)
"""


def index(t: Tables) -> DataFrame:
    """A crawl index over the pages."""
    pid, url = F.col("page_id"), F.col("url")
    return t.pages.select(
        "page_id", "url",
        F.timestamp_seconds(F.lit(1640995200) + pid * 3600).alias("fetch_time"),
        F.when(pid % 10 == 0, 404).otherwise(200).alias("fetch_status"),
        F.when(pid % 7 == 0, "application/pdf").otherwise("text/html").alias("content_mime_detected"),
        F.concat(F.lit("crawl-data/"), (pid % 13).cast("string"), F.lit(".warc.gz")).alias("warc_filename"),
        (pid * 1000).alias("warc_record_offset"), F.length("html").cast("bigint").alias("warc_record_length"),
        urls.registered_domain(url).alias("url_host_registered_domain"), urls.host(url).alias("url_host_name"),
        urls.scheme(url).alias("url_protocol"), urls.path(url).alias("url_path"),
        F.concat(F.lit("CC-MAIN-202"), (2 + pid % 3).cast("string"), F.lit("-05")).alias("crawl"),
        F.when(pid % 11 == 0, "robotstxt").otherwise("warc").alias("subset"),
        F.regexp_extract(url, "^[a-z]+://[^/]+/([a-z]+)/", 1).alias("lang"))


# The scan predicate of all language profiles in SQL.
SCOPE_SQL = """
  subset = 'warc' AND url_protocol = 'https' AND fetch_status = 200 AND content_mime_detected = 'text/html'
  AND ((url_host_registered_domain = 'example.com' AND url_path LIKE '/en/%')
    OR (url_host_registered_domain = 'example.org' AND url_path LIKE '/de/%')
    OR (url_host_registered_domain = 'example.net' AND url_path LIKE '/es/%')
    OR (url_host_registered_domain = 'example.com' AND url_path LIKE '/fr/%'))
"""

LISTING_SQL = """
fx_listing AS (
  SELECT 'CC-MAIN-' || CAST(year(l_shipdate) AS VARCHAR) AS crawl_id, l_returnflag AS platform,
    CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE n_name END AS city,
    CASE WHEN l_linenumber % 2 = 1 THEN upper(s_name) ELSE s_name END AS name,
    CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 5 = 0 THEN ''
         ELSE 'https://x.example/s/' || CAST(l_suppkey AS VARCHAR) END AS restaurant_url,
    CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE p_type END AS food_type,
    round(l_discount * 50, 2) AS rating, CAST(round(l_quantity) AS BIGINT) AS num_ratings,
    strftime(l_shipdate, '%Y-%m-%d') AS date,
    'https://x.example/o/' || CAST(l_orderkey AS VARCHAR) AS source_url,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)
"""
# A total order over the listing rows: the first two columns alone are not unique.
LISTING_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
LISTING_ORDER_SQL = ", ".join(LISTING_ORDER)


def listing_lines(t: Tables) -> DataFrame:
    """Order lines with their part, supplier and nation. The many lines meet the parts first, while they are slim."""
    lines = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    makers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return lines.join(makers, F.col("l_suppkey") == F.col("s_suppkey"))


def listing_cells() -> dict[str, Column]:
    """The cells of an entity, made from an order line."""
    line, supp = F.col("l_linenumber"), F.col("l_suppkey")
    return {
        "crawl_id": F.concat(F.lit("CC-MAIN-"), F.year("l_shipdate").cast("string")),
        "platform": F.col("l_returnflag"),
        "city": F.when(supp % 10 == 0, "").otherwise(F.col("n_name")),
        "name": F.when(line % 2 == 1, F.upper("s_name")).otherwise(F.col("s_name")),
        "restaurant_url": F.when(line % 3 == 0, F.lit(None)).when(line % 5 == 0, "").otherwise(
            F.concat(F.lit("https://x.example/s/"), supp.cast("string"))),
        "food_type": F.when(F.col("l_partkey") % 4 != 0, F.col("p_type")),
        "rating": F.round(F.col("l_discount") * 50, 2),
        "num_ratings": F.round("l_quantity").cast("bigint"),
        "date": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "source_url": F.concat(F.lit("https://x.example/o/"), F.col("l_orderkey").cast("string"))}


def listing(t: Tables) -> DataFrame:
    """Entity rows with many duplicates, one per order line."""
    return listing_lines(t).select(*[c.alias(name) for name, c in listing_cells().items()], *LISTING_ORDER)


def listing_entities(t: Tables) -> DataFrame:
    """The listing rows with all entity columns, next to the order columns."""
    have = set(ENTITY_COLUMNS)
    df = listing(t)
    row = entity_struct(**{c: F.col(c) for c in df.columns if c in have})
    return df.select(row.alias("_e"), *LISTING_ORDER).select("_e.*", *LISTING_ORDER)


# Customers in blocks of this many per page, so that pages grow in number and not in size.
BLOCK = 16
CUSTOMER_SQL = """
fx_customer AS (
  SELECT c_custkey, c_custkey // 16 AS page_id, c_name, n_name, c_mktsegment, c_acctbal, c_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def customers(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "page_id", F.floor(F.col("c_custkey") / BLOCK)).select(
        "c_custkey", "page_id", "c_name", "n_name", "c_mktsegment", "c_acctbal", "c_nationkey")


def block_pages(rows: DataFrame, *texts: Column) -> DataFrame:
    """One row per block: the texts of its customers joined in key order. A block has at most 16 rows."""
    item = F.struct("c_custkey", *[x.alias(f"t{i}") for i, x in enumerate(texts)])
    # A fixed number of partitions keeps small runs parallel; pages are much work for few bytes.
    context = rows.sparkSession.sparkContext
    parts = max(context.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = rows.repartition(parts, "page_id").groupBy("page_id").agg(F.array_sort(F.collect_list(item)).alias("_b"))
    return df.select("page_id", *[F.array_join(f"_b.t{i}", ",").alias(f"t{i}") for i in range(len(texts))])


def page_rows(blocks: DataFrame, html: Column, platform: str, url: Column) -> DataFrame:
    """Page rows around the HTML of a block."""
    return blocks.select(
        "page_id", url.alias("url"), F.lit("20230105120000").alias("timestamp"), F.lit(200).alias("status"),
        F.lit("text/html").alias("mime_type"), F.lit("CC-MAIN-2023-06").alias("crawl_id"),
        F.lit(platform).alias("platform"), html.alias("html"))


def area_url() -> Column:
    return F.concat(F.lit("https://www.just-eat.es/area/"), F.col("page_id").cast("string"), F.lit("-san-juan"))


def city_url() -> Column:
    return F.concat(F.lit("https://www.ubereats.com/es/city/"), F.col("page_id").cast("string"), F.lit("-x-es-md"))


def linked_item() -> Column:
    """JSON-LD of one customer; the value types vary from row to row."""
    key = F.col("c_custkey")
    kind = F.when(key % 5 == 0, "Organization").otherwise("Restaurant").alias("@type")
    rating = F.struct(
        F.format_string("%.1f", key % 40 / 10 + 1).alias("ratingValue"),
        (key + 1).alias("ratingCount")).alias("aggregateRating")
    geo = F.struct((key / 4).alias("latitude"), (key / 8).alias("longitude")).alias("geo")
    url = F.concat(F.lit("https://x.example/"), key.cast("string")).alias("url")
    name = F.concat(F.lit("  "), F.col("c_name"), F.lit(" &amp; Sons")).alias("name")
    nested = F.struct(
        F.col("c_mktsegment").alias("streetAddress"), F.col("n_name").alias("addressLocality"),
        F.lit("").alias("postalCode")).alias("address")
    flat = F.concat(F.col("c_mktsegment"), F.lit("  st.")).alias("address")
    one = F.to_json(F.struct(kind, name, nested, rating, geo, url, F.col("c_mktsegment").alias("servesCuisine")))
    many = F.to_json(F.struct(
        kind, name, flat, rating, geo, url, F.array("c_mktsegment", F.lit("Other")).alias("servesCuisine")))
    return F.when(key % 2 == 0, many).otherwise(one)


def linked_pages(t: Tables) -> DataFrame:
    """Pages with JSON-LD in four shapes: array, item list, search page, and one script per object."""
    wrapped = F.concat(F.lit('{"@type":"ListItem","item":'), linked_item(), F.lit("}"))
    script = F.concat(F.lit('<script type="application/ld+json">'), linked_item(), F.lit("</script>"))
    b = block_pages(customers(t), linked_item(), wrapped, script)
    items = F.concat(F.lit('{"@type":"ItemList","itemListElement":['), F.col("t1"), F.lit("]}"))
    body = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("["), F.col("t0"), F.lit("]")))
        .when(F.col("page_id") % 4 == 1, items)
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit('{"@type":"SearchResultsPage","mainEntity":'), items, F.lit("}"))))
    one = F.concat(F.lit("<script type='application/ld+json'>"), body, F.lit("</script>"))
    html = F.concat(
        F.lit('<html><head><!-- <script type="application/ld+json">[{"@type":"Restaurant","name":"no"}]</script> -->'),
        F.coalesce(one, F.col("t2")), F.lit('<script type="application/ld+json">{broken</script></head></html>'))
    return page_rows(b, html, "justeat", area_url())


LINKED_SQL = f"""
WITH {CUSTOMER_SQL},
rows AS (
  SELECT page_id, c_custkey, c_name || ' & Sons' AS name,
    CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' st.' ELSE c_mktsegment || ', ' || n_name END AS address,
    CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE n_name END AS neighborhood,
    c_mktsegment AS food_type,
    CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || '|Other' ELSE c_mktsegment END AS categories,
    round(c_custkey % 40 / 10 + 1, 1) AS rating, c_custkey + 1 AS num_ratings,
    c_custkey / 4 AS latitude, c_custkey / 8 AS longitude,
    'https://x.example/' || CAST(c_custkey AS VARCHAR) AS restaurant_url
  FROM fx_customer WHERE c_custkey % 5 <> 0)
"""


def js_text(json: Column) -> Column:
    """JSON as the inside of a JavaScript string literal, inner quotes escaped."""
    return F.replace(F.replace(json, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit("\\u0022"))


def keyed_pages(t: Tables) -> DataFrame:
    """Pages with a state of five maps that share the customer key; every sixth page is cut off."""
    key = F.col("c_custkey").cast("string")

    def entry(value: Column) -> Column:
        return F.concat(F.lit('"'), key, F.lit('":'), value)

    accent = F.when(F.col("c_custkey") % 2 == 0, F.lit(" é")).otherwise(F.lit(" e"))
    info = F.to_json(F.struct(
        F.concat("c_name", accent).alias("name"), F.concat(F.lit("u"), key).alias("uniqueName"),
        F.col("n_name").alias("address"), (F.col("c_custkey") % 3 == 0).alias("isNew")))
    tags = F.to_json(F.array("c_mktsegment", F.lit(""), F.lit("Other")))
    rating = F.to_json(F.struct((F.col("c_custkey") % 6).alias("starRating"), F.col("c_custkey").alias("ratingCount")))
    fee = F.to_json(F.struct(
        (F.col("c_custkey") % 20).alias("minimumOrderValue"),
        F.array(F.struct((F.col("c_custkey") % 4 + 0.5).alias("fee"))).alias("bands")))
    eta = F.to_json(F.struct(
        (F.col("c_custkey") % 10).alias("deliveryEtaLowerRange"),
        (F.col("c_custkey") % 10 + 15).alias("deliveryEtaUpperRange")))
    b = block_pages(customers(t), *[entry(x) for x in (info, tags, rating, fee, eta)])
    parts = ["restaurants", "restaurantCuisines", "ratings", "deliveryFees", "etas"]
    state = F.concat(F.lit("{"), F.concat_ws(",", *[
        F.concat(F.lit(f'"{p}":{{'), F.col(f"t{i}"), F.lit("}")) for i, p in enumerate(parts)]), F.lit("}"))
    end = F.when(F.col("page_id") % 6 == 0, "").otherwise('");</script><script>var a = "x") + 1</script>')
    html = F.concat(
        F.lit('<html><script>window["__INITIAL_STATE__"] = JSON.parse("'), js_text(state), end, F.lit("</html>"))
    return page_rows(b, html, "justeat", area_url())


KEYED_SQL = f"""
WITH {CUSTOMER_SQL},
rows AS (
  SELECT page_id, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' é' ELSE ' e' END AS name, n_name AS address,
    c_mktsegment AS food_type, c_mktsegment || '|Other' AS categories,
    CAST(nullif(c_custkey % 6, 0) AS DOUBLE) AS rating, nullif(c_custkey, 0) AS num_ratings,
    CAST(c_custkey % 4 AS VARCHAR) || '.5' AS delivery_fee, CAST(c_custkey % 20 AS VARCHAR) AS min_order,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 10 AS VARCHAR) || '-' ||
      CAST(c_custkey % 10 + 15 AS VARCHAR) || ' min' END AS delivery_time,
    c_custkey % 3 = 0 AS is_new,
    'https://www.just-eat.es/restaurants-u' || CAST(c_custkey AS VARCHAR) AS restaurant_url
  FROM fx_customer WHERE page_id % 6 <> 0)
"""


def tree_pages(t: Tables) -> DataFrame:
    """Pages whose state is a map of customers at a fixed path in a script with an id."""
    key = F.col("c_custkey")
    one = F.to_json(F.struct(
        F.col("c_name").alias("name"), F.concat(F.lit("u"), key.cast("string")).alias("uniqueName"),
        F.array(F.struct(F.col("c_mktsegment").alias("name"))).alias("cuisines"),
        F.struct(
            F.when(key % 2 == 0, "").otherwise(F.col("n_name")).alias("city"), F.lit("first  line").alias("firstLine"),
            F.struct(F.array(key / 8, key / 4).alias("coordinates")).alias("location")).alias("address"),
        F.struct((key % 6).alias("starRating"), key.alias("count")).alias("rating"),
        (key % 4).alias("deliveryCost"), (key % 20).alias("minimumDeliveryValue"),
        F.struct((key % 10 + 1).alias("rangeLower"), F.when(key % 2 == 0, key % 10 + 9).alias("rangeUpper")).alias(
            "deliveryEtaMinutes"), (key % 3 == 0).alias("isNew")))
    b = block_pages(customers(t), F.concat(F.lit('"'), key.cast("string"), F.lit('":'), one))
    html = F.concat(
        F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"appProps":{"preloadedState":'
              '{"discovery":{"restaurantList":{"restaurantData":{'),
        F.col("t0"), F.lit("}}}}}}}</script></html>"))
    return page_rows(b, html, "justeat", area_url())


TREE_SQL = f"""
WITH {CUSTOMER_SQL}
SELECT page_id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'San Juan' ELSE n_name END AS city,
  'first line' AS address, c_mktsegment AS food_type, CAST(c_custkey % 6 AS DOUBLE) AS rating,
  c_custkey AS num_ratings, CAST(c_custkey % 4 AS VARCHAR) AS delivery_fee,
  CAST(c_custkey % 20 AS VARCHAR) AS min_order,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 10 + 1 AS VARCHAR) || '-' || CAST(c_custkey % 10 + 9 AS VARCHAR)
       ELSE CAST(c_custkey % 10 + 1 AS VARCHAR) END || ' min' AS delivery_time,
  c_custkey % 3 = 0 AS is_new, c_custkey / 4 AS latitude, c_custkey / 8 AS longitude
FROM fx_customer
"""


def script_pages(t: Tables) -> DataFrame:
    """Pages with state found by pattern: flat objects on even pages, a nested array (skipped) on odd ones."""
    key = F.col("c_custkey")
    name = F.concat("c_name", F.lit(" &#38; Co"))
    title = F.to_json(F.struct(
        name.alias("title"), F.struct((key % 6).alias("ratingValue"), key.alias("ratingCount")).alias("rating"),
        F.struct((key % 10).alias("min"), (key % 10 + 9).alias("max")).alias("etaRange"),
        F.col("n_name").alias("address"), (key % 3 == 0).alias("isPromoted"), F.lit("$$").alias("priceBucket"),
        F.concat(F.lit("/s/"), key.cast("string")).alias("slug")))
    store = F.to_json(F.struct(F.struct(
        name.alias("name"), (key % 6 + 0.5).alias("rating"), F.lit("15 min").alias("deliveryTime"),
        F.struct(F.col("n_name").alias("address"), (key / 4).alias("latitude")).alias("location"),
        F.lit("$").alias("priceRange")).alias("store")))
    b = block_pages(customers(t), F.when(key % 2 == 0, title).otherwise(store))
    even = F.concat(F.lit('<html><script>var s = {"stores": ['), F.col("t0"), F.lit('], "n": [1]};</script>'))
    odd = F.concat(F.lit('<html><script>var s = {"stores": [{"tags": ["a"], "x": '), F.lit("1}, "), F.col("t0"),
                   F.lit("]};</script>"))
    return page_rows(b, F.when(F.col("page_id") % 2 == 0, even).otherwise(odd), "ubereats", city_url())


SCRIPT_SQL = f"""
WITH {CUSTOMER_SQL}
SELECT page_id, c_name || ' & Co' AS name, n_name AS address,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(nullif(c_custkey % 6, 0) AS DOUBLE) ELSE c_custkey % 6 + 0.5 END AS rating,
  CASE WHEN c_custkey % 2 = 0 THEN nullif(c_custkey, 0) END AS num_ratings,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 10 AS VARCHAR) || '-' || CAST(c_custkey % 10 + 9 AS VARCHAR)
    ELSE '15' END || ' min' AS delivery_time,
  c_custkey % 2 = 0 AND c_custkey % 3 = 0 AS is_promoted,
  CASE WHEN c_custkey % 2 = 0 THEN '$$' ELSE '$' END AS price_range,
  CASE WHEN c_custkey % 2 = 1 THEN c_custkey / 4 END AS latitude,
  CASE WHEN c_custkey % 2 = 0 THEN '/s/' || CAST(c_custkey AS VARCHAR) END AS restaurant_url
FROM fx_customer WHERE page_id % 2 = 0
"""


def card_html() -> Column:
    """One card; rating text, link, image and categories vary from row to row. Names repeat within a page."""
    key = F.col("c_custkey")
    name = F.when(key % 7 == 6, F.lit("Repeated")).otherwise(F.col("c_name"))
    rating = F.when(key % 3 == 0, "81%").when(key % 3 == 1, "4,4").otherwise("no rating yet")
    link = F.when(key % 2 == 0, F.concat(F.lit('<a href="/r/'), key.cast("string"), F.lit('">go</a>'))).otherwise(
        F.concat(F.lit("<a href='https://x.example/r/"), key.cast("string"), F.lit("'>go</a>")))
    cuisine = F.when(key % 2 == 0, F.concat(F.lit("<span>i</span>"), "c_mktsegment")).otherwise(
        F.concat(F.lit("<span>"), "c_mktsegment", F.lit(", Other</span>")))
    return F.concat(
        F.lit('<div data-qa="restaurant-card"><h3 data-qa="restaurant-name"> '), name, F.lit(" &eacute;\n</h3>"
        '<p data-qa="rating"><b>'), rating, F.lit('</b></p><i class="rating-count">(1.'), (key % 10).cast("string"),
        F.lit('k)</i><br><span class="deliveryTime">20 - 30 min</span><div data-qa="restaurant-cuisine">'),
        cuisine, F.lit("</div>"), link, F.lit('<img data-x="1" src="/i/'), key.cast("string"), F.lit('.png"></div>'))


def card_pages(t: Tables) -> DataFrame:
    b = block_pages(customers(t), card_html())
    html = F.concat(F.lit("<html><body><div class='list'>"), F.col("t0"), F.lit("</div></body></html>"))
    return page_rows(b, html, "justeat", area_url())


CARD_SQL = f"""
WITH {CUSTOMER_SQL},
named AS (
  SELECT *, CASE WHEN c_custkey % 7 = 6 THEN 'Repeated' ELSE c_name END || ' é' AS name FROM fx_customer),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, lower(name) ORDER BY c_custkey) AS rn FROM named),
rows AS (
  SELECT page_id, c_custkey, name,
    CASE WHEN c_custkey % 3 = 0 THEN 81.0 WHEN c_custkey % 3 = 1 THEN 4.4 END AS rating,
    CASE WHEN c_custkey % 10 = 0 THEN 1000 ELSE 1000 + 100 * (c_custkey % 10) END AS num_ratings,
    '20 - 30 min' AS delivery_time,
    c_mktsegment AS food_type,
    CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_mktsegment || '|Other' END AS categories,
    CASE WHEN c_custkey % 2 = 0 THEN 'https://www.just-eat.es/r/' ELSE 'https://x.example/r/' END
      || CAST(c_custkey AS VARCHAR) AS restaurant_url,
    '/i/' || CAST(c_custkey AS VARCHAR) || '.png' AS image_url
  FROM firsts WHERE rn = 1)
"""
