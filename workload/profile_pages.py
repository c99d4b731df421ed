"""Pages of every kind for every built-in source, built from customers, and the rows they must give in SQL.

``KINDS`` names all kinds of pages with their source; each kind has a crawl of its own, so that entities of one kind do
not stand for those of another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.resolve import bag_union
from gleaner.session import scratch_dir
from gleaner.sources import page_store
from workload import fixtures as fx
from workload.fixtures import CUSTOMER_SQL
from workload.registry import Tables



def _key() -> Column:
    return F.col("c_custkey")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def glovo_url() -> Column:
    """Even pages have a category in their address, odd ones have none; the city ends in digits, which go."""
    place = _text("https://glovoapp.com/es/es/la-villa-", F.col("page_id").cast("string"), "/restaurantes_1/")
    return F.when(F.col("page_id") % 2 == 0, _text(place, "pizza-y-mas_34835/")).otherwise(place)


def uber_store_url() -> Column:
    """Even pages have a city in their address."""
    number = F.col("page_id").cast("string")
    return F.when(F.col("page_id") % 2 == 0, fx.city_url()).otherwise(
        _text("https://www.ubereats.com/es/brand-city/", number, "-x"))


def _linked(t: Tables, item: Column, platform: str, url: Column) -> DataFrame:
    """JSON-LD as an array, an item list, a search page (which these sources do not read) and single objects."""
    b = fx.block_pages(
        fx.customers(t), item, _text('{"@type":"ListItem","item":', item, "}"),
        _text('<script type="application/ld+json">', item, "</script>"))
    items = _text('{"@type":"ItemList","itemListElement":[', F.col("t1"), "]}")
    kind = F.col("page_id") % 4
    body = (F.when(kind == 0, _text("[", F.col("t0"), "]")).when(kind == 1, items)
            .when(kind == 2, _text('{"@type":"SearchResultsPage","mainEntity":', items, "}")))
    one = F.coalesce(_text("<script type='application/ld+json'>", body, "</script>"), F.col("t2"))
    return fx.page_rows(b, _text("<html><head>", one, "</head><body><p>no cards</p></body></html>"), platform, url)


def _glovo_item() -> Column:
    key = _key()
    kind = F.when(key % 5 == 0, "WebSite").when(key % 5 == 1, "Store").otherwise("Restaurant").alias("@type")
    rating = F.struct(
        _text((key % 21 * 5).cast("string"), "%").alias("ratingValue"),
        _text("1,", F.lpad((key % 1000).cast("string"), 3, "0")).alias("reviewCount")).alias("aggregateRating")
    address = F.struct(F.col("c_mktsegment").alias("streetAddress"), F.col("n_name").alias("addressLocality"),
                       F.lit("0" * 5).alias("postalCode")).alias("address")
    name = F.when(key % 13 == 2, "GlovoApp").otherwise(F.col("c_name")).alias("name")
    return F.to_json(F.struct(
        kind, name, address, rating, F.struct((key / 4).alias("latitude"), (key / 8).alias("longitude")).alias("geo"),
        _text("https://x.example/g/", key.cast("string")).alias("url"), F.lit("€€").alias("priceRange"),
        F.array("c_mktsegment", F.lit("Other")).alias("servesCuisine")))


def glovo_linked_pages(t: Tables) -> DataFrame:
    return _linked(t, _glovo_item(), "glovo", glovo_url())


GLOVO_LINKED_SQL = """
SELECT page_id, c_custkey, c_name AS name, 'La Villa' AS city, c_mktsegment || ', ' || n_name || ', 00000' AS address, c_mktsegment AS food_type,
  c_mktsegment || '|Other' AS categories, nullif((c_custkey % 21 * 5) / 20.0, 0)::DOUBLE AS rating,
  1000 + c_custkey % 1000 AS num_ratings, '€€' AS price_range, c_custkey / 4 AS latitude, c_custkey / 8 AS longitude,
  'https://x.example/g/' || CAST(c_custkey AS VARCHAR) AS restaurant_url
FROM fx_customer WHERE c_custkey % 5 <> 0 AND c_custkey % 13 <> 2 AND page_id % 4 <> 2
"""


def _uber_item() -> Column:
    key = _key()
    kind = F.when(key % 5 == 0, "Store").when(key % 5 == 1, "FoodService").otherwise("Restaurant").alias("@type")
    rating = F.struct((key % 50 / 10).alias("ratingValue"), key.alias("ratingCount")).alias("aggregateRating")
    nested = F.struct(F.col("c_mktsegment").alias("streetAddress"), _text(F.col("n_name"), ", Spain").alias("addressLocality")).alias("address")
    rest = [kind, F.col("c_name").alias("name"), rating, F.col("c_mktsegment").alias("servesCuisine"),
            _text("https://x.example/u/", key.cast("string")).alias("url"), F.lit("/i.png").alias("image")]
    flat = F.to_json(F.struct(*rest, F.col("c_mktsegment").alias("address")))
    return F.when(key % 2 == 0, flat).otherwise(F.to_json(F.struct(*rest, nested)))


def uber_linked_pages(t: Tables) -> DataFrame:
    return _linked(t, _uber_item(), "ubereats", uber_store_url())


UBER_LINKED_SQL = """
SELECT page_id, c_custkey, c_name AS name,
  CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) || ' X' WHEN c_custkey % 2 = 1 THEN n_name ELSE '' END AS city,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_mktsegment || ', ' || n_name || ', Spain' END AS address,
  CASE WHEN c_custkey % 2 = 1 THEN n_name END AS neighborhood, c_mktsegment AS food_type, c_mktsegment AS categories,
  nullif(c_custkey % 50 / 10, 0)::DOUBLE AS rating, nullif(c_custkey, 0) AS num_ratings,
  'https://x.example/u/' || CAST(c_custkey AS VARCHAR) AS restaurant_url, '/i.png' AS image_url
FROM fx_customer WHERE c_custkey % 5 <> 0 AND page_id % 4 <> 2
"""


def _glovo_card() -> Column:
    key = _key()
    number = key.cast("string")
    name = F.when(key % 7 == 6, "Todas las Tiendas").when(key % 11 == 5, "Repeated").otherwise(F.col("c_name"))
    rating = F.when(key % 3 == 0, _text("81% (1.", (key % 10).cast("string"), "k)")).when(key % 3 == 1, "<b>9</b>7 % (43)").otherwise("new")
    eta = F.when(key % 2 == 0, " 20-30 min ").otherwise("now")
    image = (F.when(key % 3 == 0, _text('<img src="/i/', number, '">')).when(key % 3 == 1, _text('<img data-src="/d/', number, '">'))
             .otherwise(_text("<i style=\"background-image:url('/s/", number, "')\"></i>")))
    inner = _text('<span class="x-name"> ', name, ' </span><div class="card-rating">', rating, '</div><p class="eta-text">', eta, "</p>", image)
    return F.when(key % 2 == 0, _text('<a class="collection-item big" href="/es/es/r/', number, '/">', inner, "</a>")).otherwise(
        _text('<a class="collection-item" href="https://x.example/r/', number, '">', inner, "</a>"))


def glovo_card_pages(t: Tables) -> DataFrame:
    """Cards with JSON-LD beside them, which these pages do not need; odd pages mark their cards in another way."""
    card = _glovo_card()
    marked = _text('<div data-test-id="category-store-card">', card, "</div>")
    b = fx.block_pages(fx.customers(t), card, marked)
    cards = F.when(F.col("page_id") % 2 == 0, F.col("t0")).otherwise(F.col("t1"))
    html = _text('<html><script type="application/ld+json">{"@type":"Restaurant","name":"unused"}</script><body>', cards, "</body></html>")
    return fx.page_rows(b, html, "glovo", glovo_url())


GLOVO_CARD_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT page_id, c_custkey, CASE WHEN c_custkey % 11 = 5 THEN 'Repeated' ELSE c_name END AS name, 'La Villa' AS city,
    CASE WHEN page_id % 2 = 0 THEN 'Pizza Y Mas' END AS food_type,
    CASE c_custkey % 3 WHEN 0 THEN 4.05 WHEN 1 THEN 4.85 END::DOUBLE AS rating,
    CASE c_custkey % 3 WHEN 0 THEN 1000 + 100 * (c_custkey % 10) WHEN 1 THEN 43 END AS num_ratings,
    CASE WHEN c_custkey % 2 = 0 THEN '20-30 min' END AS delivery_time,
    CASE WHEN c_custkey % 2 = 0 THEN 'https://glovoapp.com/es/es/r/' || CAST(c_custkey AS VARCHAR) || '/'
      ELSE 'https://x.example/r/' || CAST(c_custkey AS VARCHAR) END AS restaurant_url,
    CASE c_custkey % 3 WHEN 0 THEN '/i/' WHEN 1 THEN '/d/' ELSE '/s/' END || CAST(c_custkey AS VARCHAR) AS image_url,
    row_number() OVER (PARTITION BY page_id, CASE WHEN c_custkey % 11 = 5 THEN 'repeated' ELSE lower(c_name) END ORDER BY c_custkey) AS rn
  FROM fx_customer WHERE c_custkey % 7 <> 6) WHERE rn = 1
"""


def _uber_card() -> Column:
    key = _key()
    number = key.cast("string")
    inner = _text(
        F.when(key % 5 == 0, "").otherwise(_text("<h3> ", F.col("c_name"), "</h3>")), '<span class="RatingText">',
        F.when(key % 2 == 0, "4,4").otherwise("3.5 (12)"), '</span><b class="EtaText"> 15  min</b><i class="category"> ',
        F.col("c_mktsegment"), " •  Other • </i>")
    return _text('<a data-testid="store-card" aria-label="Label ', number, '" href="/es/store/', number, '">', inner, "</a>")


def uber_card_pages(t: Tables) -> DataFrame:
    """Cards; every fourth page has JSON-LD as well, which then decides."""
    b = fx.block_pages(fx.customers(t), _uber_card())
    linked = F.when(F.col("page_id") % 4 == 3, '<script type="application/ld+json">{"@type":"Restaurant","name":"Linked","url":"u"}</script>').otherwise("")
    return fx.page_rows(b, _text("<html>", linked, "<body>", F.col("t0"), "</body></html>"), "ubereats", fx.city_url())


UBER_CARD_SQL = """
SELECT page_id, c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Label ' || c_custkey ELSE c_name END AS name,
  CAST(page_id AS VARCHAR) || ' X' AS city, c_mktsegment AS food_type, c_mktsegment || '|Other' AS categories,
  CASE WHEN c_custkey % 2 = 0 THEN 4.4 ELSE 3.5 END::DOUBLE AS rating, '15 min' AS delivery_time,
  'https://www.ubereats.com/es/store/' || CAST(c_custkey AS VARCHAR) AS restaurant_url
FROM fx_customer WHERE page_id % 4 <> 3
UNION ALL SELECT page_id, -1, 'Linked', CAST(page_id AS VARCHAR) || ' X', NULL, '', NULL, NULL, 'u'
FROM fx_customer WHERE page_id % 4 = 3 GROUP BY page_id
"""


def just_located_pages(t: Tables) -> DataFrame:
    """State found by pattern: a result list on even pages, an attribute with escaped quotes on odd ones."""
    key = _key()
    number = key.cast("string")
    one = F.to_json(F.struct(
        _text(F.col("c_name"), " & Co").alias("restaurantName"), F.struct((key % 6).alias("value"), key.alias("total")).alias("ratings"),
        F.struct((key % 4).alias("cost"), (key % 50 + 1).alias("etaMinutes"), (key % 20).alias("minimumOrder")).alias("deliveryInfo"),
        _text("s", number).alias("seoName"), F.col("n_name").alias("area"), (key % 3 == 0).alias("isSponsored"),
        (key / 4 + 1).alias("lat"), (key / 8 + 1).alias("lng"), F.lit("$").alias("priceCategory")))
    two = F.to_json(F.struct(
        F.col("c_name").alias("DisplayName"), F.struct((key % 6 + 0.5).alias("StarRating")).alias("Rating"),
        F.struct(F.col("c_mktsegment").alias("FirstLine"), F.col("n_name").alias("City"), F.lit("").alias("Postcode")).alias("Address"),
        F.struct(F.lit("1,50").alias("fee"), F.lit("20-25 min").alias("time")).alias("delivery"), (key + 7).alias("NumberOfReviews"),
        _text("https://x.example/j/", number).alias("url"), (key % 2 == 1).alias("isNewlyOnPlatform"), F.lit("/l.png").alias("logoUrl")))
    b = fx.block_pages(fx.customers(t), F.when(key % 2 == 0, one).otherwise(two))
    escaped = F.replace(F.replace(_text("[", F.col("t0"), "]"), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    html = F.when(F.col("page_id") % 2 == 0, _text('<html><script>var s = {"searchResults": [', F.col("t0"), '], "n": 1};</script></html>')).otherwise(
        _text("<html><script>x.innerHTML = \"<div data-restaurant-list='", escaped, "'>\";</script></html>"))
    return fx.page_rows(b, html, "justeat", fx.area_url())


JUST_LOCATED_SQL = """
SELECT page_id, c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' & Co' ELSE '' END AS name, 'San Juan' AS city,
  CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment || ', ' || n_name END AS address, CASE WHEN c_custkey % 2 = 0 THEN n_name END AS neighborhood,
  CASE WHEN c_custkey % 2 = 0 THEN nullif(c_custkey % 6, 0) ELSE c_custkey % 6 + 0.5 END::DOUBLE AS rating,
  CASE WHEN c_custkey % 2 = 0 THEN nullif(c_custkey, 0) ELSE c_custkey + 7 END AS num_ratings,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(nullif(c_custkey % 4, 0) AS VARCHAR) ELSE '1,50' END AS delivery_fee,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 50 + 1 AS VARCHAR) || ' min' ELSE '20-25 min' END AS delivery_time,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(nullif(c_custkey % 20, 0) AS VARCHAR) END AS min_order,
  c_custkey % 2 = 0 AND c_custkey % 3 = 0 AS is_promoted, c_custkey % 2 = 1 AS is_new,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 4 + 1 END AS latitude, CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 8 + 1 END AS longitude,
  CASE WHEN c_custkey % 2 = 0 THEN 'https://www.just-eat.es/restaurants-s' ELSE 'https://x.example/j/' END || CAST(c_custkey AS VARCHAR) AS restaurant_url
FROM fx_customer
"""

# All kinds of pages: what builds them, and their crawl.
KINDS = {
    "justeat_linked": (fx.linked_pages, "CC-MAIN-2023-06"), "justeat_keyed": (fx.keyed_pages, "CC-MAIN-2023-14"),
    "justeat_tree": (fx.tree_pages, "CC-MAIN-2023-23"), "justeat_cards": (fx.card_pages, "CC-MAIN-2023-40"),
    "justeat_located": (just_located_pages, "CC-MAIN-2023-50"), "ubereats_scripts": (fx.script_pages, "CC-MAIN-2023-06"),
    "ubereats_linked": (uber_linked_pages, "CC-MAIN-2023-14"), "ubereats_cards": (uber_card_pages, "CC-MAIN-2023-23"),
    "glovo_linked": (glovo_linked_pages, "CC-MAIN-2023-06"), "glovo_cards": (glovo_card_pages, "CC-MAIN-2023-14"),
}


def all_pages(t: Tables) -> DataFrame:
    return bag_union(*[build(t).withColumn("crawl_id", F.lit(crawl)) for build, crawl in KINDS.values()])


_STORES: dict[tuple[str, str], str] = {}


def stored_pages(t: Tables) -> str:
    """A page store of all kinds, built once per table folder and Spark context."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STORES:
        path = f"{scratch_dir(t.spark, 'all-pages')}/pages"
        page_store.write_pages(all_pages(t).drop("page_id"), path)
        _STORES[key] = path
    return _STORES[key]


# Crawl, platform, city and duplicate key of every row that the stored pages must give.
ALL_SQL = f"""
WITH {CUSTOMER_SQL},
jl AS (SELECT * FROM fx_customer WHERE c_custkey % 5 <> 0),
jc AS (SELECT *, row_number() OVER (PARTITION BY page_id, CASE WHEN c_custkey % 7 = 6 THEN '' ELSE lower(c_name) END ORDER BY c_custkey) AS rn
  FROM fx_customer),
gl AS ({GLOVO_LINKED_SQL}), gc AS ({GLOVO_CARD_SQL}), ul AS ({UBER_LINKED_SQL}), uc AS ({UBER_CARD_SQL}), jo AS ({JUST_LOCATED_SQL}),
found AS (
  SELECT 'CC-MAIN-2023-06' AS crawl_id, 'Just Eat' AS platform, 'San Juan' AS city, 'l' || c_custkey AS k FROM jl
  UNION ALL SELECT 'CC-MAIN-2023-14', 'Just Eat', 'San Juan', 'k' || c_custkey FROM fx_customer WHERE page_id % 6 <> 0
  UNION ALL SELECT 'CC-MAIN-2023-23', 'Just Eat', CASE WHEN c_custkey % 2 = 0 THEN 'San Juan' ELSE n_name END, 't' || c_custkey FROM fx_customer
  UNION ALL SELECT 'CC-MAIN-2023-40', 'Just Eat', 'San Juan', 'c' || c_custkey FROM jc WHERE rn = 1
  UNION ALL SELECT 'CC-MAIN-2023-50', 'Just Eat', city, restaurant_url FROM jo
  UNION ALL SELECT 'CC-MAIN-2023-06', 'Uber Eats', page_id || ' X', CASE WHEN c_custkey % 2 = 0 THEN '/s/' || c_custkey ELSE lower(c_name) END
    FROM fx_customer WHERE page_id % 2 = 0
  UNION ALL SELECT 'CC-MAIN-2023-14', 'Uber Eats', city, restaurant_url FROM ul
  UNION ALL SELECT 'CC-MAIN-2023-23', 'Uber Eats', CASE WHEN restaurant_url = 'u' THEN min(city) OVER (PARTITION BY restaurant_url) ELSE city END, restaurant_url FROM uc
  UNION ALL SELECT 'CC-MAIN-2023-06', 'Glovo', city, restaurant_url FROM gl
  UNION ALL SELECT 'CC-MAIN-2023-14', 'Glovo', city, restaurant_url FROM gc)
"""
