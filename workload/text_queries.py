"""Column functions on texts made from the part, customer and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import numbers, text, urls
from gleaner.operators import cards
from gleaner.profiles import profile
from workload.registry import Tables, query

GLOVO, UBER, JUST = profile("glovo"), profile("ubereats"), profile("justeat")


def _key(c: str):
    return F.col(c).cast("string")


@query("c01_crawl_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE WHEN o_orderkey % 5 = 4 THEN 'n/a ' || CAST(o_orderkey % 7 AS VARCHAR) || '12345' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_text
FROM orders
""")
def _(t: Tables):
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    ts = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format(d, "yyyyMMddHHmmss"))
          .when(k == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(d, "yyyy-M-d")))
    odd = F.concat(F.lit("n/a "), (F.col("o_orderkey") % 7).cast("string"), F.lit("1234567"))
    return t.orders.select(
        "o_orderkey", F.date_format(numbers.crawl_date(ts), "yyyy-MM-dd").alias("day"),
        numbers.crawl_date_text(F.when(k == 4, odd).otherwise(ts)).alias("day_text"))


@query("c02_clean_text", "SELECT p_partkey, p_name || ' & co' AS name FROM part")
def _(t: Tables):
    messy = F.concat(
        F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("  \t&nbsp;")), F.lit("\n&amp; co  "))
    return t.part.select("p_partkey", text.clean_text(messy).alias("name"))


@query("c03_unescape", """
SELECT p_partkey, 'é' || p_name || 'ñAB😀 &lt; ©2 &unknown; € &' || chr(9) AS name, '"' || p_brand || '&' AS basic FROM part
""")
def _(t: Tables):
    coded = F.concat(F.lit("&eacute;"), "p_name", F.lit("&#241;&#x41;&#66&#x1F600; &amp;lt; &copy2 &unknown; &#128; &&Tab;"))
    return t.part.select(
        "p_partkey", text.unescape_entities(coded).alias("name"),
        text.unescape_basic(F.concat(F.lit("&quot;"), "p_brand", F.lit("&amp;"))).alias("basic"))


@query("c04_first_number", "SELECT p_partkey, round(p_retailprice, 1) AS n, CAST(NULL AS DOUBLE) AS none FROM part")
def _(t: Tables):
    shown = F.replace(F.format_string("%.1f", "p_retailprice"), F.lit("."), F.lit(","))
    return t.part.select(
        "p_partkey", numbers.first_number(F.concat(F.lit("ca. "), shown, F.lit(" of 10"))).alias("n"),
        numbers.first_number(F.lit("none")).alias("none"))


@query("c05_rating_count", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN p_size * 1000 + 500 ELSE p_size END AS n,
  CASE p_partkey % 4 WHEN 2 THEN p_size * 1000 + 234 END AS whole FROM part
""")
def _(t: Tables):
    k, n = F.col("p_partkey") % 4, _key("p_size")
    shown = (F.when(k == 0, F.concat(F.lit("("), n, F.lit(")"))).when(k == 1, F.concat(n, F.lit("+ ratings")))
             .when(k == 2, F.concat(n, F.lit(",234"))).otherwise(F.concat(F.lit("("), n, F.lit(".5 K+)"))))
    return t.part.select(
        "p_partkey", numbers.rating_count(shown).alias("n"),
        F.when(k == 2, numbers.rating_count(shown, thousands=True)).alias("whole"))


@query("c06_percent_rating", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 20.0 END AS r FROM part
""")
def _(t: Tables):
    shown = F.when(F.col("p_partkey") % 3 == 0, "new").otherwise(F.concat(_key("p_size"), F.lit(" % (43)")))
    return t.part.select("p_partkey", numbers.percent_rating(shown).alias("r"))


@query("c07_bracketed_count", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1000 + 200 END AS n FROM part
""")
def _(t: Tables):
    k, n = F.col("p_partkey") % 3, _key("p_size")
    shown = (F.when(k == 0, F.concat(F.lit("81% ("), n, F.lit(")"))).when(k == 1, F.concat(F.lit("("), n, F.lit(",2k)")))
             .otherwise(F.concat(F.lit("81% "), n)))
    return t.part.select("p_partkey", numbers.bracketed_count(shown).alias("n"))


@query("c08_city_glovo", """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' De Mar'
  WHEN 1 THEN 'L''' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) WHEN 4 THEN 'Sant Joan' END AS city FROM customer
""")
def _(t: Tables):
    k, seg = F.col("c_custkey") % 5, F.lower("c_mktsegment")
    slug = (F.when(k == 0, F.concat(seg, F.lit("-de_mar_12"))).when(k == 1, F.concat(F.lit("l'"), seg, F.lit("-Restaurantes-x")))
            .when(k == 2, F.concat(seg, F.lit("-a-domicilio"))).when(k == 3, "restaurantes_1").otherwise("sant-joan"))
    return t.customer.select("c_custkey", urls.city_from_url(
        F.concat(F.lit("https://glovoapp.com/es/ca/"), slug, F.lit("/x/")), GLOVO.city_steps).alias("city"))


@query("c09_city_ubereats", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Málaga+' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
  WHEN 1 THEN 'San ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) WHEN 2 THEN '100% Leon' END AS city FROM customer
""")
def _(t: Tables):
    k, seg = F.col("c_custkey") % 4, F.lower("c_mktsegment")
    tail = (F.when(k == 0, F.concat(F.lit("es-en/city/m%C3%A1laga+"), seg, F.lit("-es-md?pl=1")))
            .when(k == 1, F.concat(F.lit("city/san-"), seg)).when(k == 2, "es/city/100%-leon/pizza").otherwise("es/store/x"))
    return t.customer.select("c_custkey", urls.city_from_url(
        F.concat(F.lit("https://www.ubereats.com/"), tail), UBER.city_steps).alias("city"))


@query("c10_city_justeat", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'San ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
  WHEN 3 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS city FROM customer
""")
def _(t: Tables):
    k, seg = F.col("c_custkey") % 4, F.lower("c_mktsegment")
    tail = (F.when(k == 0, F.concat(F.lit("area/28006-san-"), seg, F.lit("?lang=es"))).when(k == 1, F.concat(F.lit("restaurants-"), seg))
            .when(k == 2, "a-domicilio").otherwise(seg))
    return t.customer.select("c_custkey", urls.city_from_url(
        F.concat(F.lit("https://www.just-eat.es/"), tail), JUST.city_steps).alias("city"))


@query("c11_category_from_url", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Grill'
  WHEN 3 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS category FROM customer
""")
def _(t: Tables):
    k, seg = F.col("c_custkey") % 4, F.lower("c_mktsegment")
    tail = (F.when(k == 0, F.concat(F.lit("restaurantes_1/"), seg, F.lit("-grill_34701/"))).when(k == 1, "comida_1/search-x/")
            .when(k == 2, F.concat(F.lit("tiendas_1/"), seg)).otherwise(F.concat(F.lit("menjar_1/"), seg)))
    return t.customer.select("c_custkey", urls.category_from_url(
        F.concat(F.lit("https://glovoapp.com/es/ca/leon/"), tail), GLOVO.category_rule).alias("category"))


@query("c12_title_case", r"""
SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(p_name || ' de_l''hosp 2a ' || p_type, '[a-zA-Z]+|[^a-zA-Z]+'),
  lambda w: upper(w[1]) || lower(w[2:])), '') AS title FROM part
""")
def _(t: Tables):
    return t.part.select("p_partkey", text.title_case(F.concat("p_name", F.lit(" de_l'hosp 2a "), "p_type")).alias("title"))


@query("c13_absolutise", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'https://b.example/p/' || p_partkey WHEN p_partkey % 3 = 1
  THEN 'http://o.example/' || p_partkey END AS u, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'https://b.example/r-' || p_brand END AS s
FROM part
""")
def _(t: Tables):
    k = F.col("p_partkey") % 3
    u = F.when(k == 0, F.concat(F.lit("/p/"), _key("p_partkey"))).when(k == 1, F.concat(F.lit("http://o.example/"), _key("p_partkey")))
    s = F.when(k == 0, "").otherwise(F.col("p_brand"))
    return t.part.select(
        "p_partkey", urls.absolutise(u, "https://b.example").alias("u"), urls.slug_url(s, "https://b.example/r-").alias("s"))


@query("c14_address", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ', ' || c_mktsegment WHEN 1 THEN c_mktsegment
  ELSE c_name || ', ' || c_mktsegment || ', ' || CAST(c_nationkey AS VARCHAR) END AS address FROM customer
""")
def _(t: Tables):
    k = F.col("c_custkey") % 3
    parts = [F.when(k == 1, F.lit(None)).otherwise(F.col("c_name")), F.col("c_mktsegment"),
             F.when(k == 2, _key("c_nationkey")).otherwise("")]
    return t.customer.select("c_custkey", text.join_present(parts).alias("address"))


@query("c15_locality", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'Spain, ' || c_mktsegment END AS place,
  CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS city FROM customer
""")
def _(t: Tables):
    k = F.col("c_custkey")
    raw = F.when(k % 2 == 0, F.concat("c_mktsegment", F.lit(",  Spain"))).otherwise(F.concat(F.lit("Spain, "), "c_mktsegment"))
    place = F.trim(F.regexp_replace(raw, UBER.linked_data.locality_strip, ""))
    city = text.first_present(F.when(k % 3 == 0, F.col("c_name")).when(k % 3 == 1, ""), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", place.alias("place"), city.alias("city"))


@query("c16_eta_range", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '-' || (p_size + 10) || ' min' WHEN 1 THEN p_size || ' min' END AS eta FROM part
""")
def _(t: Tables):
    k = F.col("p_partkey") % 4
    low = F.when(k < 2, _key("p_size")).when(k == 2, "0")
    high = F.when(k != 1, (F.col("p_size") + 10).cast("string"))
    return t.part.select("p_partkey", numbers.eta_range(low, high).alias("eta"))


@query("c17_eta_text", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '-50 MIN' WHEN 1 THEN p_size || ' horas' END AS eta FROM part
""")
def _(t: Tables):
    k, n = F.col("p_partkey") % 4, _key("p_size")
    shown = F.when(k == 0, F.concat(n, F.lit("-50 MIN"))).when(k == 1, F.concat(n, F.lit(" horas"))).when(
        k == 2, F.concat(n, F.lit(" km"))).otherwise("min")
    return t.part.select("p_partkey", numbers.eta_text(shown).alias("eta"))


@query("c18_category_lists", """
SELECT p_partkey, p_type || '|' || p_brand AS dots, p_type AS first, p_brand || '|x' AS kept FROM part
""")
def _(t: Tables):
    dots = text.split_list(F.concat(F.lit(" "), "p_type", F.lit(" • •"), "p_brand", F.lit(" ")), "•")
    named = F.array(
        F.struct(F.lit(None).cast("string").alias("name"), F.lit("").alias("title")),
        F.struct(F.lit("").alias("name"), F.col("p_brand").alias("title")),
        F.struct(F.lit("x").alias("name"), F.lit("y").alias("title")))
    kept = text.drop_empty(F.transform(named, lambda c: text.first_present(c["name"], c["title"])))
    return t.part.select(
        "p_partkey", text.list_to_pipe(dots).alias("dots"), text.first_item(dots).alias("first"),
        text.list_to_pipe(kept).alias("kept"))


@query("c20_aliases", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_type END AS name,
  CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE CAST(p_size AS DOUBLE) END AS value FROM part
""")
def _(t: Tables):
    from gleaner.functions import variants as V

    k = F.col("p_partkey")
    doc = F.to_json(F.struct(
        F.when(k % 3 == 0, F.col("p_name")).when(k % 3 == 1, "").alias("name"),
        F.when(k % 3 == 1, F.col("p_brand")).alias("displayName"), F.col("p_type").alias("Name"),
        F.when(k % 2 == 0, F.col("p_retailprice")).otherwise(0.0).alias("value"), F.col("p_size").alias("total")))
    df = t.part.select("p_partkey", F.try_parse_json(doc).alias("v"))
    return df.select(
        "p_partkey", V.first_text(F.col("v"), ("name", "displayName", "Name")).alias("name"),
        V.first_number(F.col("v"), ("value", "total")).alias("value"))


@query("c28_style_image", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE 'https://i.example/' || p_partkey || '.png' END AS image FROM part
""")
def _(t: Tables):
    k, u = F.col("p_partkey") % 4, F.concat(F.lit("https://i.example/"), _key("p_partkey"), F.lit(".png"))
    style = (F.when(k == 0, F.concat(F.lit("color:red;background-image:url("), u, F.lit(")")))
             .when(k == 1, F.concat(F.lit("background-image: url('"), u, F.lit("')")))
             .when(k == 2, F.concat(F.lit('background-image:url("'), u, F.lit('");x:y'))).otherwise("color:red"))
    return t.part.select("p_partkey", urls.style_image(style).alias("image"))


@query("c29_safe_numbers", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 1000 + 234 WHEN 1 THEN p_size END AS n,
  CASE p_partkey % 4 WHEN 0 THEN p_size / 20.0 WHEN 1 THEN CAST(p_size AS DOUBLE) END AS r FROM part
""")
def _(t: Tables):
    k, n = F.col("p_partkey") % 4, _key("p_size")
    count = F.when(k == 0, F.concat(n, F.lit(",234"))).when(k == 1, n).when(k == 2, "4,5x")
    rating = F.when(k == 0, F.concat(n, F.lit(" %"))).when(k == 1, n).when(k == 2, "4,5").otherwise("0")
    return t.part.select(
        "p_partkey", numbers.safe_long(count, thousands=True).alias("n"), numbers.rating_value(rating, percent=True).alias("r"))


@query("f14_name_skip_list", """
SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(lower(p_name), 'red|bolt')
  AND NOT regexp_matches(lower(CASE p_partkey % 9 WHEN 0 THEN 'Ver Más' WHEN 1 THEN '-20% off' ELSE p_name END),
    'ver más|-20%')
""")
def _(t: Tables):
    shown = F.when(F.col("p_partkey") % 9 == 0, "Ver Más").when(F.col("p_partkey") % 9 == 1, "-20% off").otherwise(F.col("p_name"))
    return t.part.where(
        ~cards.name_reject(F.col("p_name"), ("red", "bolt")) & ~cards.name_reject(shown, GLOVO.cards.name_reject)
    ).select("p_partkey", "p_name")


@query("f15_name_guards", """
SELECT p_partkey FROM part WHERE length(CASE p_partkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN repeat(p_name, 20) ELSE p_name END)
  BETWEEN 2 AND 99 AND p_partkey % 7 <> 3
""")
def _(t: Tables):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, "x").when(k % 5 == 1, F.repeat("p_name", F.lit(20))).otherwise(F.col("p_name"))
    shown = F.when(k % 7 == 3, "GlovoApp").otherwise(F.col("p_name"))
    return t.part.where(
        cards.name_length_ok(name, GLOVO.cards) & ~F.lower(shown).isin(*GLOVO.linked_data.reject_names)).select("p_partkey")
