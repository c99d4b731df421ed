"""Pages built from customers, flattened back to rows and compared with the customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import variants as V
from gleaner.functions.rows import explode_once
from gleaner.functions.text import drop_tokens, list_to_pipe
from gleaner.operators import cards, features, linked_data, lookups, nodes, page_state, quality, ranking, reports, scripts
from gleaner.plans import extract_step as ex
from gleaner.plans import audit_step
from gleaner.profiles import profile
from gleaner.schema import SUMMARY_COLUMNS
from gleaner.session import scratch_dir
from gleaner.sources import layout
from workload import archive
from workload import fixtures as fx
from workload.fixtures import CARD_SQL, CUSTOMER_SQL, INDEX_SQL, KEYED_SQL, LINKED_SQL, SCRIPT_SQL, TREE_SQL
from workload.registry import Tables, query

JUST, UBER = profile("justeat"), profile("ubereats")


def _scripts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", scripts.script_elements(F.col("html")).alias("s"))


def _rows(pages: DataFrame, source=JUST) -> DataFrame:
    """Entities of the pages with their page key, categories as text."""
    return ex.extract_entities(pages, (source,), carry=("page_id",)).withColumn(
        "categories", F.array_join("categories", "|"))


@query("x01_linked_data_blocks", f"""
WITH {CUSTOMER_SQL} SELECT page_id, CASE WHEN page_id % 4 = 3 THEN count(*) ELSE 1 END + 1 AS n_blocks,
  CASE WHEN page_id % 4 = 3 THEN count(*) ELSE 1 END AS n_parsed FROM fx_customer GROUP BY page_id
""")
def _(t: Tables):
    return _scripts(fx.linked_pages(t)).select(
        "page_id", F.size(scripts.linked_data_texts(F.col("s"))).cast("bigint").alias("n_blocks"),
        F.size(linked_data.roots(F.col("s"))).cast("bigint").alias("n_parsed"))


def _items(t: Tables) -> DataFrame:
    found = linked_data.items(linked_data.roots(F.col("s")), search_page=True)
    return explode_once(_scripts(fx.linked_pages(t)), found, "v", "page_id", pos="pos")


@query("x02_linked_data_items", f"""
WITH {CUSTOMER_SQL} SELECT page_id, '  ' || c_name || ' &amp; Sons' AS name,
  CASE WHEN c_custkey % 5 = 0 THEN 'Organization' ELSE 'Restaurant' END AS type,
  row_number() OVER (PARTITION BY page_id ORDER BY c_custkey) - 1 AS pos FROM fx_customer
""")
def _(t: Tables):
    return _items(t).select(
        "page_id", "pos", V.text(F.col("v"), "name").alias("name"), linked_data.type_of(F.col("v")).alias("type"))


@query("x03_type_whitelist", f"""
WITH {CUSTOMER_SQL} SELECT page_id, count(*) AS n FROM fx_customer WHERE c_custkey % 5 <> 0 GROUP BY page_id
""")
def _(t: Tables):
    kept = _items(t).where(linked_data.accept(F.col("v"), JUST.linked_data))
    return kept.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


_LINKED_COLS = [
    "page_id", "name", "address", "neighborhood", "food_type", "categories", "rating", "num_ratings", "latitude",
    "longitude", "restaurant_url"]


@query("x04_linked_data_entities", f"{LINKED_SQL} SELECT {', '.join(_LINKED_COLS)} FROM rows")
def _(t: Tables):
    return _rows(fx.linked_pages(t)).select(*_LINKED_COLS)


@query("x05_state_decode", f"""
WITH {CUSTOMER_SQL} SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 0 ELSE count(*) END AS n_state,
  CASE WHEN page_id % 6 = 0 THEN NULL ELSE max(c_name || CASE WHEN c_custkey % 2 = 0 THEN ' é' ELSE ' e' END) END AS last
FROM fx_customer GROUP BY page_id
""")
def _(t: Tables):
    df = fx.keyed_pages(t).select("page_id", page_state.keyed_state(F.col("html"), "__INITIAL_STATE__").alias("d"))
    names = F.transform(
        F.map_values(V.get(F.col("d"), "restaurants", "map<string,variant>")), lambda v: V.text(v, "name"))
    return df.select(
        "page_id", page_state.keyed_count(F.col("d"), JUST.keyed_state).cast("bigint").alias("n_state"),
        F.array_max(names).alias("last"))


_KEYED_COLS = [
    "page_id", "name", "address", "food_type", "categories", "rating", "num_ratings", "delivery_fee", "min_order",
    "delivery_time", "is_new", "restaurant_url"]


@query("x06_keyed_state", f"{KEYED_SQL} SELECT {', '.join(_KEYED_COLS)} FROM rows")
def _(t: Tables):
    return _rows(fx.keyed_pages(t)).select(*_KEYED_COLS)


_TREE_COLS = [
    "page_id", "name", "city", "address", "food_type", "rating", "num_ratings", "delivery_fee", "min_order",
    "delivery_time", "is_new", "latitude", "longitude"]


@query("x07_state_tree", TREE_SQL)
def _(t: Tables):
    return _rows(fx.tree_pages(t)).select(*_TREE_COLS)


@query("x08_located_documents", f"""
WITH {CUSTOMER_SQL} SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS n_docs FROM fx_customer GROUP BY page_id
""")
def _(t: Tables):
    return _scripts(fx.script_pages(t)).select(
        "page_id", F.size(page_state.located_documents(F.col("s"), UBER.items)).alias("n_docs"))


@query("x09_located_items", f"""
WITH {CUSTOMER_SQL}, p AS (SELECT page_id, c_name, c_custkey % 3 AS shape FROM fx_customer)
SELECT page_id, c_name AS name FROM p
""")
def _(t: Tables):
    # The same customers as a list under a key, as a map of objects, and as a map of lists.
    one = F.to_json(F.struct(F.col("c_name").alias("title")))
    key = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('":'))
    b = fx.block_pages(
        fx.customers(t), one, F.concat(key, one), F.concat(key, F.lit("["), one, F.lit(',"x"]')))
    doc = (F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('{"data":["skip",'), "t0", F.lit("]}")))
           .when(F.col("page_id") % 3 == 1, F.concat(F.lit('{"state":{'), "t1", F.lit("}}")))
           .otherwise(F.concat(F.lit('{"queries":{'), "t2", F.lit(',"n":1}}'))))
    docs = F.array(F.try_parse_json(doc))
    return explode_once(b, page_state.located_items(docs, UBER.items), "v", "page_id").select(
        "page_id", V.text(F.col("v"), "title").alias("name"))


_SCRIPT_COLS = [
    "page_id", "name", "address", "rating", "num_ratings", "delivery_time", "is_promoted", "price_range", "latitude",
    "restaurant_url"]


@query("x10_located_entities", SCRIPT_SQL)
def _(t: Tables):
    return _rows(fx.script_pages(t), UBER).select(*_SCRIPT_COLS)


# Entities of the test pages in SQL; some are cut off before the semicolon.
_TEXT_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), "
    "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')")


@query("x11_node_table", f"""
SELECT page_id, length(regexp_extract_all(html, '<li[ >]')) AS n_li, length(regexp_extract_all(html, '<a[ >]')) AS n_a,
  length(regexp_extract_all(html, '<p[ >]')) AS n_p, length(regexp_extract_all(html, '<br[ />]')) AS n_br,
  {_TEXT_SQL.format("regexp_extract(html, '<h1[^>]*>([^<]*)<', 1)")} AS heading
FROM pages
""")
def _(t: Tables):
    df = t.pages.select("page_id", nodes.parse_nodes(F.col("html")).alias("n"))
    counts = [F.size(nodes.select(F.col("n"), tag)).cast("bigint").alias(f"n_{tag}") for tag in ("li", "a", "p", "br")]
    first = nodes.text_of(F.col("n"), nodes.select_one(F.col("n"), "h1"))
    return df.select("page_id", *counts, first.alias("heading"))


@query("x12_card_selection", f"{CARD_SQL} SELECT page_id, 0 AS rank, count(*) AS n FROM rows GROUP BY page_id")
def _(t: Tables):
    table = cards.selector_table(JUST)
    parsed = nodes.parse_nodes(F.col("html"), cards.kept_attrs(JUST, table), table)
    df = cards.select_cards(fx.card_pages(t).select("page_id", parsed.alias("_nodes")), JUST.cards, table=table)
    return df.select(
        "page_id", F.array_min(F.transform("_cards", lambda c: c["rank"])).alias("rank"),
        F.size("_cards").cast("bigint").alias("n"))


_CARD_COLS = [
    "page_id", "name", "rating", "num_ratings", "delivery_time", "food_type", "categories", "restaurant_url", "image_url"]


@query("x13_card_entities", f"{CARD_SQL} SELECT {', '.join(_CARD_COLS)} FROM rows")
def _(t: Tables):
    return _rows(fx.card_pages(t)).select(*_CARD_COLS)


@query("x14_promo_tags", """
SELECT p_partkey, array_to_string(list_filter([p_type, 'Nuevo', p_brand, 'SPONSORED'],
  lambda x: lower(x) NOT IN ('tarjeta de sellos', 'patrocinado', 'nuevo', 'oferta', 'sponsored', 'nuevo restaurante')), '|') AS tags
FROM part
""")
def _(t: Tables):
    tags = F.array("p_type", F.lit("Nuevo"), "p_brand", F.lit("SPONSORED"))
    return t.part.select("p_partkey", list_to_pipe(drop_tokens(tags, JUST.cards.tags_reject)).alias("tags"))


_TRUTH_SQL = """
truth AS (SELECT page_id, lower(c_name || ' & sons') AS name, c_custkey FROM fx_customer
  WHERE page_id % 4 = 1 OR (page_id % 4 IN (0, 3) AND c_custkey % 5 <> 0))
"""


def _truth(t: Tables) -> DataFrame:
    return explode_once(_scripts(fx.linked_pages(t)), linked_data.truth_names(F.col("s")), "name", "page_id")


@query("x15_truth_names", f"WITH {CUSTOMER_SQL}, {_TRUTH_SQL} SELECT page_id, name FROM truth")
def _(t: Tables):
    return _truth(t)


def _feature_pages(t: Tables) -> DataFrame:
    pid = F.col("page_id")
    extra = F.concat(
        F.when(pid % 3 == 0, F.repeat(F.lit('<div class="x store-card">c</div>'), F.lit(7))).otherwise(""),
        F.when(pid % 4 == 1, '<script id="__NEXT_DATA__">{"a":"__NEXT_DATA__"}</script>').otherwise(""),
        F.when(pid % 5 == 2, '<script type="application/ld+json">[{"@type":"Restaurant"},{"a":1}]</script>').otherwise(""),
        F.when(pid % 6 == 3, "<script>window.__PRELOADED_STATE__={}</script>").otherwise(""))
    return t.pages.select(
        "page_id", F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1).alias("platform"),
        F.concat("html", extra).alias("html"))


_FEATURE_SQL = f"""
features AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS platform,
  trim({_TEXT_SQL.format("regexp_extract(html, '<title>([^<]*)<', 1)")}) AS title,
  page_id % 5 = 2 AS has_json_ld, CASE WHEN page_id % 5 = 2 THEN 'Restaurant|unknown' ELSE '' END AS types,
  page_id % 4 = 1 AS has_next_data, page_id % 6 = 3 AS has_initial_state,
  length(regexp_extract_all(html, '<a [^>]*href')) AS num_links,
  CASE WHEN page_id % 3 = 0 THEN 7 ELSE 1 END AS num_cards,
  CASE WHEN page_id % 3 = 0 THEN 'listing' ELSE 'detail' END AS estimated_type FROM pages)
"""


@query("x16_page_features", f"WITH {_FEATURE_SQL} SELECT * FROM features")
def _(t: Tables):
    df = features.page_features(_feature_pages(t), ["page_id", "platform"])
    return df.withColumn("types", F.array_join("json_ld_types", "|")).drop("json_ld_types")


_A14_SQL = f"{_FEATURE_SQL}, f14 AS (SELECT *, 'CC-MAIN-202' || CAST(page_id % 3 + 2 AS VARCHAR) || '-05' AS crawl_id FROM features)"


def _a14(t: Tables) -> DataFrame:
    crawl = F.concat(F.lit("CC-MAIN-202"), (F.col("page_id") % 3 + 2).cast("string"), F.lit("-05"))
    return features.page_features(_feature_pages(t), ["page_id", "platform"]).withColumn("crawl_id", crawl)


@query("a14_structure_profile", f"""
WITH {_A14_SQL} SELECT platform, crawl_id, count(*) AS total_files,
  count(*) FILTER (WHERE estimated_type = 'listing') AS n_listing,
  count(*) FILTER (WHERE estimated_type = 'detail') AS n_detail, 0 AS n_other,
  count(*) FILTER (WHERE has_json_ld) AS n_json_ld,
  count(*) FILTER (WHERE has_next_data OR has_initial_state) AS n_state FROM f14 GROUP BY platform, crawl_id
""")
def _(t: Tables):
    return reports.structure_profile(_a14(t))


@query("a14_structure_types", f"""
WITH {_A14_SQL} SELECT platform, crawl_id, type, count(*) AS n_pages
FROM (SELECT platform, crawl_id, unnest(string_split(types, '|')) AS type FROM f14 WHERE types <> '') GROUP BY ALL
""")
def _(t: Tables):
    return reports.structure_types(_a14(t))


@query("a11_type_histogram", f"""
WITH {CUSTOMER_SQL},
types AS (SELECT CASE page_id % 4 WHEN 1 THEN 'ItemList' WHEN 2 THEN 'SearchResultsPage' END AS type, 1 AS k
    FROM fx_customer WHERE page_id % 4 IN (1, 2) GROUP BY page_id
  UNION ALL SELECT CASE WHEN c_custkey % 5 = 0 THEN 'Organization' ELSE 'Restaurant' END, 1 FROM fx_customer
    WHERE page_id % 4 IN (0, 3)),
c AS (SELECT 'justeat' AS platform, type, count(*) AS n FROM types GROUP BY type)
SELECT platform, type, n, row_number() OVER (ORDER BY n DESC, type) AS rn, false AS unhandled FROM c
""")
def _(t: Tables):
    types = explode_once(
        _scripts(fx.linked_pages(t)), linked_data.declared_types(F.col("s")), "type", F.lit("justeat").alias("platform"))
    return reports.type_histogram(types)


@query("j04_keyed_merge", f"{KEYED_SQL} SELECT page_id, name, food_type, rating, min_order FROM rows")
def _(t: Tables):
    df = fx.keyed_pages(t).select("page_id", page_state.keyed_state(F.col("html"), "__INITIAL_STATE__").alias("d"))
    df = df.where(F.col("d").isNotNull())

    def side(name: str) -> DataFrame:
        return df.select("page_id", F.explode(V.get(F.col("d"), name, "map<string,variant>")).alias("id", "v"))

    merged = lookups.keyed_merge(
        side("restaurants").select("page_id", "id", V.text(F.col("v"), "name").alias("name")), ["page_id", "id"],
        tags=side("restaurantCuisines").select("page_id", "id", V.text(F.col("v"), "$[0]").alias("food_type")),
        ratings=side("ratings").select("page_id", "id", V.first_number(F.col("v"), ("starRating",)).alias("rating")),
        fees=side("deliveryFees").select("page_id", "id", V.text(F.col("v"), "minimumOrderValue").alias("min_order")))
    return merged.drop("id")


@query("j05_missing_names", f"""
{LINKED_SQL.replace("SELECT page_id, c_custkey,", "SELECT page_id, c_custkey,", 1)}, {_TRUTH_SQL},
e AS (SELECT DISTINCT page_id, lower(name) AS name FROM rows WHERE page_id % 4 <> 1 OR num_ratings % 3 = 0),
b AS (SELECT coalesce(t.page_id, e.page_id) AS page_id, t.name AS tn, e.name AS en
  FROM truth t FULL JOIN e ON t.page_id = e.page_id AND t.name = e.name)
SELECT page_id, count(tn) AS n_truth, count(en) AS n_extracted, count(*) FILTER (WHERE tn IS NOT NULL AND en IS NULL) AS n_missing,
  count(en) > 0 AND count(*) FILTER (WHERE tn IS NOT NULL AND en IS NULL) > count(tn) * 0.5 AS flagged
FROM b GROUP BY page_id HAVING count(tn) > 0
""")
def _(t: Tables):
    rows = _rows(fx.linked_pages(t)).select("page_id", F.lower("name").alias("name"), "num_ratings")
    rows = rows.where((F.col("page_id") % 4 != 1) | (F.col("num_ratings") % 3 == 0))
    return lookups.missing_share(_truth(t), rows, ["page_id"])


@query("j07_state_coverage", f"""
{KEYED_SQL}, s AS (SELECT page_id, count(*) AS n_state FROM rows GROUP BY page_id),
e AS (SELECT page_id, count(*) AS n FROM rows WHERE page_id % 4 <> 1 OR is_new GROUP BY page_id)
SELECT page_id, n_state, coalesce(n, 0) AS n_entities, coalesce(n, 0) < n_state * 0.5 AS flagged FROM s LEFT JOIN e USING (page_id)
""")
def _(t: Tables):
    pages = fx.keyed_pages(t)
    state = page_state.keyed_state(F.col("html"), "__INITIAL_STATE__")
    n = pages.select("page_id", state.alias("d")).select(
        "page_id", page_state.keyed_count(F.col("d"), JUST.keyed_state).cast("bigint").alias("n_state"))
    rows = _rows(pages).where((F.col("page_id") % 4 != 1) | F.col("is_new"))
    got = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_entities"))
    return lookups.low_state_coverage(n, got, ["page_id"])


def _audit_pages(t: Tables) -> DataFrame:
    """State pages with some tiny card pages and some large empty ones, in three crawls."""
    pid = F.col("page_id")
    tiny = '<div data-qa="restaurant-card"><h3>One {x}</h3></div>'
    html = F.when(pid % 5 == 1, tiny).when(
        pid % 6 == 0, F.concat("html", F.lit("<!--"), F.repeat(F.lit("x"), F.lit(6000)))).otherwise(F.col("html"))
    crawl = F.concat(F.lit("CC-MAIN-202"), (pid % 3 + 2).cast("string"), F.lit("-05"))
    return fx.keyed_pages(t).withColumns({"html": html, "crawl_id": crawl})


_AUDIT_SQL = f"""
{KEYED_SQL}, ap AS (SELECT page_id, count(*) AS n, 'CC-MAIN-202' || CAST(page_id % 3 + 2 AS VARCHAR) || '-05' AS crawl_id,
  'https://www.just-eat.es/area/' || CAST(page_id AS VARCHAR) || '-san-juan' AS url FROM fx_customer GROUP BY page_id),
counts AS (SELECT page_id, crawl_id, url, CASE WHEN page_id % 5 = 1 THEN 1 WHEN page_id % 6 = 0 THEN 0 ELSE n END AS n_entities,
  CASE WHEN page_id % 5 = 1 THEN 'SMALL_HTML' WHEN page_id % 6 = 0 THEN 'ZERO_FROM_LISTING' END AS kind FROM ap)
"""


@query("q03_page_issues", f"""
{_AUDIT_SQL} SELECT page_id, crawl_id, 'justeat' AS platform, kind AS "check", n_entities FROM counts WHERE kind IS NOT NULL
""")
def _(t: Tables):
    pages = _audit_pages(t)
    counts = quality.page_counts(pages, _rows(pages), ["page_id"])
    return quality.page_issues(counts).select("page_id", "crawl_id", "platform", "check", "n_entities")


@query("q04_extraction_success", f"{_AUDIT_SQL} SELECT page_id, n_entities > 0 AS success, n_entities FROM counts")
def _(t: Tables):
    pages = _audit_pages(t)
    return quality.extraction_success(quality.page_counts(pages, _rows(pages), ["page_id"]), ["page_id"])


# The audit on ten pages of each crawl. Every seventh page gives its rows twice, every ninth lacks names, and
# the state of every fourth is said to hold three times what it gave.
_Q05_SQL = f"""
{_AUDIT_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY md5(url || '42'), url) AS rn,
  page_id % 5 <> 1 AND page_id % 6 <> 0 AS whole FROM counts),
p AS (SELECT * REPLACE (CASE WHEN whole AND page_id % 7 = 2 THEN 2 * n_entities ELSE n_entities END AS n_entities), n_entities AS n
  FROM s WHERE rn <= 10),
i AS (SELECT crawl_id, url AS subject, kind AS "check", n_entities::BIGINT AS n FROM p WHERE kind IS NOT NULL
  UNION ALL SELECT crawl_id, url, 'HTML_IN_NAME', 1 FROM p WHERE page_id % 5 = 1
  UNION ALL SELECT crawl_id, url, 'INTRA_PAGE_DUPES', n FROM p WHERE whole AND page_id % 7 = 2
  UNION ALL SELECT crawl_id, url, 'MISSING_NAMES', 2 FROM p WHERE page_id % 9 = 4 AND n_entities > 0
  UNION ALL SELECT crawl_id, url, 'LOW_STATE_COVERAGE', n_entities FROM p
    WHERE whole AND n_entities < 0.5 * n * CASE WHEN page_id % 4 = 1 THEN 3 ELSE 1 END)
"""


def _audit(t: Tables):
    """Page counts and issues of the sample."""
    pages, pid = _audit_pages(t), F.col("page_id")
    # The sample is drawn on slim rows; page text joins the few chosen pages afterwards.
    chosen = ranking.seeded_sample(pages.select("page_id", "platform", "crawl_id", "url"), ["platform", "crawl_id"], "url", 10)
    sample = archive.table(t.spark, pages.join(chosen.select("page_id"), "page_id", "left_semi"), "q05p")
    twice = F.when((pid % 7 == 2) & (pid % 5 != 1), 2).otherwise(1)
    rows = _rows(sample).withColumn("_t", F.explode(F.sequence(F.lit(1), twice))).drop("_t")
    # The few entities serve several reports; a written table keeps them from being extracted each time.
    rows = archive.table(t.spark, rows, "q05")
    counts = quality.page_counts(sample, rows, ["page_id"])
    truth = sample.where(pid % 9 == 4).select("page_id", F.explode(F.array(F.lit("absent a"), F.lit("absent b"))).alias("name"))
    state = page_state.keyed_state(F.col("html"), "__INITIAL_STATE__")
    times = F.when(pid % 4 == 1, 3).otherwise(1)
    held = sample.select("page_id", state.alias("d")).select(
        "page_id", (page_state.keyed_count(F.col("d"), JUST.keyed_state) * times).cast("bigint").alias("n_state"))
    return counts, audit_step.audit_issues(counts, rows, truth, held, ["page_id"])


@query("q05_audit_lines", f"""
{_Q05_SQL}, k AS (SELECT crawl_id, count(*) AS k FROM i GROUP BY crawl_id)
SELECT 'justeat' AS platform, crawl_id, count(*) AS n_pages, sum(n_entities)::BIGINT AS n_entities,
  coalesce(max(k), 0) AS n_issues, CASE WHEN coalesce(max(k), 0) = 0 THEN 'OK' ELSE CAST(max(k) AS VARCHAR) || ' issues' END AS status
FROM p LEFT JOIN k USING (crawl_id) GROUP BY crawl_id
""")
def _(t: Tables):
    counts, issues = _audit(t)
    return quality.audit_lines(counts, issues)


@query("q05_audit_issues", f"""{_Q05_SQL} SELECT "check", 'justeat' AS platform, crawl_id, subject, n FROM i""")
def _(t: Tables):
    return _audit(t)[1].select("check", "platform", "crawl_id", "subject", "n")


@query("q06_audit_overall", f"""
{_Q05_SQL} SELECT "check", crawl_id AS subject, count(*) AS n FROM i GROUP BY ALL
""")
def _(t: Tables):
    issues = _audit(t)[1].groupBy("check", F.col("crawl_id").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    return quality.overall(issues)


def _placed(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Pages by place and the sidecars of two thirds of them."""
    pid = F.col("page_id")
    ts = F.concat(F.lit("T"), pid.cast("string"))
    # Every stem is used in many crawls and folders.
    stem = F.concat(F.lit("T"), (pid % 3).cast("string"), F.when(pid % 2 == 0, "_x").otherwise(""))
    key = F.concat(F.lit("d"), pid.cast("string"), F.lit("/"), stem)
    df = fx.index(t).select(
        "page_id", "url", F.col("crawl").alias("c"), F.col("lang").alias("p"), key.alias("key"), ts.alias("ts"),
        F.col("lang").alias("path_platform"), F.col("crawl").alias("path_crawl"))
    side = df.where(pid % 3 != 0).select(
        *lookups.PLACE, "url", F.col("ts").alias("timestamp"), F.col("c").alias("crawl_id"), F.col("p").alias("platform"))
    return df.select(*lookups.PLACE), side


_J01_COLS = ["url", "timestamp", "crawl_id", "platform", "has_sidecar"]
_J01_SQL = f"""
WITH {INDEX_SQL} SELECT CASE WHEN page_id % 3 = 0 THEN '' ELSE url END AS url,
  CASE WHEN page_id % 3 <> 0 THEN 'T' || CAST(page_id AS VARCHAR) WHEN page_id % 2 = 0 THEN 'T0' ELSE '' END AS timestamp,
  crawl AS crawl_id, lang AS platform, page_id % 3 <> 0 AS has_sidecar FROM fx_index
"""


@query("j01_page_metadata", _J01_SQL)
def _(t: Tables):
    return lookups.with_metadata(*_placed(t)).select(*_J01_COLS)


@query("j01_bucketed_metadata", _J01_SQL)
def _(t: Tables):
    # Both tables lie in the same buckets of the place, so the join reads them side by side.
    work = scratch_dir(t.spark, "j01b")
    pages, side = (layout.bucketed(df, f"{work}/{name}", lookups.PLACE, 8) for name, df in zip(("pages", "side"), _placed(t)))
    return lookups.with_metadata(pages, side).select(*_J01_COLS)


@query("j02_sidecar_counts", f"""
WITH {INDEX_SQL} SELECT lang AS platform, crawl AS crawl_id, count(*) FILTER (WHERE page_id % 3 <> 0) AS matched,
  count(*) FILTER (WHERE page_id % 3 = 0) AS missing FROM fx_index GROUP BY ALL
""")
def _(t: Tables):
    df = fx.index(t).select("page_id", F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"))
    return lookups.sidecar_counts(df, df.where(F.col("page_id") % 3 != 0), ["page_id"])


@query("j03_reconcile", f"""
WITH {INDEX_SQL}, g AS (SELECT lang AS platform, crawl AS crawl_id, url_path, page_id FROM fx_index),
i AS (SELECT platform, crawl_id, count(*) AS index_rows FROM g WHERE platform <> 'fr' AND NOT (platform = 'de' AND page_id % 4 = 0) GROUP BY ALL),
h AS (SELECT platform, crawl_id, count(*) AS html_rows, count(DISTINCT url_path) AS unique_urls FROM g
  WHERE NOT (platform = 'es' AND page_id % 5 = 0) GROUP BY ALL)
SELECT platform, crawl_id, index_rows, html_rows, unique_urls, CASE WHEN index_rows IS NULL THEN 'NO INDEX'
  WHEN html_rows = index_rows THEN 'OK' WHEN html_rows > index_rows THEN '+' || (html_rows - index_rows) || ' (' ||
  (html_rows - unique_urls) || ' dupes)' ELSE 'MISSING ' || (index_rows - html_rows) END AS status
FROM h LEFT JOIN i USING (platform, crawl_id)
""")
def _(t: Tables):
    df = fx.index(t).select(
        "page_id", F.col("lang").alias("platform"), F.col("crawl").alias("crawl_id"), F.col("url_path").alias("url"))
    pid, p = F.col("page_id"), F.col("platform")
    return lookups.reconcile(
        df.where((p != "fr") & ~((p == "de") & (pid % 4 == 0))), df.where(~((p == "es") & (pid % 5 == 0))))


@query("p03_extract_summary", f"""
{LINKED_SQL} SELECT 'CC-MAIN-2023-06' AS crawl_id, 'Just Eat' AS platform, 'San Juan' AS city, count(*) AS restaurant_count FROM rows
""")
def _(t: Tables):
    return reports.summary_table(ex.entity_table(fx.linked_pages(t), (JUST,))).select(*SUMMARY_COLUMNS)
