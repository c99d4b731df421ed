"""Whole pages through the extraction plan, with broken and mixed input."""

import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import nodes
from gleaner.plans.extract_step import entity_table, extract_entities, extraction_errors
from gleaner.profiles import PROFILES
from gleaner.schema import PAGE

AREA = "https://www.just-eat.es/area/28006-madrid"
CITY = "https://www.ubereats.com/es/city/leon"
LIST = "https://glovoapp.com/es/es/madrid/restaurantes_1/pizza_34701/"


def pages(spark, *rows):
    cells = [(url, ts, 200, "text/html", "CC-MAIN-2023-06", platform, html) for platform, url, ts, html in rows]
    return spark.createDataFrame(cells, PAGE)


def extract(spark, platform, url, html):
    known = tuple(p for p in PROFILES if p.key == platform) or PROFILES
    df = extract_entities(pages(spark, (platform, url, "20230105120000", html)), known)
    return [r.asDict() for r in df.orderBy("branch", "pos").collect()]


def ld(doc):
    return f'<script type="application/ld+json">{json.dumps(doc)}</script>'


def names(rows):
    return [r["name"] for r in rows]


def test_bad_value_costs_a_cell_not_the_page(spark):
    doc = [{"@type": "Restaurant", "name": "A", "aggregateRating": {"ratingValue": "4,5", "ratingCount": "x"}},
           {"@type": "Restaurant", "name": "B", "aggregateRating": {"ratingValue": "0", "reviewCount": 3}}, 7, "s", None]
    rows = extract(spark, "justeat", AREA, ld(doc))
    assert names(rows) == ["A", "B"]
    assert [r["rating"] for r in rows] == [None, None] and [r["num_ratings"] for r in rows] == [None, 3]


def test_main_entity_list_is_ignored(spark):
    assert extract(spark, "justeat", AREA, ld({"@type": "SearchResultsPage", "mainEntity": [1]})) == []


def test_percent_rating_and_generic_name(spark):
    doc = [{"@type": "Store", "name": "Shop", "aggregateRating": {"ratingValue": "95%", "ratingCount": "1,234"}},
           {"@type": "Store", "name": "Glovo"}]
    rows = extract(spark, "glovo", "https://glovoapp.com/es/es/madrid/x-mad/", ld(doc))
    assert names(rows) == ["Shop"] and rows[0]["rating"] == 4.75 and rows[0]["num_ratings"] == 1234


def test_excluded_path_gives_nothing(spark):
    card = '<div data-test-id="category-store-card"><h3>Uno</h3></div>'
    assert extract(spark, "glovo", "https://glovoapp.com/es/es/madrid/Supermercados_1/", card) == []
    assert names(extract(spark, "glovo", LIST, card)) == ["Uno"]


def test_listing_page_prefers_cards_over_linked_data(spark):
    html = ld({"@type": "Restaurant", "name": "Json"}) + (
        '<div data-test-id="category-store-card"><h3>Card</h3><p class="rating">81% (1.2k)</p></div>'
        '<div data-test-id="category-store-card"><h3>card</h3></div>'
        '<div data-test-id="category-store-card"><h3>Ver todo</h3></div>')
    rows = extract(spark, "glovo", LIST, html)
    assert names(rows) == ["Card"] and rows[0]["rating"] == 4.05 and rows[0]["num_ratings"] == 1200
    assert rows[0]["food_type"] == "Pizza" and rows[0]["city"] == "Madrid"


def test_linked_data_and_state_add_up_on_city_pages_only(spark):
    html = ld({"@type": "Restaurant", "name": "L"}) + '<script>{"stores": [{"title": "S"}]}</script>'
    assert names(extract(spark, "ubereats", CITY, html)) == ["L", "S"]
    assert names(extract(spark, "ubereats", "https://www.ubereats.com/es/store/x", html)) == ["L"]


def test_nested_array_in_located_state_is_skipped(spark):
    html = '<script>{"stores": [{"title": "S", "tags": ["a"]}]}</script>'
    assert extract(spark, "ubereats", CITY, html) == []


def test_locality_becomes_city(spark):
    doc = {"@type": "Restaurant", "name": "A", "address": {"addressLocality": "Leon, Spain"}}
    row = extract(spark, "ubereats", "https://www.ubereats.com/es/store/x", ld(doc))[0]
    assert row["city"] == "Leon" and row["address"] == "Leon, Spain"


def _state(names):
    return {"restaurants": {str(i): {"name": n} for i, n in enumerate(names)}}


def test_state_wins_and_is_decoded(spark):
    text = json.dumps(_state(['Café "Ñ" 😀', "B\\n"]), ensure_ascii=True).replace("\\", "\\\\").replace('"', "\\u0022")
    html = f'<script>window["__INITIAL_STATE__"] = JSON.parse("{text}");</script>' + ld({"@type": "Restaurant", "name": "L"})
    assert names(extract(spark, "justeat", AREA, html)) == ['Café "Ñ" 😀', "B\\n"]


def test_truncated_state_falls_back(spark):
    html = 'window["__INITIAL_STATE__"] = JSON.parse("{\\u0022restaurants' + ld({"@type": "Restaurant", "name": "L"})
    assert names(extract(spark, "justeat", AREA, html)) == ["L"]


def test_escapes_other_than_json_ones(spark):
    html = "JSON.parse(\"x\") window.__INITIAL_STATE__ = JSON.parse(\"{\\u0022restaurants\\u0022:{\\u00221\\u0022:{\\u0022name\\u0022:\\u0022L\\'H \\xd1\\u0022}}}\")"
    assert names(extract(spark, "justeat", AREA, html)) == ["L'H Ñ"]


def test_comments_and_code_are_not_content(spark):
    html = ('<!-- <script type="application/ld+json">{"@type":"Restaurant","name":"no"}</script> -->'
            '<div data-qa="restaurant-card"><h3>Name<script>var a = "x";</script></h3></div>')
    assert names(extract(spark, "justeat", AREA, html)) == ["Name"]


def test_card_fallbacks(spark):
    html = ('<a href="/r/1" title="From title"><section data-restaurant-id="1"><i>x</i></section></a>'
            '<section data-restaurant-id="2"><h2>Two</h2><div data-qa="restaurant-tags"><b>Nuevo</b><b>Thai</b></div>'
            '<a href="http://o.example/2">l</a></section>')
    rows = extract(spark, "justeat", AREA, html)
    assert names(rows) == ["From title", "Two"]
    assert [r["restaurant_url"] for r in rows] == ["https://www.just-eat.es/r/1", "http://o.example/2"]
    assert rows[1]["food_type"] == "Thai"


def test_first_selector_with_usable_cards_wins(spark):
    html = '<a data-testid="store-card"></a><a href="/store/1" aria-label="Label"></a><div class="StoreCard"><h3>No</h3></div>'
    assert names(extract(spark, "ubereats", CITY, html)) == ["Label"]


def test_unknown_platform_and_empty_page(spark):
    assert extract(spark, "nobody", AREA, ld({"@type": "Restaurant", "name": "A"})) == []
    assert extract(spark, "justeat", AREA, "") == []


def test_duplicates_are_settled_the_same_way_every_time(spark):
    doc = {"@type": "Restaurant", "name": "A", "url": "https://x.example/1"}
    rows = [("justeat", f"{AREA}-{i}", "20230105", ld({**doc, "priceRange": str(i)})) for i in range(20)]
    for n in (1, 7):
        kept = entity_table(pages(spark, *rows).repartition(n), PROFILES[2:]).collect()
        assert [r["price_range"] for r in kept] == ["0"]


@pytest.mark.parametrize("selector,expected", [
    ("a.x", 1), ("a.x, p", 2), ('[class*="ab"]:not([class*="abc"])', 1), ("a[href]", 1), ('[href^="/q"]', 1), ('[href$="r"]', 1), ("b", 0)])
def test_selectors(spark, selector, expected):
    html = '<a class="y x" href="/q/r">1</a><p class="abc">2<i class="abd"><br>'
    df = spark.createDataFrame([(html,)], "h string").select(nodes.parse_nodes(F.col("h")).alias("n"))
    assert df.select(F.size(nodes.select(F.col("n"), selector))).first()[0] == expected


def test_selector_bits_agree_with_expressions(spark):
    """The bits of the parser's pass and the expression of a selector name the same nodes, beyond 63 selectors too."""
    asked = ["a.x", "a.x, p", '[class*="ab"]:not([class*="abc"])', "a[href]", '[href^="/q"]', '[href$="r"]', "b", ":not([href])",
             '[class="y x"]', '[class*="y x"]', "[title]", ':not([title])', "p.abc, a[href], i", '[data-a=""]', ".x.y"]
    table = nodes.SelectorTable([*asked, *[f"t{i}" for i in range(80)]])
    assert len(table.numbered) == 63 and table.mask("t79") is None and table.mask("t79, b") is None and table.mask("b")
    html = ['<a class=" y  x" href="/q/r">1</a><p class="abc">2<i class="abd"><br><t79><b title>', "", None, "text only",
            '<script class="x">a</script><a href="/q" class="xx" data-a>z</a><a class="x y" title="t"><t3 href=r>' * 3]
    df = spark.createDataFrame([(h,) for h in html], "h string").select(
        nodes.parse_nodes(F.col("h"), None, table).alias("n"))
    for s in [*asked, "t3", "t79", "t3, t79"]:
        for r in df.select(nodes.select(F.col("n"), s, table).alias("a"), nodes.select(F.col("n"), s).alias("b")).collect():
            assert r["a"] == r["b"], s


def test_selectors_of_a_profile_are_settled_by_the_parser(spark):
    """Nodes carry no attribute that only selectors test, and the plan holds one mask test per selector."""
    from gleaner.operators import cards

    for source in (p for p in PROFILES if p.cards):
        table = cards.selector_table(source)
        assert cards.kept_attrs(source, table) == cards.field_attrs(source)
        assert cards.kept_attrs(source) >= cards.field_attrs(source) | {"class"}
        columns = str(cards.card_columns(source.cards, "_nodes", "_cards", table))
        assert "hits" in columns and "contains" not in columns


def test_unsupported_selector_is_refused():
    with pytest.raises(ValueError):
        nodes._compound("div > p")


def test_node_tree_tolerates_broken_markup(spark):
    html = "<div><p>a<b>b</div>c</i><span>d"
    df = spark.createDataFrame([(html,)], "h string").select(nodes.parse_nodes(F.col("h")).alias("n"))
    n = F.col("n")
    got = df.select(nodes.text_of(n, nodes.select_one(n, "div")), nodes.text_of(n, nodes.select_one(n, "span"))).first()
    assert tuple(got) == ("ab", "d")
    assert df.select(nodes.text_of(n, nodes.select_one(n, "table"))).first()[0] is None


def test_profiles_cover_the_known_sources():
    assert [p.key for p in PROFILES] == ["glovo", "ubereats", "justeat"]


def test_registered_sources_take_part_in_every_step(spark, tmp_path):
    from gleaner.plans import steps
    from gleaner.profiles import all_profiles, forget_profile, register_profile
    from gleaner.schema import PAGE

    def rows(html, page):
        if html == "bad":
            raise KeyError("x")
        for word in html.split():
            yield {"name": word, "is_new": "yes", "rating": "x", "restaurant_url": None if word == "a" else f"{page['url']}#{word}"}
        if html == "wrong":
            yield {"colour": 1}

    source = register_profile("words", rows, name="Words")
    try:
        with pytest.raises(ValueError):
            register_profile("words", rows)
        with pytest.raises(ValueError):
            register_profile("glovo", rows)
        assert source in all_profiles()
        pages = spark.createDataFrame(
            [(f"u{i}", "20230105", 200, "text/html", "c", p, h) for i, (p, h) in enumerate(
                [("words", "a b"), ("words", "bad"), ("words", None), ("words", "wrong"), ("words", ""), ("other", "a b"), ("words", "a")])], PAGE)
        summary = steps.extract_step(spark, pages, str(tmp_path / "e")).collect()
        assert [tuple(r) for r in summary] == [("c", "Words", "", 2)]  # "a" of two pages is one entity without an address
        pages = pages.withColumn("page", F.col("url"))
        found = extract_entities(pages, carry=("page",)).collect()
        assert sorted((r["page"], r["name"], r["pos"], r["branch"], r["is_new"], r["rating"]) for r in found) == [
            ("u0", "a", 0, "code", False, None), ("u0", "b", 1, "code", False, None), ("u6", "a", 0, "code", False, None)]
        assert sorted((r["page"], r["error"].split(":")[0]) for r in extraction_errors(pages, carry=("page",)).collect()) == [
            ("u1", "KeyError"), ("u3", "ValueError")]
    finally:
        forget_profile("words")
    assert source not in all_profiles()


def test_rows_of_a_function_leave_in_bounded_batches(spark, monkeypatch):
    from gleaner.plans import code_step
    from gleaner.profiles import SourceProfile
    from gleaner.schema import PAGE

    monkeypatch.setattr(code_step, "MAX_ROWS", 3)
    source = SourceProfile(key="k", name="K", domain="", base_url="", rows=lambda html, page: ({"name": f"n{i}"} for i in range(10)))
    pages = spark.createDataFrame([("u", "", 200, "", "c", "k", "x"), ("v", "", 200, "", "c", "k", "x")], PAGE)
    assert code_step.code_rows(pages, source, ("url",)).groupBy("url").count().collect()[0][1] == 10
