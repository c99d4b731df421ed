"""Column functions on awkward values."""

import html

import pytest
from pyspark.sql import functions as F

from gleaner.functions import numbers, text, urls
from gleaner.profiles import profile


def value(spark, build, *cells):
    df = spark.createDataFrame([tuple(cells)], ", ".join(f"c{i} string" for i in range(len(cells))))
    return df.select(build(*[F.col(f"c{i}") for i in range(len(cells))])).first()[0]


@pytest.mark.parametrize("raw", [
    "a &amp; b", "&#39;x&#x1F600;", "caf&eacute", "&copy2024", "&unknown; & ;", "&#128;", "&#0;", "&#xD800;", "&#x110000;",
    "&notit;", "&amp;amp;", "&lt&gt", "none", "", "&", "&#", "&#x", "&CounterClockwiseContourIntegral;", "&#1;", "a&b&c",
    "&#99999999999999999999;"])
def test_unescape_is_html_unescape(spark, raw):
    assert value(spark, text.unescape_entities, raw) == html.unescape(raw)


def test_unescape_null(spark):
    assert value(spark, text.unescape_entities, None) is None


@pytest.mark.parametrize("raw", ["l'hospitalet 2a de_llob", "SAN JUAN", "málaga-ñu", "", "x1y"])
def test_title_is_str_title(spark, raw):
    assert value(spark, text.title_case, raw) == raw.title()


@pytest.mark.parametrize("raw", ["  a  \t b\n", "", " x "])
def test_squash_is_split_join(spark, raw):
    assert value(spark, text.squash_space, raw) == " ".join(raw.split())


@pytest.mark.parametrize("raw,expected", [
    ("4,5", 4.5), ("4.4 (1)", 4.4), ("n 7", 7.0), ("", None), ("x", None), (None, None)])
def test_first_number(spark, raw, expected):
    assert value(spark, numbers.first_number, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("(1.2k)", 1200), ("500+", 500), ("(1234)", 1234), ("1,234", 1), ("1,2K", 1200), ("k", None), ("", None), ("4.35k", 4350)])
def test_rating_count(spark, raw, expected):
    assert value(spark, numbers.rating_count, raw) == expected


def test_rating_count_thousands(spark):
    assert value(spark, lambda c: numbers.rating_count(c, thousands=True), "1,234") == 1234


@pytest.mark.parametrize("raw,expected", [
    ("2023-06-01T08:32:22", "2023-06-01"), ("2023-06-01 08:00:00", "2023-06-01"), ("20230601083222", "2023-06-01"),
    ("2023-6-1", "2023-06-01"), ("99999999", "99999999"), ("", ""), ("2023", "2023"), ("not-a-date-at-all", "not-a-date")])
def test_crawl_date_text(spark, raw, expected):
    assert value(spark, numbers.crawl_date_text, raw) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://x.example/a%20b/c?d=1", "a_b/c"), ("https://x.example", "index"), ("https://x.example/", "index"),
    ("https://x.example/__a__b_/%C3%A9+", "a_b/é"), ("https://x.example/a//b", "a/b"), ("https://x.example/p%3Fq/z", "p")])
def test_storage_key(spark, url, expected):
    assert value(spark, urls.storage_key, url) == expected


@pytest.mark.parametrize("key,url,expected", [
    ("glovo", "https://glovoapp.com/es/es/san-sebastian_2/restaurantes_1/", "San Sebastian"),
    ("glovo", "https://glovoapp.com/es/es/comida-a-domicilio/", None),
    ("ubereats", "https://www.ubereats.com/es/city/m%C3%A1laga-es-an", "Málaga"),
    ("ubereats", "https://www.ubereats.com/es/store/x", None),
    ("justeat", "https://www.just-eat.es/area/28006-madrid", "Madrid"),
    ("justeat", "https://www.just-eat.es/restaurants-foo", None),
    ("justeat", "https://www.just-eat.es/blog", None),
    ("justeat", "https://www.just-eat.es/leon", "Leon")])
def test_city(spark, key, url, expected):
    assert value(spark, lambda c: urls.city_from_url(c, profile(key).city_steps), url) == expected


def test_percent_decode_keeps_plus_and_broken_escapes(spark):
    assert value(spark, urls.percent_decode, "a+b%20c") == "a+b c"
    assert value(spark, urls.percent_decode, "100%-x") == "100%-x"


def test_join_present_skips_null_and_empty(spark):
    assert value(spark, lambda a, b, c: text.join_present([a, b, c]), "x", "", None) == "x"


def test_unknown_profile():
    with pytest.raises(ValueError):
        profile("nobody")
