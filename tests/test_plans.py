"""Physical plans: what reaches the scan, what is shuffled, what is limited early."""

import re

import pytest
from pyspark.sql import functions as F

from gleaner.operators import ranking, reports, resolve
from gleaner.plans.extract_step import entity_table, extract_entities
from gleaner.sources import index as ix
from gleaner.sources import page_store
from workload import fixtures as fx
from workload import table_queries  # noqa: F401  (registers its queries)
from workload.registry import QUERIES, Tables


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    for key in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
        spark.conf.set(key, "100000")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index_path(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "t")
    ix.write_index(fx.index(Tables(spark, sf)), path)
    return path


@pytest.fixture(scope="module")
def page_path(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "t")
    t = Tables(spark, sf)
    page_store.write_pages(resolve.bag_union(fx.linked_pages(t), fx.card_pages(t), fx.script_pages(t)), path)
    return path


def test_index_scan_prunes_and_pushes(spark, index_path):
    df = ix.source_rows(ix.read_index(spark, index_path), ["CC-MAIN-2023-05"], fx.LANGUAGES)
    text = plan(df)
    partition = re.search(r"PartitionFilters: (.*?), PushedFilters", text).group(1)
    assert "crawl" in partition and "subset" in partition
    pushed = re.search(r"PushedFilters: (.*?), ReadSchema", text).group(1)
    for part in ("StringStartsWith(url_path", "EqualTo(url_host_registered_domain", "EqualTo(fetch_status,200)", "Or("):
        assert part in pushed
    assert "Exchange" not in text


def test_group_limits_run_before_the_shuffle(spark, sf):
    t = Tables(spark, sf)
    for df in (
        ranking.first_n(fx.index(t), ["crawl", "lang"], ["url"], 5),
        resolve.drop_duplicates_first(fx.listing(t), fx.LISTING_ORDER),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit") >= 2
        assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["d01_deduplicate", "d02_deduplicate_trimmed"])
def test_deduplication_makes_cells_for_the_rows_that_stay(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "x.example/o/" in text
    assert text.rindex("x.example/o/") < text.index("Window")


def test_digests_keep_the_parts_of_a_key_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), ("a", None), ("a", ""), (None, "a"), ("", "a"), ("a:1:b", "c"), (None, None), ("é", "e"), ("ab", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    digests = df.select(resolve.key_digest([F.col("x"), F.col("y")])).collect()
    assert all(len(r[0]) == 16 for r in digests)
    assert len({bytes(r[0]) for r in digests}) == len(set(rows))


def test_top_groups_is_a_take_ordered(spark, sf):
    assert "TakeOrderedAndProject" in plan(ranking.top_groups(fx.listing(Tables(spark, sf)), "city", 10))


def test_summary_is_one_aggregation(spark, sf):
    text = plan(reports.summary_counts(fx.listing(Tables(spark, sf))))
    assert text.count("Expand") == 1


def test_extraction_never_shuffles_pages(spark, page_path):
    text = plan(extract_entities(page_store.read_pages(spark, page_path)))
    assert "Exchange" not in text and "BatchEvalPython" not in text
    assert text.count("ArrowEvalPython") == 3
    # Each source reads only its own partitions.
    assert len(re.findall(r"PartitionFilters: \[[^\]]*platform", text)) == 3


def test_only_entity_rows_are_shuffled_for_deduplication(spark, page_path):
    df = entity_table(page_store.read_pages(spark, page_path))
    for line in plan(df).splitlines():
        if "Exchange" in line:
            assert "html" not in line
    assert df.count() > 0


def test_page_counts_drop_the_text_before_the_join(spark, page_path):
    from gleaner.operators.quality import page_counts

    pages = page_store.read_pages(spark, page_path)
    text = plan(page_counts(pages, pages.select("url", "platform", "crawl_id"), ["url"]))
    for line in text.splitlines():
        if "Join" in line or "Exchange" in line:
            assert "html" not in line


def test_no_python_in_json_branches(spark, sf):
    from gleaner.operators import linked_data, scripts

    df = fx.linked_pages(Tables(spark, sf)).select(
        linked_data.truth_names(scripts.script_elements(F.col("html"))).alias("n"))
    assert "EvalPython" not in plan(df)


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    from gleaner.operators import lookups
    from gleaner.sources import layout

    rows = [(f"p{i % 3}", f"c{i % 5}", f"k{i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "path_platform string, path_crawl string, key string")
    side = pages.limit(120).selectExpr("*", "'u' AS url", "'t' AS timestamp", "path_crawl AS crawl_id", "path_platform AS platform")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = layout.bucketed(pages, str(tmp_path / "a"), lookups.PLACE, 4)
        b = layout.bucketed(side, str(tmp_path / "b"), lookups.PLACE, 4)
        joined = lookups.with_metadata(a, b)
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert "Exchange" in plan(lookups.with_metadata(pages, side))
        assert joined.where("has_sidecar").count() == 120 and joined.count() == 200
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_domain_scan_opens_the_files_of_its_range(spark, sf, tmp_path):
    from gleaner.sources import layout

    index, path = fx.index(Tables(spark, sf)), str(tmp_path / "i")
    layout.write_clustered_index(index, path, file_rows=5)
    whole = spark.read.parquet(f"{path}/rows")
    domains = [r[0] for r in index.select("url_host_registered_domain").distinct().collect()]
    for domain in domains:
        found = layout.read_clustered_index(spark, path, [domain])
        assert found.count() == index.where(F.col("url_host_registered_domain") == domain).count()
        assert len(found.inputFiles()) < len(whole.inputFiles())
    assert layout.read_clustered_index(spark, path, ["zzz"]).count() == 0
    with pytest.raises(ValueError):
        layout.read_clustered_index(spark, path, ["a"], ["x'; --"])
    assert layout.bucket_count(0) == 1 and layout.bucket_count(1 << 30) == 8 and layout.bucket_count((1 << 30) + 1) == 16


def test_most_frequent_keys_by_bounded_summaries(spark):
    import random
    from collections import Counter

    from gleaner.operators import heavy

    rnd = random.Random(3)
    for share, capacity in ((0.9, 20), (0.5, 50), (0.0, 10), (0.3, 10 ** 6)):
        keys = [None if rnd.random() < 0.1 else f"h{int(rnd.paretovariate(1)) % 9}" if rnd.random() < share else f"t{rnd.randrange(3000)}"
                for _ in range(6000)]
        df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
        top = heavy.top_keys(df, "k", 6, capacity)
        want = sorted(Counter(keys).items(), key=lambda kn: (-kn[1], kn[0] is not None, kn[0] or ""))[:6]
        assert [(r["k"], r["n"], r["rn"]) for r in top.rows.orderBy("rn").collect()] == [(k, n, i + 1) for i, (k, n) in enumerate(want)]
        assert top.proof["method"] in ("candidates", "full")
        if share == 0.9:
            assert top.proof["method"] == "candidates" and top.proof["lost"] > 0 and top.proof["candidates"] < 60
    assert heavy.top_keys(df.limit(0), "k", 3).rows.collect() == []
