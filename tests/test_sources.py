"""Sources and sinks on small files."""

import gzip
import random
import zlib
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gleaner import session
from gleaner.operators import lookups
from gleaner.plans import steps
from gleaner.plans.extract_step import entity_table
from gleaner.schema import ENTITY_COLUMNS, POINTER
from gleaner.sources import entity_store, gzip_lines, index, page_store, slices, warc
from gleaner.streaming.incremental import watch_pages
from workload import archive
from workload import fixtures as fx
from workload.registry import Tables


def test_split_response():
    head = b"WARC/1.0\r\n\r\n"
    assert warc.split_response(head + b"HTTP/1.1 200\r\nA: b\r\n\r\nbody\r\n\r\nmore") == b"body\r\n\r\nmore"
    assert warc.split_response(head + b"HTTP/1.1 200\nA: b\n\nbody") == b"body"
    assert warc.split_response(head + b"HTTP/1.1 200") is None
    assert warc.split_response(b"nothing") is None


def test_ranges_read_in_any_order_and_failures_are_reported(spark, tmp_path):
    members = [gzip.compress(b"W\r\n\r\nH\r\n\r\n" + f"page {i}".encode()) for i in range(50)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    offsets = [sum(map(len, members[:i])) for i in range(50)]
    rows = [(f"u{i}", "t", 200, "text/html", "a.warc.gz", offsets[i], len(members[i]), "c", "pq"[i % 2]) for i in range(50)]
    rows += [("gone", "t", 200, "text/html", "b.warc.gz", 0, 10, "c", "p"), ("bad", "t", 200, "text/html", "a.warc.gz", 5, 10, "c", "p"),
             ("none", "t", 200, "text/html", "", 5, 10, "c", "p"), ("zero", "t", 200, "text/html", "a.warc.gz", 5, 0, "c", "p")]
    got = warc.read_ranges(spark.createDataFrame(rows, POINTER), str(tmp_path)).collect()
    assert {r["url"]: r["body"] for r in got if r["body"]} == {f"u{i}": f"page {i}".encode() for i in range(50)}
    assert {r["url"] for r in got if r["error"]} == {"gone", "bad"}


def test_latin1_fallback_and_replacement(spark):
    df = spark.createDataFrame([(b"caf\xe9",), ("café".encode(),)], "b binary")
    assert [r[0] for r in df.select(warc.decode_body(F.col("b"))).collect()] == ["café", "café"]
    assert [r[0] for r in df.select(warc.decode_replacing(F.col("b"))).collect()] == ["caf�", "café"]


def test_cdx_keeps_well_formed_lines_of_the_domain(spark):
    lines = [('a.example)/x 2023 {"url":"u","status":"200"}',), ("a.example)/x 2023",), ("a.example)/x 2023 {bad",),
             ('com,b)/ 2023 {"url":"v"}',), ('example,a)/ 2023 {"url":"w"}',)]
    df = spark.createDataFrame(lines, "value string")
    assert [r["url"] for r in index.parse_cdx(df, "a.example").collect()] == ["u"]
    assert {r["url"] for r in index.parse_cdx(df, "a.example", reversed_key=True).collect()} == {"u", "w"}


def test_empty_documents_flatten_to_nothing(spark):
    docs = spark.createDataFrame([('{"c":{"p":[]}}',), ("{}",), ("not json",), ('{"c":{"p":[{"url":"u"}]}}',)], "value string")
    assert [r["url"] for r in index.flatten_document(docs).collect()] == ["u"]


def test_crawl_ids_are_checked(spark, sf):
    with pytest.raises(ValueError):
        index.source_rows(fx.index(Tables(spark, sf)), ["x'; --"])


def test_reload_replaces_only_its_slices(spark, sf, tmp_path):
    path = str(tmp_path / "e")
    df = fx.listing_entities(Tables(spark, sf)).select(*ENTITY_COLUMNS)
    entity_store.write_entities(df, path)
    before = df.count()
    one = df.where(F.col("crawl_id") == "CC-MAIN-1998").limit(3)
    entity_store.write_entities(one, path)
    kept = entity_store.read_entities(spark, path).groupBy("crawl_id").count().collect()
    counts = {r["crawl_id"]: r["count"] for r in kept}
    platforms = {r["platform"] for r in one.select("platform").distinct().collect()}
    replaced = df.where((F.col("crawl_id") == "CC-MAIN-1998") & F.col("platform").isin(*platforms)).count()
    assert sum(counts.values()) == before - replaced + 3


def test_null_keys_become_unknown(spark, tmp_path, sf):
    df = fx.listing_entities(Tables(spark, sf)).limit(5).withColumn("platform", F.lit(None).cast("string"))
    entity_store.write_entities(df, str(tmp_path / "e"))
    got = entity_store.read_entities(spark, str(tmp_path / "e"))
    assert [r[0] for r in got.select("platform").distinct().collect()] == ["unknown"]


class _Session:
    """Stands for a session on a cluster, with or without the shared folder."""

    def __init__(self, **conf):
        self.conf, self.sparkContext = conf, SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)


def test_scratch_folder_follows_the_session():
    shared = _Session(**{"spark.checkpoint.dir": "hdfs://shared/area/"})
    assert session.scratch_dir(shared, "x").startswith("hdfs://shared/area/x-")
    with pytest.raises(ValueError):
        session.scratch_dir(_Session(), "x")


def test_incremental_run_equals_a_full_run(spark, sf, tmp_path):
    pages, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    df = fx.linked_pages(Tables(spark, sf)).drop("page_id")

    def arrive(crawl, rows, mode="append"):
        rows.withColumn("crawl_id", F.lit(crawl)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
            "platform", "crawl_id").parquet(page_store.place(pages))
        watch_pages(spark, pages, out, state).awaitTermination()

    for crawl in ("CC-MAIN-2023-06", "CC-MAIN-2023-14"):
        arrive(crawl, df)
    full = entity_table(page_store.read_pages(spark, pages))
    got = entity_store.read_published(spark, out)
    assert got.count() == full.count() and got.select("crawl_id").distinct().count() == 2
    # The pages of one slice come again, without any entity.
    arrive("CC-MAIN-2023-14", df.withColumn("html", F.lit("<html></html>")), "overwrite")
    got = entity_store.read_published(spark, out)
    assert [r[0] for r in got.select("crawl_id").distinct().collect()] == ["CC-MAIN-2023-06"]
    empty = slices.published(spark, out).where("crawl_id = 'CC-MAIN-2023-14'").collect()
    assert [(r["platform"], r["n_rows"]) for r in empty] == [("Just Eat", 0)]


def test_extract_step_empties_slices(spark, sf, tmp_path):
    out, df = str(tmp_path / "e"), fx.linked_pages(Tables(spark, sf)).drop("page_id")
    assert steps.extract_step(spark, df, out).count() > 0
    other = df.withColumn("crawl_id", F.lit("CC-MAIN-2023-14"))
    steps.extract_step(spark, other, out)
    left = steps.extract_step(spark, df.withColumn("html", F.lit(None).cast("string")), out)
    assert {r["crawl_id"] for r in left.collect()} == {"CC-MAIN-2023-14"}


def test_what_a_broken_run_left_is_not_read(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "crawl_id string, platform string, v int"
    names = spark.createDataFrame([("c", "p"), ("c", "q/1=%"), ("d", "p")], "crawl_id string, platform string")

    def rows(*values):
        return spark.createDataFrame([("c", "p", v) for v in values] + [("c", "q/1=%", v + 100) for v in values], schema)

    def seen(only=None):
        return sorted(r["v"] for r in slices.read(spark, path, rows(1).schema, only=only).collect())

    assert seen() == [] and slices.published(spark, path).count() == 0
    first = slices.publish(rows(1, 2), path, names)
    slices.stage(rows(7), path, slices.new_version())  # no manifest row: a crash
    assert seen() == [1, 2, 101, 102]
    second = slices.publish(rows(3).where("platform = 'p'"), path, names.where("platform = 'p'"))
    assert seen() == [3, 101, 102]
    assert seen(F.col("platform") == "p") == [3]
    slices.publish(rows().limit(0), path, names.where("crawl_id = 'c' AND platform = 'p'"))
    assert seen() == [101, 102]
    assert slices.vacuum(spark, path) == []
    gone = slices.vacuum(spark, path, keep_hours=-1)
    assert len(gone) == 1 and not any(first in g for g in gone)  # the crashed run; the others hold valid slices
    assert seen() == [101, 102] and second


def test_reload_reads_only_its_slices(spark, sf, tmp_path):
    path, df = str(tmp_path / "e"), fx.listing_entities(Tables(spark, sf))
    entity_store.publish_entities(df, path, df.select("crawl_id", "platform").distinct())
    folders = set(entity_store.read_published(spark, path).inputFiles())
    summary = entity_store.load_crawls(spark, df.where("num_ratings > 25"), ["CC-MAIN-1998"], path)
    # The summary comes from the stored counts; no entity file is opened for it.
    assert all("/counts/" in f for f in summary.inputFiles()) and folders
    after = set(entity_store.read_published(spark, path).inputFiles())
    assert {f for f in folders if "CC-MAIN-1998" not in f} == {f for f in after if "CC-MAIN-1998" not in f}
    full = df.where("crawl_id <> 'CC-MAIN-1998' OR num_ratings > 25").withColumn("city", F.col("city"))
    want = full.groupBy("crawl_id", "platform", "city").count().collect()
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, want))


def test_second_fetch_looks_up_touched_slices_only(spark, tmp_path):
    members = [gzip.compress(b"W\r\n\r\nH\r\n\r\n" + f"page {i}".encode()) for i in range(6)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    offsets = [sum(map(len, members[:i])) for i in range(6)]
    rows = [("u", "t", 200, "text/html", "a.warc.gz", offsets[i], len(members[i]), f"c{i % 2}", None if i == 5 else "p") for i in range(6)]
    out, root = str(tmp_path / "pages"), str(tmp_path)
    pointers = spark.createDataFrame(rows, POINTER)
    steps.fetch_step(pointers.where("crawl_id = 'c0'").limit(2), root, out)
    touched = page_store.slices_of(pointers.where("crawl_id = 'c0'"))
    text = page_store.read_stored(spark, out).where(touched)._jdf.queryExecution().executedPlan().toString()
    assert "crawl_id" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    for _ in range(2):
        assert steps.fetch_step(pointers, root, out).count() == 0
        stored = page_store.read_stored(spark, out).collect()
        assert sorted(r["html"] for r in stored) == [f"page {i}" for i in range(6)]
    assert len({(r["platform"], r["crawl_id"], r["stored_key"]) for r in stored}) == 6
    assert {r["platform"] for r in stored} == {"p", "unknown"}


def test_records_are_unpacked_within_a_limit():
    member = gzip.compress(b"x" * 1000)
    assert warc.inflate(member + gzip.compress(b"y")) == b"x" * 1000 + b"y"
    assert warc.inflate(member, 1000) == b"x" * 1000
    for bad, limit in ((member, 999), (member[:-3], 5000), (b"junk", 10), (member + member, 1500)):
        with pytest.raises((ValueError, EOFError, zlib.error)):
            warc.inflate(bad, limit)


def test_processed_slices_without_entities_are_cleared(spark, sf, tmp_path):
    path = str(tmp_path / "e")
    df = fx.listing_entities(Tables(spark, sf)).select(*ENTITY_COLUMNS)
    entity_store.write_entities(df, path)
    one = df.select("crawl_id", "platform").first()
    here = (F.col("crawl_id") == one["crawl_id"]) & (F.col("platform") == one["platform"])
    entity_store.write_entities(df.where("false"), path, processed=spark.createDataFrame([tuple(one)], "crawl_id string, platform string"))
    left = entity_store.read_entities(spark, path)
    assert left.where(here).count() == 0
    assert left.count() == df.where(~here).count()


def test_marker_and_title_are_read_to_the_end(spark):
    from gleaner.operators import features, reports

    long = "x" * 60_000 + "<article"
    pages = spark.createDataFrame([("c", long), ("c", "none"), ("c", None)], "crawl_id string, html string")
    assert reports.marker_counts(pages, "<article").first()[1:] == (1, 2)
    titled = spark.createDataFrame([(1, "<html><title>" + "a" * 150 + " restaurant</title></html>")], "id int, html string")
    row = features.page_features(titled, ["id"]).first()
    assert row["title"].endswith("restaurant") and row["estimated_type"] == "detail"


def test_unexpected_hosts_are_flagged_at_any_rank(spark):
    from gleaner.operators import reports

    urls = [f"https://h{i}.a.example/x" for i in range(6) for _ in range(3)] + ["https://foreign.example/x"]
    df = spark.createDataFrame([("A", u) for u in urls], "platform string, restaurant_url string")
    rows = reports.host_histogram(df, {"A": ("a.example",)}).collect()
    assert [(r["host"], r["rn"]) for r in rows if r["unexpected"]] == [("foreign.example", 7)] and len(rows) == 6


def test_pages_meet_the_sidecar_of_their_own_place(spark, tmp_path):
    from gleaner.operators import lookups

    root = tmp_path / "s.t+re"
    for crawl in ("c1", "c2"):
        for folder in ("a", "b"):
            place = root / "p" / crawl / folder
            place.mkdir(parents=True)
            (place / "madrid.html").write_text("x")
            (place / "madrid.json").write_text('{"url": "%s%s", "crawl_id": "%s", "platform": "p"}' % (crawl, folder, crawl))
    pages = page_store.read_page_files(spark, str(root)).drop("body")
    rows = lookups.with_metadata(pages, page_store.read_sidecars(spark, str(root))).collect()
    assert sorted((r["url"], r["crawl_id"], r["key"]) for r in rows) == [
        (f"{c}{f}", c, f"{f}/madrid") for c in ("c1", "c2") for f in ("a", "b")]


def _shard(rnd, n):
    """Lines of all kinds in members that end anywhere, some with what looks like the start of a member inside."""
    lines = []
    for i in range(n):
        kind = rnd.random()
        lines.append(b"" if kind < 0.1 else rnd.randbytes(rnd.randint(1, 200)).replace(b"\n", b"") if kind < 0.3
                     else b"\x1f\x8b\x08\x00" * 5 if kind < 0.4 else "é日本".encode() * rnd.randint(1, 30))
    text = b"\n".join(lines) + (b"\n" if rnd.random() < 0.5 else b"")
    out, at = [], 0
    while at < len(text):
        size = rnd.choice([1, 7, 100, 1000, 5000])
        out.append(gzip.compress(text[at:at + size], compresslevel=rnd.choice([0, 6]), mtime=0))
        at += size
    return text, out


def test_gzip_ranges_give_every_line_once():
    rnd = random.Random(8)
    for _ in range(40):
        text, members = _shard(rnd, rnd.randint(1, 60))
        packed = b"".join(members)
        file, step = pa.BufferReader(packed), rnd.choice([1, 50, 333, 5000, 10 ** 6])
        whole, joined = [], b""
        for start in range(0, len(packed), step):
            for lines, head, tail in gzip_lines.range_lines(file, len(packed), start, start + step):
                whole += lines
                if tail is not None:
                    joined += tail if head is None else head + b"\n" + tail
        edges = joined.split(b"\n")
        want = text.split(b"\n")
        assert sorted(whole + edges) == sorted(want)
    with pytest.raises(EOFError):
        list(gzip_lines.range_lines(pa.BufferReader(members[-1][:-4]), len(members[-1]) - 4, 0, 10 ** 6))


def test_one_shard_over_many_tasks(spark, tmp_path):
    lines = [f"{i} " + "é" * (i % 50) for i in range(5000)] + ["", "last"]
    text = "\n".join(lines).encode() + b"\n"
    members = [gzip.compress(text[a:a + 3001], mtime=0) for a in range(0, len(text), 3001)]
    (tmp_path / "shard.gz").write_bytes(b"".join(members))
    (tmp_path / "empty.gz").write_bytes(b"")
    df = gzip_lines.read_lines(spark, str(tmp_path), sum(map(len, members)) // 8 + 1)
    want = sorted(r["value"] for r in spark.read.text(str(tmp_path)).collect())
    assert sorted(r["value"] for r in df.collect()) == want == sorted(lines)
    used = df.withColumn("task", F.spark_partition_id()).groupBy("task").count().count()
    assert used >= 8


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(300):
        folder = tmp_path / "p" / "c" / f"d{i}"
        folder.mkdir(parents=True)
        (folder / "x.html").write_text(f"page {i}")
    context = session.configure(spark).sparkContext
    context.setJobGroup("listing", "folders of a page store")
    try:
        files = page_store.read_page_files(spark, str(tmp_path))
        tracker = context.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < max(s.numTasks for s in stages) <= 96
    assert {r["key"] for r in files.select("key").collect()} == {f"d{i}/x" for i in range(300)}


def test_members_are_written_and_cdx_lines_made_by_as_many_tasks_as_pages_have(spark, sf):
    pages = Tables(spark, sf).pages.repartition(5, "page_id")
    lines = archive.cdx_lines(SimpleNamespace(spark=spark, pages=pages))
    assert lines.rdd.getNumPartitions() == 5
    root = archive.write_gzip_members(SimpleNamespace(spark=spark), lines, "members")
    shards = spark.read.format("binaryFile").load(root).select("path", "length").where("length > 0").collect()
    assert len(shards) == 5
    found = gzip_lines.read_lines(spark, root, 500, "*.gz")
    assert sorted(r["value"] for r in found.collect()) == sorted(r["value"] for r in lines.collect())


def test_files_of_a_store_are_not_held_by_the_driver(spark, tmp_path):
    store = tmp_path / "store"
    for i in range(300):
        folder = store / "p" / "c" / f"d{i}"
        folder.mkdir(parents=True)
        (folder / "x.html").write_text(f"page {i}")
        (folder / "x.json").write_text('{"url": "u%d"}' % i)
    pages, side = page_store.read_page_files(spark, str(store)), page_store.read_sidecars(spark, str(store))
    # Spark's file readers plan with one entry per file; what is planned with now are the tables of the listing.
    for df in (pages, side):
        assert len(df.inputFiles()) < 100 and not any(str(store) in f for f in df.inputFiles())
    assert {(r["key"], bytes(r["body"])) for r in pages.collect()} == {(f"d{i}/x", b"page %d" % i) for i in range(300)}
    assert {(r["path_platform"], r["path_crawl"], r["key"], r["url"]) for r in side.collect()} == {
        ("p", "c", f"d{i}/x", f"u{i}") for i in range(300)}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")  # the sidecars are larger than that
    try:
        joined = lookups.with_metadata(pages.drop("body"), page_store.read_sidecars(spark, str(store)))
        assert "Broadcast" not in joined._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert {r["url"] for r in joined.collect()} == {f"u{i}" for i in range(300)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_store_files_are_chosen_as_spark_chooses_them(spark, tmp_path):
    names = ["x", "a b", "a%20b", "a#b", "é", "_h", "_h=1", ".h", "_metadata", "x._COPYING_", "[a]", "k+l", "x.html"]
    root = tmp_path / "s t"
    for name in names:
        for where in (root / "p" / "c" / name / "y.html", root / "p" / "c" / "d" / f"{name}.html", root / name / "c" / "y.html"):
            where.parent.mkdir(parents=True, exist_ok=True)
            where.write_bytes(name.encode())
    for wrong in ("z.html", "p/z.html", "p/c/z.HTML", "p/c/z.html.gz", "p/c/z.htm"):
        (root / wrong).write_text("no page")
    (root / "p" / "c" / "empty.html").write_bytes(b"")
    (root / "p" / "c" / "nothing").mkdir()
    spark_files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").format("binaryFile").load(str(root))
    want = sorted((r["path"].split(f"{root}/", 1)[1], bytes(r["content"])) for r in spark_files.collect())
    got = [("/".join([r["path_platform"], r["path_crawl"], r["key"]]) + ".html", bytes(r["body"]))
           for r in page_store.read_page_files(spark, str(root)).collect()]
    assert sorted(got) == [w for w in want if w[0].count("/") > 1] and got
    (tmp_path / "none").mkdir()
    assert page_store.read_page_files(spark, str(tmp_path / "none")).count() == 0
    assert page_store.read_sidecars(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(AnalysisException):
        page_store.read_page_files(spark, str(tmp_path / "missing"))


def test_odd_sidecars_are_read_as_spark_reads_them(spark, tmp_path):
    odd = [b'{"url": "u", "timestamp": "t", "status": 200, "mime_type": "m", "crawl_id": "c", "platform": "p"}', b" \n", b"{}", b"[]",
           b'\n{\n "url": null,\n "platform": "p"\n}', b'[{"url": "a"}, {"url": "b", "status": 3}]', b' [{"url": "a", "status": "x"}]',
           b'[{"url": "a"}, 3]', b'[{"url": "a"}, null]', b'[{"url": "a"}', b"{bad", b'{"url": "u", "timestamp": "t"', b"null", b"5",
           b'{"url": "u", "status": "200", "platform": "p"}', b'{"url": 1640995200.123456, "timestamp": 5, "platform": true}',
           b'[{"url": {"a" : [1,\n2]}, "platform": 1.50}, {"url": [ ]}]', b'{"other": {"url": 1.50}, "url": "x", "timestamp" : 1e5 } x',
           b'{"u\\u0072l": 1.50, "URL": "b"}', b'{"url": "a", "url": "b"}', b'{"url": "a"} {"url": "b"}', b'\xef\xbb\xbf{"url": "a"}',
           '{"url": "é\\u00e9"}'.encode("utf-16"), '{"url": "é"}'.encode("utf-16-be"), b'{"url": "a"} \xe9', b'{"url": "\xe9 b"}']
    for i, data in enumerate(odd):
        (tmp_path / "p" / "c" / f"d{i}").mkdir(parents=True)
        (tmp_path / "p" / "c" / f"d{i}" / "x.json").write_bytes(data)
    cells = ["url", "timestamp", "status", "mime_type", "crawl_id", "platform"]
    spark_rows = spark.read.option("recursiveFileLookup", "true").option("multiLine", "true").schema(
        "url string, timestamp string, status int, mime_type string, crawl_id string, platform string").json(str(tmp_path))
    key = F.regexp_extract("_metadata.file_path", r"p/c/(.*)\.json$", 1).alias("key")
    want = [tuple(r) for r in spark_rows.select(key, *cells).collect()]
    got = [tuple(r) for r in page_store.read_sidecars(spark, str(tmp_path)).select("key", *cells).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 26
