"""Stored tables, exports, whole runs and streams."""

import glob
import json
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanwork import schemas
from gleanwork.operators import upsert, validate
from gleanwork.plans import jobs
from gleanwork.sources import inputs
from gleanwork.sources import store as store_module
from gleanwork.sources.export import LAYOUTS, export_layout, write_csv
from gleanwork.sources.store import TableStore
from gleanwork.streaming import streams

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 600)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def store(spark, folder):
    made = TableStore(spark, f"{folder}/store")
    made.create_tables()
    return made


def news(spark, *data):
    return spark.createDataFrame(
        [(i, "1.0", "NEWS", title, "s", "feed", url, None, fresh) for i, url, title, fresh in data],
        "seq bigint, schema_version string, record_type string, title string, content_summary string, source_name string, "
        "source_url string, published_date string, is_fresh boolean",
    )


def test_create_tables_once(store):
    store.create_tables()
    assert {t: store.version(t) for t in schemas.TABLES} == dict.fromkeys(schemas.TABLES, 1)
    assert store.read_table("news").count() == 0 and store.read_table("news").columns[0] == "id"


def test_upsert_keeps_ids_and_skips_replays(spark, store):
    store.upsert_news(news(spark, (1, "b", "B", True), (2, "a", "A", False)), T1, batch="feed#0")
    store.upsert_news(news(spark, (3, "c", "C", True), (4, "a", "A2", True)), T2, batch="feed#1")
    store.upsert_news(news(spark, (5, "d", "D", True)), T2, batch="feed#1")
    got = [(r.id, r.source_url, r.title, r.is_fresh, r.collected_at) for r in store.read_table("news").orderBy("id").collect()]
    assert got == [(1, "b", "B", True, T1), (2, "a", "A2", True, T1), (3, "c", "C", True, T2)]
    assert store.applied("news", "feed#1") and not store.applied("news", "feed#2")
    assert store.lookup_by_url("a", "news").first().id == 2 and store.lookup_by_url("zz", "news").count() == 0
    assert validate.duplicate_keys(store.read_table("news"), "news").count() == 0


def test_changes_pile_up_and_are_merged(spark, store):
    expected = {}
    for i in range(store_module.MAX_CHANGES + 3):
        url, title = f"u{i % 3}", None if i % 4 == 0 else f"t{i}"
        store.upsert_news(news(spark, (i, url, title, None if i % 5 == 0 else i % 2 == 0)), T1, batch=f"s#{i}")
        old = expected.get(url, (len(expected) + 1, None, None))
        expected[url] = (old[0], title or old[1] or "Untitled", (i % 2 == 0) if i % 5 else (old[2] or False))
        if i in (5, store_module.MAX_CHANGES + 2):
            assert {r.source_url: (r.id, r.title, r.is_fresh) for r in store.read_table("news").collect()} == expected
            assert len(store.manifest("news")["changes"]) == (6 if i == 5 else 2)


def test_two_writers_cannot_publish_one_version(spark, store):
    base = store.manifest("news")
    store._publish("news", base, [], 0, None)
    with pytest.raises(Exception, match="exist"):
        store._publish("news", base, [], 0, None)


def test_lookup_filter_reaches_the_scan(spark, store):
    store.upsert_news(news(spark, (1, "b", "B", True)), T1)
    plan = store.lookup_by_url("b", "news")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source_url,b)" in plan


def test_appends_continue_ids(spark, store):
    rows = news(spark, (2, "x", "", True), (1, "y", "", True)).withColumn("entity_name", F.col("source_url"))
    rows = rows.withColumn("employee_count", F.lit(3))
    store.append_startups(rows, T1)
    store.append_startups(rows, T1)
    assert [(r.id, r.entity_name) for r in store.read_table("startups").orderBy("id").collect()] == [(1, "y"), (2, "x"), (3, "y"), (4, "x")]
    summary = {r.table_name: (r.n_rows, r.last_collected_at) for r in store.run_summary().collect()}
    assert summary["startups"] == (4, T1) and summary["research_papers"] == (0, None)


def test_csv(spark, store, folder):
    store.upsert_news(news(spark, (1, "u", 'say "hi", now\nthen', True), (2, "v", " pad ", False)), T2)
    layout = export_layout(store.read_table("news"), "news").withColumn("contentSummary", F.lit(None).cast("string"))
    write_csv(layout, f"{folder}/csv", single_file=True)
    text = open(glob.glob(f"{folder}/csv/*.csv")[0]).read()
    assert text == (
        "id,schemaVersion,recordType,title,contentSummary,sourceName,sourceUrl,publishedDate,isFresh,collectedAt\n"
        '1,1.0,NEWS,"say ""hi"", now\nthen",,feed,u,,true,2024-01-02T03:04:05.000600\n'
        "2,1.0,NEWS, pad ,,feed,v,,false,2024-01-02T03:04:05.000600\n"
    )


def test_run_from_pages_to_exports(spark, store, folder):
    page = '<meta name="citation_title" content="P{}"><a href="https://github.com/o/r{}">c</a>'
    pages = spark.createDataFrame(
        [(1, "https://p/1", page.format(1, 1), None), (2, "https://p/1/", page.format(9, 9), None), (3, "https://p/2", None, "HTTP status 404"),
         (4, "ftp://p/3", page.format(3, 3), None), (5, "https://p/4", "", None)],
        "seq bigint, url string, content string, error string",
    )
    stats = spark.createDataFrame([("o", "r1", 200, 0)], schemas.REPO_STATS)
    rejected = jobs.run_papers(store, pages, stats, T1, T1, batch="b")
    assert [(r.paper_url, r.reasons) for r in rejected.collect()] == [("ftp://p/3", ["paper_url"])]
    got = [(r.id, r.title, r.paper_url, r.github_url, r.github_stars) for r in store.read_table("research_papers").orderBy("id").collect()]
    assert got == [(1, "P1", "https://p/1", "https://github.com/o/r1", 0), (2, None, "https://p/4", None, None)]

    site = '<meta property="og:title" content="N"><meta property="article:published_time" content="1 hour ago">'
    dated = pages.withColumn("content", F.lit(site)).withColumn("source_name", F.lit("Wire"))
    assert jobs.run_news(store, dated, T1, T1).count() == 1 and jobs.run_jobs(store, dated, T1, T1).count() == 1
    assert {(r.source_url, r.source_name, r.is_fresh) for r in store.read_table("news").collect()} == {
        ("https://p/1", "Wire", True), ("https://p/4", "Wire", True)
    }

    raw = [
        {"seq": 1, "recordType": "STARTUP", "content": {"entityName": "Open AI, Inc.", "data": {"employeeCount": 5}}, "source": {"name": "s", "url": "https://s.a"}},
        {"seq": 2, "recordType": "STARTUP", "content": {"entityName": "Quillwrks"}, "source": {"name": "s", "url": "https://s.b"}},
        {"seq": 3, "recordType": "STARTUP", "content": {"entityName": ""}, "source": {"name": "s", "url": "https://s.c"}},
    ]
    lines = [json.dumps(r) for r in raw] + ['{"seq": 4, "recordType"', ""]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/raw")
    startups, broken = inputs.read_records(spark, f"{folder}/raw", f"seq BIGINT, {schemas.RAW_STARTUP}")
    assert broken.count() == 1
    canon = spark.createDataFrame([(0, "Quillworks")], schemas.CANONICALS)
    assert jobs.run_startups(store, startups, canon, T1).count() == 1
    assert [(r.entity_name, r.employee_count) for r in store.read_table("startups").orderBy("id").collect()] == [("OpenAI", 5), ("Quillworks", None)]
    products = spark.createDataFrame(
        [(1, "1.0", "PRODUCT", ("Quillwrks", "free"), ("s", "https://s.b")), (2, "1.0", "PRODUCT", ("New", "rent"), ("s", "https://s.b"))],
        f"seq bigint, {schemas.RAW_PRODUCT}",
    )
    assert jobs.run_products(store, products, T1).count() == 1
    assert [(r.startup_name, r.pricing_model) for r in store.read_table("products").collect()] == [("Quillworks", "free")]

    files, summary = jobs.finish(store, f"{folder}/exports")
    assert set(files) == set(LAYOUTS)
    assert all(glob.glob(f"{path}/*.csv") for path in files.values())
    assert {r.table_name: r.n_rows for r in summary.collect()}["entity_mappings"] == 2


def test_rows_without_a_key_are_rejected_and_kept(spark, store, folder):
    rows = news(spark, (1, "u1", "a", True), (2, None, "b", None), (3, None, None, False), (4, "u1", "c", None))
    rejected = store.upsert_news(rows, T1, batch="x#1")
    assert {(r.seq, r.title, tuple(r.reasons)) for r in rejected.collect()} == {
        (2, "b", ("source_url is null",)), (3, None, ("source_url is null",))}
    assert [(r.source_url, r.title) for r in store.read_table("news").collect()] == [("u1", "c")]
    assert store.upsert_news(rows, T1, batch="x#1").count() == 2 and store.read_rejected("news").count() == 2
    files_of(rows.withColumn("seq", F.col("seq") + 10), f"{folder}/in", "true")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    streams.stream_upsert(stream, store, "news", upsert.NEWS, f"{folder}/ck", lambda n: T1).awaitTermination()
    store.compact("news")
    kept = {(r.batch, json.loads(r.record)["seq"]) for r in store.read_rejected("news").collect()}
    assert kept == {("x#1", 2), ("x#1", 3), (f"{folder}/ck#0", 12), (f"{folder}/ck#0", 13)}
    assert upsert.split_keyed(rows, upsert.NEWS)[0].count() == 2
    with pytest.raises(Exception, match="source_url is null"):
        upsert.upsert_news(store.read_table("news"), rows).collect()


# -- streams --------------------------------------------------------------------------------------


def files_of(df, path, *parts):
    for condition in parts:
        df.where(condition).coalesce(1).write.mode("append").parquet(path)


def test_stream_upsert_and_replay(spark, store, folder):
    rows = news(spark, *[(i, f"u{i % 4}", f"t{i}", i % 2 == 0) for i in range(12)])
    files_of(rows, f"{folder}/in", "seq < 5", "seq >= 5")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    for _ in range(2):
        streams.stream_upsert(stream, store, "news", upsert.NEWS, f"{folder}/ck", lambda n: T1).awaitTermination()
    assert {(r.id, r.source_url, r.title) for r in store.read_table("news").collect()} == {
        (1, "u0", "t8"), (2, "u1", "t9"), (3, "u2", "t10"), (4, "u3", "t11")
    }
    version = store.version("news")
    store.upsert_news(rows, T2, batch=f"{folder}/ck#1")
    assert store.version("news") == version


def test_exact_stream_dedup_over_batches(spark, folder):
    data = [(i, f"https://H/{i % 5}/?utm_x={i}") for i in range(20)]
    rows = spark.createDataFrame(data, "seq bigint, url string")
    files_of(rows, f"{folder}/in", "seq BETWEEN 3 AND 9", "seq < 3 OR seq > 9")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    streams.dedup_into(stream, f"{folder}/out", f"{folder}/ck").awaitTermination()
    kept = spark.read.parquet(f"{folder}/out")
    assert kept.count() == 5 and kept.select("normalized_url").distinct().count() == 5


def test_watermark_dedup_and_fresh_filter(spark, folder):
    data = [(i, f"https://h/{i % 3}#x{i}", datetime(2024, 1, 1, i), f"{i * 5} hours ago") for i in range(9)]
    rows = spark.createDataFrame(data, "seq bigint, url string, fetched_at timestamp, published_date string")
    files_of(rows, f"{folder}/in", "true")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    for name, out in (("dedup", streams.stream_dedup_urls(stream)), ("fresh", streams.stream_fresh_only(stream))):
        run = out.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/ck-{name}")
        run.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{folder}/dedup").select("normalized_url").distinct().count() == spark.read.parquet(f"{folder}/dedup").count() == 3
    assert {r.seq for r in spark.read.parquet(f"{folder}/fresh").collect()} == {0, 1, 2, 3, 4}
