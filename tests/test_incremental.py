"""Searches that end early, filters of what was seen, and streams that remember."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleanwork.functions import dates
from gleanwork.functions.names import sequence_score
from gleanwork.operators import dedup, html, resolve, upsert
from gleanwork.streaming import streams

SF = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


# -- best match by bounds -------------------------------------------------------------------------


def test_bound_ordered_search_finds_the_best_and_compares_few(spark):
    dice = random.Random(7)
    names = list(dict.fromkeys("".join(dice.choice("abcd ") for _ in range(dice.randint(4, 14))).strip() or "x" for _ in range(300)))
    forms = spark.createDataFrame([(n, n.upper(), i) for i, n in enumerate(names)], "norm string, name string, pos int")
    asked = [n[:k] + n[k + 1 :] for n in names for k in (len(n) // 2,)] + names[:40] + ["zzzz"]
    norms = spark.createDataFrame([(n,) for n in dict.fromkeys(asked)], "norm string")
    pairs = resolve.fuzzy_candidates(norms, forms, 0.75)
    scored = pairs.withColumn("match", sequence_score("norm", "form")).where(F.col("match.ratio") >= 0.75)
    ranked = scored.join(forms.select(F.col("norm").alias("form"), "name", "pos"), "form")
    every = {tuple(r) for r in resolve.best_match(ranked.select("norm", "name", "pos", "match.ratio", "match.rounded")).collect()}
    assert {tuple(r) for r in resolve.fuzzy_join(norms, forms, 0.75).collect()} == every and len(every) > 100
    counts = pairs.count(), resolve.searched(norms, forms, 0.75).agg(F.sum("n_compared").alias("n")).first()["n"]
    assert counts[1] * 3 <= counts[0]


# -- dates by shape -------------------------------------------------------------------------------


def test_usual_spellings_read_like_the_patterns(column):
    dice, texts = random.Random(2), []
    months = ["Jan", "february", "MAR", "may", "June", "sept", "Sep", "october", "Dec"]
    for _ in range(1500):
        y, m, d = dice.choice(["2024", "0000", "1999", "9999"]), dice.choice(["01", "2", "12", "13", "00"]), dice.choice(["1", "29", "30", "31", "05", "00"])
        clock = dice.choice(["", "T10:20:30", " 10:20", "x10:20:30.123", "T23:59:60", "T24:00:00", "t01:02:03.123456"])
        zone = dice.choice(["", "Z", "z", "+05:30", "-0800", "+19:00", "+02"])
        word = dice.choice(months)
        texts.append(dice.choice([
            f"{y}-{m}-{d}{clock}{zone}", f"{y}{m}{d}", f"{y}/{m}/{d}", f"{d} {word} {y}", f"{word} {d}, {y}", f"{d}\t{word}  {y}",
            f"{dice.choice(['Mon', 'sun', 'Xyz'])}, {d} {word} {y} 10:20:30 {dice.choice(['GMT', 'gmt', '+0100', '-2500', 'UTC'])}",
            f"Mon, {y}-{m}-{d}", f"@{d} {word} {y} 10:20:30 GMT"]))
    as_of = datetime(2024, 3, 10)
    fast = column(texts, lambda x: dates.parse_date(x, as_of))
    plain = column(texts, lambda x: dates.format_iso_utc(F.date_trunc("second", dates._within_calendar(dates._unusual(x, as_of)))))
    assert fast == plain and sum(x is not None for x in fast) > 150


# -- pages read no further than needed ------------------------------------------------------------


@pytest.mark.parametrize("wanted", [["title"], ["h1"], ["metas", "ld", "h1", "title"], ["hrefs"], ["dateline", "author_links"], ["time_datetime"]])
def test_facts_do_not_depend_on_where_reading_ends(spark, wanted):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    pages += ["<h1>open <b>till the end", "<!-- <h1>no --><H1>Yes</H1><p>x</p>", "<div><h1>a</div>b<title>t</title>" + "z" * 5000,
              "<script>'<h1>'</script><title>x" + "y" * 5000, "<title>" + "t" * 5000 + "</title>rest", "", None, "<a href='1'>" + "q" * 3000 + "<a href='2'"]
    for page in pages:
        whole = html.page_facts(page, [*wanted, "visible_text"])  # the visible text needs the whole page
        del whole["visible_text"]
        assert html.page_facts(page, wanted) == whole


def test_reading_a_title_ends_with_the_head():
    page = "<html><head><title>T</title></head><body>" + "<p>long text</p>" * 5000
    reader = html.read_page(page, ["title"])
    assert len(reader.visible) < 2000 < len(html.read_page(page).visible)


# -- filters of what was seen ---------------------------------------------------------------------


def test_what_a_filter_rules_out_is_not_shuffled(spark):
    seen = spark.range(500).select(F.concat(F.lit("https://h/"), "id").alias("normalized_url"), (F.col("id") % 4).alias("part"))
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    pages = spark.range(3000).select(F.col("id").alias("seq"), F.concat(F.lit("https://H/"), hot.cast("string")).alias("url"))
    pages = pages.unionAll(spark.createDataFrame([(9000, None), (9001, None)], "seq bigint, url string"))
    for words in (1 << 18, 4):  # a filter that is full rules out next to nothing, and the answer stays
        filters = dedup.url_filter(seen, "part", words=words)
        assert filters.count() <= 4 * words
        known = dedup.merged_filter(filters)
        whole = dedup.url_filter(seen, words=words)
        assert sorted(map(tuple, known.collect())) == sorted(map(tuple, whole.collect()))
        kept = {r.seq for r in dedup.skip_seen(pages, seen, known, words).collect()}
        assert kept == {i for i in range(3000) if i % 3 and i >= 500} | {9000, 9001}
    new, _ = dedup.split_by_filter(dedup.with_normalized_url(pages), dedup.url_filter(seen))
    plan = new._jdf.queryExecution().executedPlan().toString()
    # The filter itself is aggregated; the rows it is held against only meet it in a broadcast.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_rows_of_a_hot_url_are_split(spark):
    rows = [(i, "https://a/hot" if i % 3 else f"https://a/{i % 30000}") for i in range(30000)] + [(30000, None)]
    pages = spark.createDataFrame(rows, "seq bigint, url string")
    seen = spark.createDataFrame([(u,) for u in ["https://a/hot"] * 2 + [f"https://a/{i}" for i in range(0, 30000, 6)]], "normalized_url string")
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        kept = dedup.skip_seen(pages, seen, dedup.url_filter(seen, words=1 << 14), 1 << 14)
        assert {r.seq for r in kept.collect()} == {i for i in range(3, 30000, 6)} | {30000}
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in low:
            spark.conf.unset(key)


# -- streams --------------------------------------------------------------------------------------


def batch(spark, path, rows):
    spark.createDataFrame(rows, "seq bigint, url string").coalesce(1).write.mode("append").parquet(path)


def test_keyed_state_survives_a_restart(spark, folder):
    schema = "seq bigint, url string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet

    def run():
        streams.dedup_into(stream(f"{folder}/in"), f"{folder}/out", f"{folder}/ck").awaitTermination()
        return sorted((r.normalized_url or "", r.seq) for r in spark.read.parquet(f"{folder}/out").collect())

    batch(spark, f"{folder}/in", [(5, "https://a/x"), (3, "https://A/x/"), (4, "https://b"), (6, None)])
    batch(spark, f"{folder}/in", [(1, "https://a/x?utm_id=1"), (8, "https://c"), (7, "https://c"), (9, None)])
    assert run() == [("", 6), ("", 9), ("https://a/x", 3), ("https://b", 4), ("https://c", 7)]
    batch(spark, f"{folder}/in", [(10, "https://c/"), (11, "https://d"), (2, "https://b")])
    assert run() == [("", 6), ("", 9), ("https://a/x", 3), ("https://b", 4), ("https://c", 7), ("https://d", 11)]


def test_first_arrivals_are_found_without_python_rows(spark, folder):
    """Rows with a null or repeated number, or the same URL in later batches; the state is kept by Spark's own aggregation."""
    stream = spark.readStream.schema("seq bigint, url string").option("maxFilesPerTrigger", 1).parquet
    batch(spark, f"{folder}/in", [(None, "https://a"), (4, "https://a/"), (None, "https://b"), (None, None), (5, "https://c"), (5, "https://c")])
    batch(spark, f"{folder}/in", [(1, "https://a"), (2, "https://b"), (9, "https://d"), (3, "https://d/")])
    query = streams.dedup_into(stream(f"{folder}/in"), f"{folder}/out", f"{folder}/ck")
    query.awaitTermination()
    got = spark.read.schema("seq bigint, url string, normalized_url string").parquet(f"{folder}/out")
    assert {(r.normalized_url, r.seq) for r in got.collect()} == {
        ("https://a", 4), ("https://b", None), (None, None), ("https://c", 5), ("https://d", 3)} and got.count() == 5
    assert sorted((r.micro_batch, r["count"]) for r in got.groupBy("micro_batch").count().collect()) == [(0, 4), (1, 1)]
    assert [op.operatorName for op in query.lastProgress.stateOperators] == ["stateStoreSave"]


def test_urls_are_forgotten_after_their_time(spark, folder):
    stream = spark.readStream.schema("seq bigint, url string").option("maxFilesPerTrigger", 1).parquet
    for part in range(2):
        batch(spark, f"{folder}/in", [(part, "https://a")])
        streams.dedup_into(stream(f"{folder}/in"), f"{folder}/out", f"{folder}/ck", ttl=timedelta(milliseconds=1)).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_late_rows_are_dropped_and_counted(spark, folder):
    ddl = "kind string, fetched_at timestamp, published_date string"
    days = [[(1, 10), (1, 12)], [(9, 1)], [(9, 2)], [(1, 13), (9, 3)]]
    for hours in days:
        rows = [("a", datetime(2024, 1, d, h), "1 hour ago" if h % 2 else "3 days ago") for d, h in hours]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    out = streams.stream_freshness_summary(arriving, "kind")
    query = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    got = [(r.window_start.day, r.n_rows, r.n_fresh) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert got == [(1, 2, 0)] and streams.dropped_late(query) == 1


# -- folds ----------------------------------------------------------------------------------------


def test_folds_take_values_by_arrival(spark):
    rows = [(1, "k", "old", 1), (2, "k", None, None), (3, "k", "new", None), (4, "k", "", 0), (5, "j", None, None)]
    delta = spark.createDataFrame(rows, "seq bigint, paper_url string, title string, github_stars int")
    got = {r.paper_url: (r.first_seq, tuple(r.first), tuple(r.newest)) for r in upsert.fold_delta(delta, upsert.PAPERS).collect()}
    assert got == {"k": (1, ("old", 1), ("new", 0)), "j": (5, (None, None), (None, None))}
