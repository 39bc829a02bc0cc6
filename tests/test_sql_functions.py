"""The SQL forms agree with the column functions."""

from datetime import datetime

from pyspark.sql import functions as F

from gleanwork.functions import dates, names, repos, urls
from gleanwork.functions.sql import register_sql

AS_OF = datetime(2024, 3, 10, 9, 30, 15)
TEXTS = [
    "HTTP://Site.Example:80/A//?utm_a=1&b=2&&a=1&REF=3#f", "https://s.e/a/;v=1?x", " https://github.com/o/r.git ", "mailto:a@b", "",
    None, "Élan & Co, Inc.", "  ACME GmbH ", "2024-01-15T10:30:00+02:00", "5 jan 2024", "March 5, 2024", "Sat, 09 Mar 2024 23:00:00 -0200",
    "3 hours ago", "2 weeks ago", "99999999999999 days ago", "2024/3/9", "31 Feb 2024", "20240310", "2024-03-10 01:02:03.5Z",
]


def test_sql_functions(spark):
    register_sql(spark)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, x string")
    rows.createOrReplaceTempView("texts")
    stamp = f"TIMESTAMP '{AS_OF}'"
    got = spark.sql(
        "SELECT i, normalize_url(x) AS u, normalize_entity_name(x) AS n, github_repo(x) AS g, valid_url(x) AS v,"
        f" parse_date(x, {stamp}) AS d, is_fresh(x, {stamp}) AS f FROM texts"
    )
    x = F.col("x")
    want = rows.select(
        "i", urls.normalize_url(x), names.normalize_entity_name(x), repos.github_owner_repo(x), urls.valid_url(x),
        dates.parse_date(x, AS_OF), dates.is_fresh(x, AS_OF),
    )
    assert [tuple(r) for r in got.orderBy("i").collect()] == [tuple(r) for r in want.orderBy("i").collect()]
