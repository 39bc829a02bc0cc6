import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gleanwork.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", app="tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over one text column `x`, in input order."""

    def run(values, build, ddl="x string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
        return [r[0] for r in rows.select(build(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]

    return run
