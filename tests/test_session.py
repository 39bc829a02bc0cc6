import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanwork import session


class _Context:
    master = "spark://host:7077"

    class _jsc:
        @staticmethod
        def sc():
            class Held:
                @staticmethod
                def getCheckpointDir():
                    class Option:
                        isDefined = staticmethod(lambda: False)

                    return Option

            return Held


class _Cluster:
    sparkContext = _Context

    class conf:
        get = staticmethod(lambda key, default=None: default)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.scratch_dir(_Cluster, "x")


def test_staged_tables_can_be_removed(spark):
    df = session.staged(spark.range(5), "numbers")
    assert df.count() == 5
    path = session._scratch[-1]
    assert os.path.isdir(path)
    session.clear_scratch(spark)
    assert not os.path.isdir(path) and not session._scratch


def test_python_workers_get_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n_bytes"])

    session.ensure_settings(spark)
    rows = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("html"))
    seen = [r.n_bytes for r in rows.mapInArrow(sizes, "n_bytes bigint").collect()]
    assert sum(seen) > 20_000_000 and max(seen) < 8_000_000
