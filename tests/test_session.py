"""Intermediate tables and checked broadcasts."""

import tempfile

import pytest

from skygrain import session


def test_cluster_folder_wins_and_is_required(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="shared-")

    class Conf:
        def get(self, name, default=None):
            return folder if name == "spark.checkpoint.dir" else default

    class Fake:
        conf = Conf()

    assert session.scratch_root(Fake()) == folder

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        session.scratch_root(Cluster())


def test_durable_is_the_same_table(spark):
    df = spark.range(100).selectExpr("id", "id * 0.5D as x", "array(id) as a")
    again = session.durable(df)
    assert again.dtypes == df.dtypes and again.exceptAll(df).isEmpty() and again.count() == 100


def test_only_counted_sides_are_broadcast(spark):
    plan = lambda limit: spark.range(10).join(
        session.small_side(spark.range(1000), limit), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(1000) and "broadcast" not in plan(999)
