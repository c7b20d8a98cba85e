from types import SimpleNamespace

import pytest

from cardfile.session import fresh_path, key_table, materialize, shared_folder


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_folder():
    assert shared_folder(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert fresh_path(fake("yarn", "hdfs:///shared"), "keys").startswith("hdfs:///shared/cardfile-app-1/keys-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("spark://host:7077"))
    assert shared_folder(fake("local[2]")) == shared_folder(fake("local[2]"))


def test_materialized_tables_are_cut_off(spark):
    df = materialize(spark.range(10).selectExpr("id", "rand() as r"), "t")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "rand" not in plan and df.collect() == df.collect()
    assert key_table(spark.createDataFrame([("a", 1), ("a", 2)], "`x.y` string, n int"), "x.y").count() == 1
    assert materialize(spark.range(0), "empty").count() == 0
