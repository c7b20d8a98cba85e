"""Session for tests and the bench, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "cardfile", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cardfile-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up for a local master: executors on other machines could
    neither write to it nor read it back after a loss.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"cardfile-{application}-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that no earlier run has used, below the shared folder.

    All paths of an application are in one folder, which can go once its results are no longer read.
    """
    application = f"cardfile-{spark.sparkContext.applicationId}"
    return os.path.join(shared_folder(spark), application, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def option(spark: SparkSession, key: str, value: str):
    """An option of the session for the time of a ``with`` block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a plan must not be computed twice (row numbers, iteration): the files survive lost
    executors, so nothing upstream is ever run again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_table(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys as a written table, for use on the right of a join.

    Two things follow from the files. Their size is known when the join is planned, so a small list
    is broadcast and the other side is not shuffled at all. And a large list is shuffled straight
    from a scan, not out of an aggregate, which adaptive execution needs to split a hot key of the
    other side.
    """
    return materialize(df.select(*[f"`{k}`" for k in keys]).distinct(), "keys")


def bucketed(df: DataFrame, label: str, buckets: int, *keys: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets by ``keys``, one file each, and go on from the written table.

    Tables in as many buckets by the keys of a join meet without a shuffle. The table is known to the session's
    catalog by a name of its own; ``forget`` takes the name out again, the files stay.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    name = f"{label}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    rows.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def forget(table: DataFrame) -> DataFrame:
    """A ``bucketed`` table as plain files, its name out of the catalog."""
    spark = table.sparkSession
    name = table._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().table()
    files, schema = [unquote(f) for f in table.inputFiles()], table.schema
    spark.sql(f"DROP TABLE `{name}`")
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
