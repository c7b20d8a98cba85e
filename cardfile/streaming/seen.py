"""What earlier batches of a stream have had, in hash buckets on disk: their keys, or the first row of each key."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import quoted
from ..operators.dedup import keep_first


class _Batches:
    """Rows in the folder of the batch that brought them and of the bucket of their key.

    A batch reads the buckets of its own keys. What a batch wrote is read by later
    batches only, so a replayed batch sees what it saw the first time and overwrites its own folder. Every
    ``merge_every`` batches the folders so far become one; a merged folder is used once it is complete.
    """

    def __init__(self, folder: str, buckets: int = 64, merge_every: int = 64):
        self.folder, self.buckets, self.merge_every = folder, buckets, merge_every

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(self.buckets)).cast("int")

    def _folders(self, spark: SparkSession, batch_id: int) -> tuple[list[str], int]:
        """Folders with the keys of the batches before this one, and how many batches are in none merged."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return [], 0
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = {k: sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{k}-(\d+)", n))) for k in ("batch", "merged")}
        done = lambda n: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))
        merged = [m for m in found["merged"] if m <= batch_id and done(f"merged-{m}")][-1:]
        since = merged[0] if merged else 0
        single = [b for b in found["batch"] if since <= b < batch_id]
        return [f"{self.folder}/merged-{m}" for m in merged] + [f"{self.folder}/batch-{b}" for b in single], len(single)

    def _read(self, spark: SparkSession, folders: list[str], fields: T.StructType) -> DataFrame:
        with_bucket = T.StructType([*fields, T.StructField("bucket", T.IntegerType())])
        parts = [spark.read.schema(with_bucket).parquet(f) for f in folders]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _earlier(self, rows: DataFrame, key: str, batch_id: int, fields: T.StructType) -> DataFrame | None:
        """Rows of earlier batches in the buckets that the keys of ``rows`` are in."""
        folders, _ = self._folders(rows.sparkSession, batch_id)
        if not folders:
            return None
        wanted = [r[0] for r in rows.select(self._bucket(key)).distinct().collect()]  # ``buckets`` numbers at most
        return self._read(rows.sparkSession, folders, fields).where(F.col("bucket").isin(wanted))

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows

    def _add(self, rows: DataFrame, key: str, batch_id: int) -> None:
        spark = rows.sparkSession
        placed = rows.withColumn("bucket", self._bucket(key)).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/batch-{batch_id}")
        folders, single = self._folders(spark, batch_id + 1)
        if single >= self.merge_every:
            merged = self._merged(self._read(spark, folders, rows.schema)).repartition("bucket")
            merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/merged-{batch_id + 1}")


class SeenKeys(_Batches):
    """Each key once; a batch reads no rows of earlier results."""

    def unseen(self, rows: DataFrame, key: str, batch_id: int) -> DataFrame:
        """Rows whose key no earlier batch had; null is a key like any other."""
        seen = self._earlier(rows, key, batch_id, T.StructType([rows.schema[key]]))
        if seen is None:
            return rows
        seen = seen.select(quoted(key).alias("_seen"))
        return rows.join(seen, quoted(key).eqNullSafe(F.col("_seen")), "left_anti")

    def add(self, rows: DataFrame, key: str, batch_id: int) -> None:
        """Keys of ``rows``, which are distinct, as those of this batch."""
        self._add(rows.select(quoted(key)), key, batch_id)


class FirstRows(_Batches):
    """The first row of each key by ``order``, whichever batch brings it.

    A batch adds its first rows that come before those of earlier batches, so the batches together give what one batch
    with all rows would. A row that another one has overtaken lies there until the next merge and is not
    read as a result. Nulls come first in an order; null is a key like any other.
    """

    def __init__(self, folder: str, fields: T.StructType, key: str, *order: str, buckets: int = 64, merge_every: int = 64):
        super().__init__(folder, buckets, merge_every)
        self.fields, self.key, self.order = fields, key, order

    def _merged(self, rows: DataFrame) -> DataFrame:
        return keep_first(rows, quoted(self.key), *[quoted(c) for c in self.order])

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Rows of this batch. They are read twice, so give written ones where they are dear."""
        rows = self._merged(rows.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in self.fields]))
        earlier = self._earlier(rows, self.key, batch_id, self.fields)
        if earlier is not None:
            place = F.struct(*[quoted(c) for c in self.order])
            best = earlier.groupBy(quoted(self.key).alias("_known")).agg(F.min(place).alias("_best"))
            joined = rows.join(best, quoted(self.key).eqNullSafe(F.col("_known")), "left")
            rows = joined.where(F.col("_best").isNull() | (place < F.col("_best"))).drop("_known", "_best")
        self._add(rows, self.key, batch_id)

    def read(self, spark: SparkSession, batches: int) -> DataFrame:
        """First rows over the first ``batches`` batches."""
        folders, _ = self._folders(spark, batches)
        if not folders:
            return spark.createDataFrame([], self.fields)
        return self._merged(self._read(spark, folders, self.fields)).drop("bucket")


def committed(spark: SparkSession, out: str) -> DataFrame:
    """Rows of a table of batches, those of batches only that its ledger has."""
    try:
        ledger = spark.read.parquet(f"{out}/ledger").select("batch_id").distinct()
    except AnalysisException as gone:
        if "PATH_NOT_FOUND" in str(gone):
            raise ValueError(f"no batch of {out} has been committed") from gone
        raise
    return spark.read.parquet(f"{out}/rows").join(ledger, "batch_id", "left_semi")
