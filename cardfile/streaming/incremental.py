"""Restartable jobs: only new input is processed, and a replayed batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selectors import Selector
from ..functions.shred import with_nodes
from ..functions.urls import ensure_scheme
from ..operators.columns import quoted
from ..operators.dedup import keep_first
from ..operators.links import profile_fields
from ..operators.matching import resume
from ..operators.reports import batch_split_counts
from ..operators.routing import with_route
from ..functions.predicates import is_complete
from .seen import SeenKeys


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as a stream. ``path`` may be a folder or a pattern for files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(
    stream: DataFrame, checkpoint: str, path: str | None = None,
    each: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process what has arrived since the last run with this checkpoint, then stop.

    Rows go to the Parquet table at ``path``, or every micro-batch to ``each``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)
    query.awaitTermination()


def incremental_extract(
    pages: DataFrame, done: DataFrame, selectors: dict[str, Selector], out: str, checkpoint: str
) -> None:
    """Profile fields of pages that are neither in ``done`` nor in an earlier batch, with a ``status``.

    A page that gives no field is a ``Failed`` row with blank fields, so it is not tried again. Of several pages of one address
    in a batch one is taken, first those that give a field. The anti joins come before the shredder, so finished pages are never parsed.
    Rows, completed and failed ones, go to a folder of their batch, then their addresses, then one row to the ledger
    (``batch_id``, ``completed``, ``failed``). Only batches in the ledger are read (``seen.committed``), and a batch that
    was stopped half way and runs again overwrites what it had written.
    """
    keys = SeenKeys(f"{out}/keys")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = keys.unseen(resume(batch.withColumn("url", ensure_scheme("url")), done, "url"), "url", batch_id)
        rows = profile_fields(with_nodes(todo), selectors, "url")
        fields = [c for c in rows.columns if c != "url"]
        found = F.greatest(*[F.coalesce(quoted(c) != "", F.lit(False)) for c in fields])
        rows = rows.withColumn("status", F.when(found, "Completed").otherwise("Failed"))
        rows = keep_first(rows, F.col("url"), "status", *fields)
        folder = f"{out}/rows/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(rows.schema).parquet(folder)
        keys.add(written, "url", batch_id)
        counts = [F.count_if(F.col("status") == s).alias(s.lower()) for s in ("Completed", "Failed")]
        written.agg(*counts).coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/batch_id={batch_id}")

    run_available(pages, checkpoint, each=write)


def stream_keep_first(
    stream: DataFrame, key: Column, ordinal: str, out: str, checkpoint: str
) -> None:
    """The first row per key: first batch, then smallest ordinal.

    Inside a batch the ranking has a group limit, so a hot key leaves each map task as one row; what is left is checked
    against the keys of earlier batches, in the buckets of its own keys only. Batches write folders of their own, so
    a replay overwrites its own rows only.
    """
    keys = SeenKeys(f"{checkpoint}-keys")

    def write(batch: DataFrame, batch_id: int) -> None:
        firsts = keep_first(batch, F.col("dedup_key"), ordinal)
        folder = f"{out}/batch_id={batch_id}"
        new = keys.unseen(firsts, "dedup_key", batch_id)
        new.write.mode("overwrite").parquet(folder)
        keys.add(batch.sparkSession.read.schema(new.schema).parquet(folder), "dedup_key", batch_id)

    run_available(stream.withColumn("dedup_key", key), checkpoint, each=write)


def _one_each(keys: list[str], event_time: str | None):
    """For each Arrow batch the rows that are the first of their keys, or the latest where there is an event time."""

    def run(batches):
        for b in batches:
            table = pa.Table.from_batches([b])
            at = table.select(keys).append_column("_at", pa.array(np.arange(b.num_rows)))
            if event_time is not None:
                order = pc.sort_indices(table, [(event_time, "descending")], null_placement="at_end")
                at = at.take(order).set_column(len(keys), "_at", pa.array(np.arange(b.num_rows)))
                table = table.take(order)
            first = at.group_by(keys).aggregate([("_at", "min")])["_at_min"]
            yield from table.take(first.combine_chunks()).to_batches()

    return run


def stream_dedup(
    stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Any one row per key, kept by Spark's state store as one state row per key.

    Before the shuffle each Arrow batch of a task lets one row of a key through, without state, so a hot key is
    shuffled once for some thousands of its rows. Without an event time the state grows with the number of keys. With one a key is
    forgotten ``delay`` after its row, and rows later than that are dropped, so the caller must say how long; the
    first round then lets the latest row through, which is late only if all of them are.
    """
    if event_time is not None and delay is None:
        raise ValueError("an event time needs a delay")
    plain = all(not isinstance(stream.schema[k].dataType, (T.ArrayType, T.MapType, T.StructType)) for k in keys)
    if plain:
        stream = stream.mapInArrow(_one_each(keys, event_time), stream.schema)
    if event_time is not None:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def failure_rows(attempted: DataFrame, extracted: DataFrame, url: str = "url") -> DataFrame:
    """One row per attempted address: its fields, or blanks and a status, so it is not tried again."""
    fields = [c for c in extracted.columns if c != url]
    found = extracted.withColumn("_found", F.lit(True))
    joined = attempted.select(quoted(url).alias(url)).join(found, url, "left")
    return joined.select(
        url,
        *[F.coalesce(quoted(c), F.lit("")).alias(c) for c in fields],
        F.when(F.col("_found"), "Completed").otherwise("Failed").alias("status"),
    )


def batched_route(
    stream: DataFrame, business: str, phone: str, out: str, checkpoint: str
) -> None:
    """Per micro-batch: complete and incomplete rows to separate folders, and their counts.

    A batch is computed once into its own folder, split on the way; counts are read back from it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_route(batch, {"clean": is_complete(quoted(business), quoted(phone))}, "missing")
        folder = f"{out}/rows/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy("route").parquet(folder)
        written = spark.read.schema(rows.schema).parquet(folder).withColumn("batch", F.lit(batch_id))
        batch_split_counts(written, "batch", business, phone).write.mode("overwrite").parquet(
            f"{out}/report/batch_id={batch_id}"
        )

    run_available(stream, checkpoint, each=write)
