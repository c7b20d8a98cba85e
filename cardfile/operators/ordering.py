"""Row numbers, batches and running totals without a single-task window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

_LOW_BITS = (1 << 33) - 1


def with_ordinal(
    df: DataFrame, *order: str, name: str = "ord", start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Number the rows in the order of the given columns, which must be a unique key together.

    Rows are range partitioned and sorted, and each gets Spark's (partition, position) number. That
    table is written once: range bounds come from samples that differ between runs, so counting and
    numbering must look at the same partitions. Then there is one offset per partition, and the
    only window without a partition key runs over those few offsets.
    """
    spread = (
        df.repartitionByRange(partitions, *order)
        if partitions
        else df.repartitionByRange(*order)
    )
    placed = materialize(
        spread.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "ordinal",
    )
    part = F.shiftright("_at", 33)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_at").bitwiseAND(F.lit(_LOW_BITS))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition, whatever the data
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .drop("_at", "_part", "_offset")
    )


def batch_of(ordinal: Column | str, size: int = 100, start: int = 1) -> Column:
    """Batch number, from 1, of rows numbered from ``start``."""
    c = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return (F.floor((c - start) / size) + 1).cast("bigint")


def assign_batches(df: DataFrame, ordinal: str = "ord", size: int = 100, start: int = 1) -> DataFrame:
    return df.withColumn("batch", batch_of(ordinal, size, start))


def take_batch(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The next ``n`` rows; planned as top-k, each task sends at most ``n`` rows."""
    return df.orderBy(*order).limit(n)


def _carried(chunks: DataFrame, inputs: list[str], width: int) -> DataFrame:
    """``_chunk`` and the sums before it, as ``_before_{input}``; no window holds more than ``width`` chunks."""
    before = lambda spec: [
        F.coalesce(F.sum(c).over(spec.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_before_{c}") for c in inputs
    ]
    if chunks.count() <= width:
        return chunks.select("_chunk", *before(W.orderBy("_chunk")))
    chunks = chunks.withColumn("_above", F.floor(F.col("_chunk") / width))
    above = chunks.groupBy(F.col("_above").alias("_chunk")).agg(*[F.sum(c).alias(c) for c in inputs])
    above = _carried(materialize(above, "chunks"), inputs, width)
    above = above.select(F.col("_chunk").alias("_above"), *[F.col(f"_before_{c}").alias(f"_above_{c}") for c in inputs])
    inside = chunks.select("_chunk", "_above", *before(W.partitionBy("_above").orderBy("_chunk")))
    return inside.join(above, "_above").select(
        "_chunk", *[(F.col(f"_before_{c}") + F.col(f"_above_{c}")).alias(f"_before_{c}") for c in inputs]
    )


def running_total(
    df: DataFrame, by: str, totals: dict[str, str], grand: dict[str, str] | None = None,
    width: int = 10_000,
) -> DataFrame:
    """Running sums over rows with unique whole numbers ``by``, in levels.

    Rows are numbered and cut into chunks of ``width`` rows, however far apart the numbers are. A chunk
    is summed on its own, and what comes before it is taken from the chunk totals, which are summed in
    the same way. ``totals`` names the running sums and ``grand`` the sums over everything, both as
    {output: input}.
    """
    if width < 2:
        raise ValueError("a chunk needs two rows")
    grand = grand or {}
    rows = with_ordinal(df, by, name="_row", start=0).withColumn("_chunk", F.floor(F.col("_row") / width))
    inputs = sorted({*totals.values(), *grand.values()})
    sums = [F.sum(c).alias(f"_sum_{c}") for c in inputs]
    per_chunk = materialize(rows.groupBy("_chunk").agg(*sums), "chunks")
    offsets = _carried(per_chunk, [f"_sum_{c}" for c in inputs], width)
    inside = W.partitionBy("_chunk").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    joined = rows.join(offsets, "_chunk")
    if grand:
        whole = per_chunk.agg(*[F.sum(f"_sum_{c}").alias(out) for out, c in grand.items()])
        for out, value in whole.first().asDict().items():
            joined = joined.withColumn(out, F.lit(value).cast(whole.schema[out].dataType))
    for out, c in totals.items():
        joined = joined.withColumn(out, F.col(f"_before__sum_{c}") + F.sum(c).over(inside))
    return joined.drop("_chunk", "_row", *[f"_before__sum_{c}" for c in inputs])


def matched_first(df: DataFrame, flag: str, *order: str) -> DataFrame:
    """Flagged rows on top, input order within."""
    return df.orderBy(F.col(flag).desc(), *order)
