"""Integer vectors: exact scores, classes of equal vectors, and small helpers for tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

#: Components beyond it would let scores pass 64 bits.
LARGEST = 2**26


def quantised(vectors: DataFrame, key: str, vector: str, scale: int, **others: Column) -> DataFrame:
    """``id``, ``v`` (array<int>: floor(scale * component), components as double) and the columns of ``others``.

    Rows whose key or vector is null are left out, and those with a component that is null, not finite or, once
    scaled, beyond LARGEST, as scores of such vectors need not fit a long. Equal rows are one row.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    ok = F.forall(x, lambda c: F.coalesce(F.abs(c) <= float(LARGEST) / scale, F.lit(False)))
    v = F.when(ok, F.transform(x, lambda c: F.floor(c * scale).cast("int")))
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("id"), v.alias("v"), *[c.alias(n) for n, c in others.items()])
    return rows.where("id is not null and v is not null").distinct()


def classes(rows: DataFrame, keep: int, *by: str) -> DataFrame:
    """One row for each different vector (and ``by``), written: ``cls``, ``v``, ``ids`` (its ``keep`` smallest), ``n2``.

    Of equal vectors only the smallest ids can be among the first of a ranking, so ``keep`` of them are enough. Spark
    cuts a hot vector to ``keep`` rows in each task before the shuffle.
    """
    nth = F.row_number().over(Window.partitionBy("v", *by).orderBy("id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    each = few.groupBy("v", *by).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    n2 = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, c: a + c.cast("bigint") * c)
    return materialize(each.select(F.monotonically_increasing_id().alias("cls"), "*", n2.alias("n2")), "classes")


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros or cut to ``width``: what lies beyond meets only zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row[place < width], place[place < width]] = flat[place < width]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (long) of all rows of a with all rows of b, both whole numbers."""
    most = max(1, a.shape[1]) * max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0))
    if most < 2**53:  # then no partial sum of doubles is rounded
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def best_rows(score: np.ndarray, first: np.ndarray, ids: list, need: int, ok: np.ndarray | None = None):
    """(score, id, place of the class) of the ``need`` best rows: higher scores, then smaller ids.

    ``first`` is the smallest id of each class. A row among the best has a class among the best ``need`` by first id.
    """
    at = np.arange(len(score)) if ok is None else np.flatnonzero(ok)
    if len(at) > need:
        least = np.partition(score[at], len(at) - need)[len(at) - need]
        at = at[score[at] >= least]
    at = at[np.lexsort((first[at], -score[at]))][:need]
    rows = sorted((-int(score[i]), int(x), int(i)) for i in at for x in ids[i])[:need]
    return [(-s, x, i) for s, x, i in rows]
