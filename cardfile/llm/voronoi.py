"""Exact top-k search by inner product: a kNN join over Voronoi cells.

Vectors get one more component so that all have the length M of the longest; queries get a zero there and are stretched
to M, which changes no ranking. The higher the inner product, the smaller the angle, and angles obey the triangle
inequality. Pivots are a bounded sample of the data. Each vector belongs to its nearest pivot, and a cell is summed
up by the angles of its nearest ``k + 1`` members. From the summaries alone a query knows an angle within which it has ``k + 1``
rows: its own angle to a pivot plus the member's. Queries are put to the pivot with the nearest direction. All queries of such a
cell together need no row that is farther from that direction than the largest sum of a query's own distance from it and the
angle it was promised. Cells are packed into groups of queries; a row is copied to the groups
that need it and to no other. A group with many rows is searched in shares, whose best rows are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

from .vectors import best_rows, classes, padded, quantised, scores
from .words import is_empty

#: Pivots, and the numbers that all pivots together may have: what is sent to every task.
PIVOTS, PIVOT_NUMBERS = 256, 2**22
#: Queries in a group, rows of a group that one task searches.
GROUP, SHARE = 64, 4_096
#: Angles are computed in doubles; a bound is widened by this before anything is left out.
SLACK = 1e-6


class Pivots:
    """Angles (radians) of data and queries to pivots."""

    def __init__(self, vectors: list, longest: int):
        self.width = max((len(v) for v in vectors), default=0)
        self.longest = longest
        self.at = padded(pa.array(vectors, pa.list_(pa.int32())), self.width)
        n2 = np.array([sum(x * x for x in v) for v in vectors], dtype=np.int64)
        self.up, self.norm = np.sqrt(np.maximum(0, longest - n2)), np.sqrt(n2)

    def of_data(self, v: pa.Array, n2: np.ndarray) -> np.ndarray:
        cos = padded(v, self.width) @ self.at.T + np.sqrt(np.maximum(0, self.longest - n2))[:, None] * self.up
        return np.arccos(np.clip(cos / self.longest, -1, 1))

    def of_queries(self, v: pa.Array, n2: np.ndarray) -> np.ndarray:
        cos = padded(v, self.width) @ self.at.T / np.sqrt(n2)[:, None] / math.sqrt(self.longest)
        return np.arccos(np.clip(cos, -1, 1))

    def along(self, v: pa.Array, length: np.ndarray) -> np.ndarray:
        """Angles to the directions of the pivots, which like queries have no last component; ``length`` is that of all components."""
        cos = padded(v, self.width) @ self.at.T / length[:, None] / np.maximum(self.norm, 1)
        return np.where(self.norm > 0, np.arccos(np.clip(cos, -1, 1)), np.pi)


def within(angles: np.ndarray, nearest: np.ndarray, need: int) -> np.ndarray:
    """For each query (angles to pivots) an angle within which ``need`` rows lie; ``nearest`` has the nearest angles of each cell."""
    sums = (angles[:, :, None] + nearest[None]).reshape(len(angles), -1)
    if sums.shape[1] < need:
        return np.full(len(angles), np.pi)
    return np.minimum(np.pi, np.partition(sums, need - 1, axis=1)[:, need - 1])


def packed(counts: dict[int, int], between: np.ndarray, most: int) -> dict[int, list[int]]:
    """Groups of each cell. Near cells share a group of up to ``most`` queries; a larger cell has several of its own."""
    out, n = {}, 0
    left = sorted(counts, key=lambda c: (-counts[c], c))
    while left:
        cell = left.pop(0)
        parts = math.ceil(counts[cell] / most)
        out[cell], room = list(range(n, n + parts)), most - counts[cell]
        for other in sorted(left, key=lambda c: (between[cell, c], c)) if parts == 1 else ():
            if counts[other] <= room:
                out[other], room = [n], room - counts[other]
                left.remove(other)
        n += parts
    return out


def _cells(data: DataFrame, pivots: Pivots, need: int) -> np.ndarray:
    """The ``need`` smallest angles of each cell (pivots x need, infinite where there are fewer)."""

    def place(batches):
        for b in batches:
            angles = pivots.of_data(b["v"], b["n2"].to_numpy())
            cell = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(cell)), cell])], ["cell", "angle"])

    placed = data.select("v", "n2").mapInArrow(place, "cell int, angle double")
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("angle"))
    out = np.full((len(pivots.at), need), np.inf)
    # PIVOTS x need rows at most.
    for r in placed.withColumn("nth", nth).where(F.col("nth") <= need).toLocalIterator():
        out[r.cell, r.nth - 1] = r.angle
    return out


def _searched(data: DataFrame, asked: DataFrame, pivots: Pivots, need: int, group: int, share: int) -> DataFrame:
    """``q``, ``score``, ``id``, ``cls``: the best rows of each share of a group for each query of the group."""
    nearest = _cells(data, pivots, need)

    def bound(batches):
        for b in batches:
            angles, along = pivots.of_queries(b["v"], b["n2"].to_numpy()), pivots.along(b["v"], np.sqrt(b["n2"].to_numpy()))
            cell = along.argmin(axis=1)
            own = along[np.arange(len(cell)), cell]
            reach = np.concatenate([within(angles[i : i + 256], nearest, need) for i in range(0, len(angles), 256)] or [own])
            columns = [b["cls"], b["v"], pa.array(cell, pa.int32()), pa.array(reach + own + SLACK)]
            yield pa.RecordBatch.from_arrays(columns, ["q", "v", "cell", "reach"])

    bounded = materialize(asked.select("cls", "v", "n2").mapInArrow(bound, "q bigint, v array<int>, cell int, reach double"), "queries")
    cells = {r.cell: r for r in bounded.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect()}
    unit = pivots.at / np.maximum(pivots.norm, 1)[:, None]
    between = np.arccos(np.clip(unit @ unit.T, -1, 1))
    groups = packed({c: r.n for c, r in cells.items()}, between, group)
    order = sorted(cells)
    reach = np.array([cells[c].reach for c in order])
    member = np.zeros((len(order), 1 + max(g for gs in groups.values() for g in gs)), dtype=bool)
    for i, c in enumerate(order):
        member[i, groups[c]] = True

    def copied(batches):
        for b in batches:
            longest = np.full(b.num_rows, math.sqrt(pivots.longest))
            needed = (pivots.along(b["v"], longest)[:, order] <= reach) @ member
            who, to = np.nonzero(needed)
            offsets = np.searchsorted(who, np.arange(len(needed) + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(to, pa.int32()))
            yield pa.RecordBatch.from_arrays([b["cls"], b["v"], b["ids"], lists], ["cls", "v", "ids", "groups"])

    copies = data.select("cls", "v", "ids", "n2").mapInArrow(copied, "cls bigint, v array<int>, ids array<bigint>, groups array<int>")
    copies = materialize(copies.where(F.size("groups") > 0), "copies")
    shares = materialize(
        copies.select(F.explode("groups").alias("group")).groupBy("group").agg(F.ceil(F.count("*") / float(share)).cast("int").alias("shares")),
        "shares",
    )
    parts = F.create_map(*[F.lit(x) for c in order for x in (c, len(groups[c]))])[F.col("cell")]
    first = F.create_map(*[F.lit(x) for c in order for x in (c, groups[c][0])])[F.col("cell")]
    there = bounded.select("q", "v", (first + F.pmod(F.xxhash64("q"), parts)).cast("int").alias("group")).join(shares, "group")
    there = there.select("group", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "q", "v")
    here = copies.select(F.explode("groups").alias("group"), "cls", "v", "ids").join(shares, "group")
    here = here.select("group", F.pmod(F.xxhash64("cls"), "shares").cast("int").alias("share"), "cls", "v", "ids")

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            width = max((len(v) for v in queries["v"]), default=0)
            x, cls, ids = padded(rows["v"], width), rows["cls"].to_pylist(), rows["ids"].to_pylist()
            first = np.array([i[0] for i in ids])
            for at in range(0, queries.num_rows, 64):
                cut = queries.slice(at, 64)
                for q, s in zip(cut["q"].to_pylist(), scores(padded(cut["v"], width), x), strict=True):
                    out += [(q, score, i, cls[c]) for score, i, c in best_rows(s, first, ids, need)]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("q", "score", "id", "cls"), columns, strict=True)})

    return here.groupBy("group", "share").cogroup(there.groupBy("group", "share")).applyInArrow(search, "q bigint, score bigint, id bigint, cls bigint")


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding",
    n_pivots: int = PIVOTS, group: int = GROUP, share: int = SHARE,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` rows of highest inner product with each query.

    Every row but the query's own is a candidate; ties go to the smaller id; fewer rows are returned if there are
    fewer. Components are floor(scale * x); scores are exact. Null keys, null vectors and vectors with a null, non-finite
    or (beyond 2**26 once scaled) huge component take no part. Equal rows are one row; rows that share a key only are
    different rows. A shorter vector counts as filled up with zeros; an empty one has score 0 with all. An empty table
    gives no row. ``is_query`` is a condition on ``vectors``; other columns are not read.
    """
    need = k + 1  # the query's own row may be among them
    rows = quantised(vectors, key, vector, scale, query=F.coalesce(is_query, F.lit(False)))
    data = classes(rows.select("id", "v").distinct(), need)
    size = data.agg(F.count("*").alias("n"), F.max("n2").alias("longest"), F.max(F.size("v")).alias("width")).first()
    # A hot vector's queries meet one row of the written table; adaptive execution can split them.
    queries = materialize(rows.where("query").select("id", "v").distinct().join(data.select("v", "cls", "n2"), "v").select("id", "cls", "n2"), "asked")
    asked = data.join(queries.where("n2 > 0").select("cls").distinct(), "cls", "left_semi")
    top = F.struct((-F.col("score")).alias("s"), "id", "cls")
    found = data.sparkSession.createDataFrame([], "q bigint, best array<struct<s:bigint,id:bigint,cls:bigint>>")
    if size.n and size.longest and not is_empty(asked):
        n = max(1, min(n_pivots, math.ceil(math.sqrt(size.n)), PIVOT_NUMBERS // size.width))
        sample = data.select("v").orderBy(F.xxhash64("v"), "v").limit(n).collect()
        near = _searched(data, asked, Pivots([r.v for r in sample], size.longest), need, group, share)
        nth = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id", "cls"))
        found = near.withColumn("nth", nth).where(F.col("nth") <= need).groupBy("q").agg(F.array_sort(F.collect_list(top)).alias("best"))
    none = queries.where("n2 = 0").select(F.col("cls").alias("q")).distinct()
    if not is_empty(none):  # all rows tie with a query of length zero: the smallest ids come first, ``need`` rows in all
        first = data.select(F.explode("ids").alias("id"), "cls").orderBy("id", "cls").limit(need).collect()
        lowest = [F.struct(*[F.lit(x).cast("bigint").alias(n) for n, x in (("s", 0), ("id", r.id), ("cls", r.cls))]) for r in first]
        found = found.unionByName(none.select("q", F.array(*lowest).alias("best")))
    each = queries.withColumnRenamed("cls", "q").join(materialize(found, "found"), "q")
    others = F.filter("best", lambda b: ~((b["id"] == F.col("id")) & (b["cls"] == F.col("q"))))
    return each.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("place", "b")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.s")).alias("score")
    )
