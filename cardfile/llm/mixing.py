"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies that each of its documents is due. The whole part is given
to all; the fraction is rounded for pairs of documents: of two open documents a random one takes words from the
other until one of them is due a whole copy more or none. Words are moved, not copies, so the words taken stay what
they were up to the one document that is left open at the end. Documents are paired inside small groups of a
source; what a group leaves open (one document at most) goes up a tree of groups, level by level, to one for each
source. A random number is a hash of what it is drawn for, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfile.operators.ordering import with_ordinal
from cardfile.session import materialize

from .words import free_name, n_words, whole_text

WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: Documents in a group at the foot of the tree, and groups that meet in one of the next level.
LEAF, FAN_IN = 1_024, 256


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size``, ``target`` for the rows (``source``, ``size``, ``n_rows`` times each), written.

    Sources in code-point order, null last, take the weights in turn and share all words by them. A target stops at
    ``most`` times the source's size; what is over is shared again by weight until none is above.
    """
    by_source = materialize(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size")), "sources")
    blank = by_source.withColumn("last", F.col("source").isNull())
    placed = with_ordinal(blank, "last", "source", name="place")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("place") - 1, len(weights)) + 1).cast("int"))
    placed = materialize(
        placed.select("source", "source_size", w.alias("weight"), (F.col("source_size") * float(most)).alias("most")),
        "weights",
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:  # each round stops one source or more for good
        full = F.col("weight") * F.lit(level) > F.col("most")
        full = full if stopped >= 0 else F.lit(False)
        n, used, free = placed.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == stopped:
            break
        stopped, level = n, (total - (used or 0.0)) / free if free else math.inf
    target = F.least(F.col("weight") * F.lit(level), F.col("most")) if math.isfinite(level) else F.col("most")
    return materialize(placed.select("source", "source_size", target.alias("target")), "targets")


def pivot(size: np.ndarray, due: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds ``due`` (0 to 1) so that the sum of size times due stays, but for one open entry, whose place is returned.

    The place is -1 if none is open.
    """
    due, held = due.copy(), -1
    for i in range(len(due)):
        if not 0.0 < due[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = size[held], size[i]
        up = min((1.0 - due[held]) * a, due[i] * b)  # words that the held one can take from the other
        down = min(due[held] * a, (1.0 - due[i]) * b)
        words, held_full = (up, (1.0 - due[held]) * a <= due[i] * b) if draw[i] * (up + down) < down else (
            -down, due[held] * a <= (1.0 - due[i]) * b)
        whole = 1.0 if words > 0 else 0.0
        if held_full:
            due[held], due[i] = whole, due[i] - words / b
            held = i if 0.0 < due[i] < 1.0 else -1
        else:
            due[held], due[i] = due[held] + words / a, 1.0 - whole
            held = held if 0.0 < due[held] < 1.0 else -1
    return due, held


_OUT = "source string, row string, size bigint, due double, open boolean"


def _uniform(*columns) -> Column:
    """0 up to 1 from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(2**53))


def _round_up_the_tree(rows: DataFrame, seed: int) -> DataFrame:
    """``row``, ``due`` (0 or 1) for the rows (``source``, ``row``, ``size``, ``due`` between 0 and 1, ``leaves``)."""

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        # Large documents first, so that what stays open is a small one.
        group = group.sort_values(["size", "draw", "row"], ascending=[False, True, True])
        due, held = pivot(group["size"].to_numpy(float), group["due"].to_numpy(), group["turn"].to_numpy())
        out = group[["source", "row", "size"]].astype({"source": object, "row": object}).assign(due=due, open=False)
        if held >= 0:
            out.iloc[held, out.columns.get_loc("open")] = True
        return out

    groups = rows.withColumn("node", F.pmod(F.xxhash64(F.lit(seed), "row"), F.col("leaves")))
    most = rows.agg(F.max("leaves")).first()[0] or 1
    done, level = None, 0
    while True:
        drawn = groups.withColumn("draw", _uniform(F.lit(seed), F.lit(level), F.lit("order"), "row")).withColumn(
            "turn", _uniform(F.lit(seed), F.lit(level), F.lit("turn"), "row")
        )
        settled = materialize(
            drawn.groupBy("source", "node").applyInPandas(
                lambda node, group: settle(group).assign(node=node[1]), _OUT + ", node bigint"
            ),
            "level",
        )
        part = settled.where("not open").select("row", "due")
        done = part if done is None else done.union(part)
        left = settled.where("open")
        if most == 1:
            # One for each source at most: it is rounded by itself.
            last = left.select("row", (_uniform(F.lit(seed), F.lit("last"), "row") < F.col("due")).cast("double").alias("due"))
            return done.union(last)
        most, level = math.ceil(most / FAN_IN), level + 1
        groups = left.select("source", "row", "size", "due", F.floor(F.col("node") / FAN_IN).alias("node"))


def mixed(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = 0,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """A row for each different (``key``, ``source``, ``size``): the ``n_rows`` rows of it, and the ``copies`` of each.

    Size is the number of words. Null and empty texts have size 0 and no copy. A null source is a source, the last
    one; a null key is a key. Rows that share key, source and size are taken together or left together; an empty
    table gives no row. Other columns are not read.
    """
    sizes = _sizes(docs, key, text, source).groupBy("key", "source", "size").agg(F.count("*").alias("n_rows"))
    grouped = materialize(sizes, "sizes")
    targets = source_targets(grouped, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = materialize(
        grouped.join(targets, grouped["source"].eqNullSafe(targets["source"]))
        .select("key", grouped["source"], "size", "n_rows", "source_size", "target", ratio.alias("ratio"))
        .withColumn("row", F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("key", "source", "size")]))),
        "due",
    )
    open_ = due.where((F.col("size") > 0) & (F.col("ratio") > F.floor("ratio")))
    counts = open_.groupBy("source").agg(F.ceil(F.count("*") / LEAF).cast("bigint").alias("leaves"))
    counts = materialize(counts.withColumnRenamed("source", "of"), "leaves")
    leaves = open_.join(counts, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "row", (F.col("size") * F.col("n_rows")).alias("size"), (F.col("ratio") - F.floor("ratio")).alias("due"), "leaves"
    )
    rounded = materialize(_round_up_the_tree(leaves, seed), "rounded")
    extra = rounded.select(F.col("row").alias("of"), F.col("due").cast("long").alias("extra"))
    copies = F.when(F.col("size") > 0, F.floor("ratio") + F.coalesce("extra", F.lit(0))).otherwise(0)
    return due.join(extra, due["row"] == extra["of"], "left").select(
        "key", "source", "size", "n_rows", "source_size", "target", copies.cast("long").alias("copies")
    )


def _sizes(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"),
        n_words(whole_text(text)).alias("size"),
    )


def mix(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: int = 0,
    key: str = "doc_id", text: str = "text", source: str = "source", name: str = "copies",
) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each in ``name``; see ``mixed``."""
    entries = mixed(docs, weights, most, seed, key, text, source)
    each = materialize(
        entries.where("copies > 0").select(
            F.col("key").alias("_k"), F.col("source").alias("_s"), F.col("size").alias("_n"),
            F.col("copies").alias("_copies"),
        ),
        "copies",
    )
    size = free_name(docs, "_size")
    sized = docs.drop(name).withColumn(size, n_words(whole_text(text)))
    same = (
        F.col(f"`{key}`").eqNullSafe(F.col("_k"))
        & F.col(f"`{source}`").cast("string").eqNullSafe(F.col("_s"))
        & (F.col(size) == F.col("_n"))
    )
    # The list of copies grows with the documents, so it is never sent to all tasks, however small it is here.
    return sized.join(each.hint("merge"), same).withColumn(name, F.col("_copies")).drop("_k", "_s", "_n", "_copies", size)
