"""SimHash near duplicates through a hierarchical index in Gray order.

Distinct fingerprints are sorted by Gray rank and cut into blocks of neighbours, which are tasks. A block has a
mask of the bits that all its members share and the pattern of those bits. A fingerprint is sent to a block only
if it differs from the pattern in at most ``max_bits`` of the masked bits; this is the top of the index. Inside a
block groups of neighbours share patterns in the same way, level by level. A search adds up the differences met on
the way down and drops a whole group as soon as they exceed ``max_bits``. Members that are left are compared in
full, so the links are exactly the pairs within ``max_bits``. Inside a task links are folded into a forest, since
only the components are asked for: a task returns at most one edge for each member and each visitor.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfile.session import materialize

from .components import components
from .words import WORD, free_name, is_empty, let

#: Fingerprints in a block, and children of a node of the index inside it.
BLOCK, FAN = 1_024, 8
#: Blocks of which the driver and a task hold the patterns at a time. Beyond it blocks are grouped once more.
BLOCKS_AT_ONCE = 4_096
#: Blocks that are written into one file.
BLOCKS_A_FILE = 16
#: Visitors that one task takes for a block.
VISITORS = 65_536
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: Column, k: int) -> Column:
    """XXH64 (seed 42) of each run of ``k`` words; of all words if there are fewer, none if there is no word."""

    def hashed(w):
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)]))
        )
        return (
            F.when(F.size(w) >= k, runs)
            .when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), *LOWER)
    return let(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), hashed)


def _majority(h) -> int:
    """The bits that are set in over half of the hashes."""
    if h is None or not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        part = np.ascontiguousarray(h[at : at + 65_536], dtype="<i8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def with_fingerprint(rows: DataFrame, text: str, k: int, name: str = "fp") -> DataFrame:
    """``rows`` with the 64-bit SimHash of ``text`` (bigint) in its place; zero for a text without words."""
    others = [c for c in rows.columns if c != text]
    hashed = rows.select(*others, shingle_hashes(F.col(text), k).alias("_hashes"))

    def fold(batches):
        for frame in batches:
            frame[name] = pd.Series([_majority(h) for h in frame["_hashes"]], dtype="int64", index=frame.index)
            yield frame[[*others, name]]

    schema = T.StructType([*(rows.schema[c] for c in others), T.StructField(name, T.LongType())])
    return hashed.mapInPandas(fold, schema)


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def gray_rank(bits: Column) -> Column:
    """Place in Gray order, as a signed number that sorts like the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(2**63)))


def _levels(ones: np.ndarray, zeros: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of each node, the lowest ones first; a node holds FAN neighbours of the level below.

    ``ones`` and ``zeros`` are the bits that all members of a lowest node have set and have not.
    """
    out = [(ones | zeros, ones)]
    while len(ones) > 1:
        starts = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
        out.append((ones | zeros, ones))
    return out


def _within(visitors: np.ndarray, levels: list, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(visitor, lowest node) of all pairs that differ in at most ``max_bits`` bits of the node's mask."""
    who = np.arange(len(visitors))
    node, met = np.zeros(len(who), dtype=np.int64), np.zeros(len(who), dtype=np.uint8)
    known = np.zeros(len(who), dtype=np.uint64)  # the bits that the levels above have compared
    for level in range(len(levels) - 1, -1, -1):
        mask, pattern = levels[level]
        own = mask[node]
        met = met + np.bitwise_count((visitors[who] ^ pattern[node]) & own & ~known)
        keep = met <= max_bits
        who, met, node, known = who[keep], met[keep], node[keep], own[keep]
        if level:
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            real = child < len(levels[level - 1][0])
            who, met, known = (np.repeat(x, FAN)[real] for x in (who, met, known))
            node = child[real]
    return who, node


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions over the links a, b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (jump := root[root]).tobytes() != root.tobytes():
            root = jump
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def search_block(prints: np.ndarray, visitors: np.ndarray, max_bits: int, step: int = 2_048) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that joins what is linked among visitors and members (all uint64, members in Gray order)."""
    every, levels = np.concatenate([prints, visitors]), _levels(prints, ~prints)
    root = np.arange(len(every))
    for at in range(0, len(visitors), step):
        who, node = _within(visitors[at : at + step], levels, max_bits)
        root = root[_forest(root[node], root[len(prints) + at + who], len(every))]
    linked = np.flatnonzero(every != every[root])
    return every[linked], every[root[linked]]


def _ranks(fps: np.ndarray) -> np.ndarray:
    """``gray_rank`` of uint64 fingerprints."""
    for shift in (1, 2, 4, 8, 16, 32):
        fps = fps ^ (fps >> np.uint64(shift))
    return (fps ^ np.uint64(1 << 63)).view(np.int64)


def _near(frame: pd.DataFrame, fps: np.ndarray, max_bits: int, step: int = 8_192):
    """(block, fp) for the blocks of ``frame`` that can hold a fingerprint near one of ``fps`` and not only smaller ones.

    Blocks are in Gray order, so a pair from two blocks is met once: by the smaller one in the block of the larger.
    """
    ids, ones, some, last = (frame[c].to_numpy(np.int64) for c in ("block", "ones", "some", "last"))
    levels, fps = _levels(ones.view(np.uint64), ~some.view(np.uint64)), fps.view(np.uint64)
    for at in range(0, len(fps), step):
        cut = fps[at : at + step]
        who, node = _within(cut, levels, max_bits)
        ahead = last[node] >= _ranks(cut)[who]
        yield pd.DataFrame({"block": ids[node[ahead]], "fp": cut[who[ahead]].view(np.int64)})


def _meet(inside: DataFrame, coming: DataFrame, key: str, order: str, work, schema: str) -> DataFrame:
    """``work`` (members in order, visitors) for each ``key``; a group with many visitors becomes several tasks."""
    shares = coming.groupBy(key).agg(F.ceil(F.count("*") / float(VISITORS)).cast("bigint").alias("shares"))
    here = inside.join(shares, key).select(
        *inside.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share")
    )
    there = coming.join(shares, key).select(key, F.pmod(F.xxhash64("fp"), "shares").alias("share"), "fp")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return work(left.sort_values(order), right["fp"].to_numpy(np.int64))

    return here.groupBy(key, "share").cogroup(there.groupBy(key, "share")).applyInPandas(run, schema)


def _visits(fps: DataFrame, blocks: DataFrame, max_bits: int) -> DataFrame:
    """``block``, ``fp``: which blocks each fingerprint has to be compared with."""
    if blocks.agg(F.max("block")).first()[0] < BLOCKS_AT_ONCE:
        held = blocks.orderBy("block").toPandas()  # BLOCKS_AT_ONCE rows of four numbers at most

        def near(batches):
            for frame in batches:
                yield from _near(held, frame["fp"].to_numpy(np.int64), max_bits)

        return fps.mapInPandas(near, "block bigint, fp bigint")
    grouped = blocks.withColumn("up", F.floor(F.col("block") / BLOCKS_AT_ONCE))
    above = materialize(
        grouped.groupBy(F.col("up").alias("block")).agg(
            F.bit_and("ones").alias("ones"), F.bit_or("some").alias("some"), F.max("last").alias("last")
        ),
        "blocks",
    )
    coming = materialize(_visits(fps, above, max_bits).withColumnRenamed("block", "up"), "visits")

    def below(members: pd.DataFrame, visitors: np.ndarray) -> pd.DataFrame:
        return pd.concat(_near(members, visitors, max_bits))

    return _meet(grouped, coming, "up", "block", below, "block bigint, fp bigint")


def links(prints: DataFrame, max_bits: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges (``a``, ``b``) that join all fingerprints within ``max_bits`` of each other.

    ``prints`` has distinct non-null values in ``fp``. The edges are a forest for each task: their components are
    those of all links. A block with many visitors is searched by several tasks, so a dense cluster of fingerprints
    does not meet one.
    """
    n_blocks = max(1, math.ceil(prints.count() / block))
    placed = prints.select("fp", gray_rank(F.col("fp")).alias("rank"))
    # The bounds of a range partitioning are sampled; written once, the blocks stay as they are.
    placed = placed.repartitionByRange(n_blocks, "rank").select(
        F.spark_partition_id().cast("bigint").alias("block"), "fp", "rank"
    )
    members = materialize(placed.coalesce(math.ceil(n_blocks / BLOCKS_A_FILE)), "gray")
    if is_empty(members):
        return members.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    blocks = members.groupBy("block").agg(
        F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some"), F.max("rank").alias("last")
    )
    visits = materialize(_visits(members.select("fp"), blocks, max_bits), "visits")

    def search(inside: pd.DataFrame, coming: np.ndarray) -> pd.DataFrame:
        a, b = search_block(inside["fp"].to_numpy(np.int64).view(np.uint64), coming.view(np.uint64), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return _meet(members, visits, "block", "rank", search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (bigint), ``component_id`` for every row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; the component is named by its smallest
    key. Null and empty texts have the fingerprint zero and are linked like any other. Repeated rows give repeated
    rows. A null key names a component only if no row of it has a key. An empty table gives none. Other columns are
    not read.
    """
    rows = materialize(_fingerprinted(docs, k, key, text).select("key", "fp"), "prints")
    classes = _classes(rows, max_bits)
    return rows.join(classes, "fp").select(F.col("key").alias(key), F.col("fp").alias("fingerprint"), "component_id")


def _row_digest(key: str, text: str) -> Column:
    k = F.col(f"`{key}`")
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("k"), k.cast("string")), F.lit("")), F.lit("\0"), F.coalesce(F.col(f"`{text}`"), F.lit("\0"))))


def _fingerprinted(docs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("key"), _row_digest(key, text).alias("row"), F.col(f"`{text}`").alias("text")
    )
    return with_fingerprint(rows, "text", k)


def _classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root`` (a fingerprint that names the component), ``component_id`` (its smallest key)."""
    prints = materialize(rows.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    roots = components(links(prints.select("fp"), max_bits))
    named = materialize(
        prints.join(roots, prints["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "named",
    )
    low = materialize(named.groupBy("root").agg(F.min("first").alias("component_id")), "low")
    return named.join(low, "root").select("fp", "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, k: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component, columns as they were: that with the smallest key (a null key comes last).

    Where that key repeats inside the component the row with the smallest digest stays, and one of equal rows. Null
    and empty texts are one component; an empty table stays empty; extra columns are kept as they are.
    """
    rows = materialize(_fingerprinted(docs, k, key, text), "prints")
    classes = _classes(rows, max_bits)
    best = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row"))
    keep = rows.join(classes, "fp").groupBy("root").agg(best.alias("best")).select("best.row")
    mark, place = free_name(docs, "_row"), free_name(docs, "_place")
    marked = docs.withColumn(mark, _row_digest(key, text))
    kept = marked.join(keep.withColumnRenamed("row", mark), mark, "left_semi")
    # Only equal rows share a digest; Spark cuts such a group to one row before the shuffle.
    first = Window.partitionBy(mark).orderBy(mark)
    return kept.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place, mark)
