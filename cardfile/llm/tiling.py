"""Benchmark decontamination by greedy string tiling.

Words of a text and of a benchmark item are letters and digits in lower case, so markup and case do not hide a
copy. Runs of ``k`` words that occur in the benchmark are the seeds. They are joined with the runs of all texts;
from the runs that are left the shared stretches of a text are known word for word, so whole texts are never moved.
For each pair of text and item the longest match that is still unmarked on both sides is marked, again and again,
down to ``k`` words; running Karp-Rabin hashes find the length. The share of the item's words under marks, in any
order, decides.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

from .words import free_name, windows

TOKEN = r"[\p{L}\p{N}]+"
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TOKEN), F.lit(0))


def _hashes(seq: list[int], marked: list[bool], size: int):
    """(hash, start) of the windows of ``size`` that hold no mark and no gap, by a running Karp-Rabin hash."""
    top, value, run = pow(_BASE, size - 1, _PRIME), 0, 0
    for end, token in enumerate(seq):
        if marked[end] or token < 0:
            value = run = 0
            continue
        if run == size:
            value = (value - seq[end - size] * top) % _PRIME
        else:
            run += 1
        value = (value * _BASE + token) % _PRIME
        if run == size:
            yield value, end - size + 1


def _matches(item, doc, item_marked, doc_marked, size: int) -> list[tuple[int, int]]:
    """(doc start, item start) of the unmarked equal windows of ``size``; for each window of the doc all of the item."""
    at: dict[int, list[int]] = {}
    for value, start in _hashes(item, item_marked, size):
        at.setdefault(value, []).append(start)
    return [
        (d, i)
        for value, d in _hashes(doc, doc_marked, size)
        for i in at.get(value, ())
        if item[i : i + size] == doc[d : d + size]
    ]


def tiles(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (item start, doc start, length), longest first, of equal length by place in the doc.

    Tokens are numbers; a negative one in ``doc`` is a gap that matches nothing.
    """
    item_marked, doc_marked, out = [False] * len(item), [False] * len(doc), []
    high = min(len(item), len(doc))
    while high >= least:
        low, best = least, []
        while low <= high:  # a match of some length holds matches of all shorter ones
            size = (low + high) // 2
            if found := _matches(item, doc, item_marked, doc_marked, size):
                best, low = (found, size), size + 1
            else:
                high = size - 1
        if not best:
            break
        found, size = best
        for d, i in found:
            if not any(doc_marked[d : d + size]) and not any(item_marked[i : i + size]):
                doc_marked[d : d + size] = item_marked[i : i + size] = [True] * size
                out.append((i, d, size))
        high = size
    return out


def _stretches(places, seeds, starts: dict[int, int], item: list[int], k: int) -> list[int]:
    """The words of a text under seeds of the item, with a gap between stretches."""
    out, end = [], None
    for p, seed in sorted(zip(places, seeds, strict=True)):
        if (q := starts.get(seed)) is None:
            continue
        if end is None or p > end:
            out.append(-1)
            end = p
        new = p + k - end
        out += item[q + k - new : q + k]
        end = p + k
    return out


def covered_words(item_tokens, item_seeds, places, seeds, k: int) -> tuple[int, int]:
    """Words of the item under tiles, and tiles."""
    numbers: dict[str, int] = {}
    item = [numbers.setdefault(t, len(numbers)) for t in item_tokens]
    starts = {}
    for q, seed in enumerate(item_seeds):
        starts.setdefault(int(seed), q)
    found = tiles(item, _stretches([int(p) for p in places], [int(s) for s in seeds], starts, item, k), k)
    return sum(x[2] for x in found), len(found)


def _items(benchmark: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """Items of different words, named by the smallest key of those that are equal; too short ones have no seed."""
    rows = benchmark.select(F.col(f"`{key}`").alias("item_id"), tokens(F.col(f"`{text}`")).alias("words"))
    rows = rows.where(F.size("words") >= k).groupBy("words").agg(F.min("item_id").alias("item_id"))
    rows = rows.withColumn("item", F.sha2(F.array_join("words", " "), 256))
    return materialize(rows.withColumn("seeds", windows(F.col("words"), k)), "items")


def _row(docs: DataFrame, key: str, text: str) -> Column:
    k, t = F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")
    return F.md5(F.concat(F.coalesce(F.concat(F.lit("k"), k), F.lit("")), F.lit("\0"), F.coalesce(t, F.lit(""))))


def _leaks(
    docs: DataFrame, benchmark: DataFrame, k: int, coverage: float, key: str, text: str, item_key: str
) -> DataFrame:
    items = _items(benchmark, k, item_key, text)
    places = items.select("item", F.size("words").alias("n"), F.posexplode("seeds").alias("q", "seed"))
    spread = places.groupBy("seed").agg(F.countDistinct("item").alias("items"))
    # Marks of k words or more over a share of n words hold n * share / k seeds at least, so as many less one of the
    # most frequent seeds of an item can be left out of the search: one of the others must be there as well.
    order = Window.partitionBy("item").orderBy(F.desc("items"), "q")
    rare = places.join(spread, "seed").withColumn("place", F.row_number().over(order))
    rare = materialize(
        rare.where(F.col("place") >= F.greatest(F.lit(1), F.ceil(F.col("n") * coverage / k)))
        .select("seed", "item").distinct(), "rare"
    )
    known = materialize(spread.select("seed"), "seeds")

    runs = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        _row(docs, key, text).alias("row"),
        F.posexplode(windows(tokens(F.col(f"`{text}`")), k)).alias("p", "seed"),
    )
    # Whether the list of seeds is sent to all tasks is left to Spark, which knows its written size.
    hits = runs.join(known, "seed", "left_semi").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.collect_set(F.struct("p", "seed")).alias("hits")
    )
    hits = materialize(hits.select("row", "doc_id", F.col("hits.p").alias("places"), F.col("hits.seed").alias("found")), "hits")
    pairs = hits.select("row", F.explode(F.array_distinct("found")).alias("seed")).join(rare, "seed")
    pairs = materialize(pairs.select("row", "item").distinct(), "pairs")

    @F.pandas_udf("covered int, tiles int")
    def tile(item_words: pd.Series, item_seeds: pd.Series, places: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = [covered_words(*x, k) for x in zip(item_words, item_seeds, places, found, strict=True)]
        return pd.DataFrame(out, columns=["covered", "tiles"])

    tiled = pairs.join(items, "item").join(hits, "row").withColumn("t", tile("words", "seeds", "places", "found"))
    return tiled.select(
        "row", "doc_id", "item_id", F.size("words").cast("long").alias("item_words"),
        F.col("t.covered").cast("long").alias("covered_words"), F.col("t.tiles").cast("long").alias("n_tiles"),
    ).where(F.col("covered_words") >= coverage * F.col("item_words"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.8,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id",
) -> DataFrame:
    """Pairs of a text and an item whose words the text holds to a share of ``coverage``, in pieces of ``k`` or more.

    ``doc_id``, ``item_id`` (the smallest of items with the same words), ``item_words``, ``covered_words``, ``n_tiles``.
    Texts without a leak have no row. Null and empty texts and items, and items of fewer than ``k`` words, match
    nothing; repeated rows give one row for each item; a null key is returned as null; an empty table on either side
    gives no row. Other columns are not read.
    """
    return _leaks(docs, benchmark, k, coverage, key, text, item_key).drop("row").distinct()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, k: int = 5, coverage: float = 0.8,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id",
) -> DataFrame:
    """The rows without a leak, columns as they were."""
    mark = free_name(docs, "_row")
    found = materialize(_leaks(docs, benchmark, k, coverage, key, text, item_key).select("row").distinct(), "leaks")
    marked = docs.withColumn(mark, _row(docs, key, text))
    return marked.join(found.withColumnRenamed("row", mark), mark, "left_anti").drop(mark)
