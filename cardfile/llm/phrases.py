"""Phrases (collocations) from a weighted de Bruijn graph.

Nodes are runs of ``longest - 1`` words, an edge is a run of ``longest`` words that leads from its first words to its last ones,
and its weight is how often the run occurs. Each place of a text gives one run: as long as ``longest``, or shorter where the
piece ends before. Tasks add up equal runs and Spark adds up the tasks' sums; that is the only count made of the texts. A
shorter run occurs as often as flow leaves it: the weight of all runs one word longer that begin with it, plus the pieces that
end with it. Chains of nodes with one way in and one way out, where no piece begins or ends, are compacted into one path; what is
inside a path is always held by a longer phrase of the same count.

A phrase that occurs ``least`` times has no word and no pair of words that occurs less often. So pieces are
cut at such words and between such pairs first, which changes no count of a phrase. Which ones these are is told by two bitmaps over hashes of
words and pairs; where two share a bit a rare one is kept, which costs time and changes nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

from .simhash import LOWER
from .words import is_empty

#: Ends of pieces, as the contract lists them; blanks between words are the space and the tab.
ENDS = ".,;:!?\n\x0b\x0c\r"
#: Bytes of text that a task counts at a time, and that are split into words at a time.
BYTES, SLICE = 2**24, 2**20
#: Bits of a bitmap: BITS_EACH for each frequent item, but not more than MOST_BITS (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 2**18, 2**27
BLANK, END = 0, 1

# UTF-8 has these bytes nowhere inside longer characters, so whole texts are mapped byte by byte.
_TABLE = bytes.maketrans("".join((LOWER[0], "\t", ENDS)).encode(), "".join((LOWER[1], " ", "\n" * len(ENDS))).encode())


class Block:
    """Words of texts (UTF-8) of one language as numbers, texts and pieces one after the other, END between them."""

    def __init__(self):
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[b""], self.number[b"\n"] = BLANK, END
        self.parts: list[np.ndarray] = []

    def add(self, text: bytes) -> None:
        at = 0
        while at < len(text):
            cut = text.find(b" ", at + SLICE)
            cut = len(text) if cut < 0 else cut
            words = text[at:cut].translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
            self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
            at = cut
        self.parts.append(np.array([END]))

    def ids(self) -> np.ndarray:
        ids = np.concatenate(self.parts)
        return ids[ids != BLANK]

    def words(self) -> np.ndarray:
        return np.array(list(self.number), dtype=object)


def blocks(batches: Iterator[pd.DataFrame], most: int = BYTES) -> Iterator[tuple[str, Block]]:
    """Blocks of about ``most`` bytes of the texts of one language each, or of what the task has."""
    held: dict[str, Block] = {}
    size = 0
    for frame in batches:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            if lang not in held:
                held[lang] = Block()
            held[lang].add(text)
            size += len(text)
            if size >= most:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def word_hashes(lang: str, block: Block) -> np.ndarray:
    own = pd.util.hash_array(np.array([lang], dtype=object))[0]
    return pd.util.hash_array(block.words()) * np.uint64(0x9E3779B97F4A7C15) + own


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


class Bitmap:
    """Hashes whose bit is set; those never added are let through now and then."""

    def __init__(self, frequent: DataFrame, column: str):
        size = LEAST_BITS
        while size < min(MOST_BITS, BITS_EACH * frequent.count()):
            size *= 2
        place = F.col(column).bitwiseAND(F.lit(size - 1))
        page = frequent.select(F.shiftright(place, 15).cast("int").alias("page"), place.bitwiseAND(F.lit(32767)).alias("bit"))
        self.bits, self.mask = np.zeros(size // 8, dtype=np.uint8), np.uint64(size - 1)
        for r in page.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():  # MOST_BITS in all
            self.bits[r.page * 4096 : (r.page + 1) * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def kept_words(lang: str, block: Block, words: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, END in the place of rare ones; the hashes of all words by number."""
    hashes = word_hashes(lang, block)
    kept = words.has(hashes)
    kept[[BLANK, END]] = False
    ids = block.ids()
    return np.where(kept[ids], ids, END), hashes


def pairs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a place and the next one both hold a word, and a number for the two."""
    if len(ids) < 2:
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
    return (ids[:-1] != END) & (ids[1:] != END), ids[:-1] << 32 | ids[1:]


def runs_of(ids: np.ndarray, linked: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of different runs (the first of each), their words, and how often each occurs."""
    start = np.flatnonzero(ids != END)
    code, size, going = ids[start], np.ones(len(start), dtype=np.int64), np.ones(len(start), dtype=bool)
    linked = np.r_[linked, np.zeros(longest, dtype=bool)]
    after = np.r_[ids, np.full(longest, END)]
    for j in range(1, longest):
        going = going & linked[start + j - 1]
        size += going
        code = np.unique(code << 32 | np.where(going, after[start + j], BLANK), return_inverse=True)[1]
    _, first, times = np.unique(code, return_index=True, return_counts=True)
    return start[first], size[first], times


def _word_counts(texts: DataFrame) -> DataFrame:
    """``lang`` and its number of words ``n``; rows without ``lang`` are ``h`` (hash of language and word) and how often it occurs."""

    def count(batches):
        for lang, block in blocks(batches):
            ids = block.ids()
            times = np.bincount(ids, minlength=len(block.number))[2:]
            frame = pd.DataFrame({"h": word_hashes(lang, block)[2:].view(np.int64), "n": times})
            frame.insert(0, "lang", None)
            yield pd.concat([frame, pd.DataFrame({"lang": [lang], "h": [0], "n": [int(times.sum())]})])

    return texts.mapInPandas(count, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"))


def _pair_counts(texts: DataFrame, words: Bitmap) -> DataFrame:
    def count(batches):
        for lang, block in blocks(batches):
            ids, hashes = kept_words(lang, block, words)
            both, code = pairs_of(ids)
            code, times = np.unique(code[both], return_counts=True)
            h = pair_hashes(hashes[code >> 32], hashes[code & 0xFFFFFFFF])
            yield pd.DataFrame({"h": h.view(np.int64), "n": times})

    return texts.mapInPandas(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _runs(texts: DataFrame, words: Bitmap, pairs: Bitmap, longest: int) -> DataFrame:
    """``lang``, ``k`` (words), ``g`` (words with a space between), ``n``: the run at each place, added up."""

    def count(batches):
        for lang, block in blocks(batches):
            ids, hashes = kept_words(lang, block, words)
            both, code = pairs_of(ids)
            code, back = np.unique(code, return_inverse=True)
            frequent = pairs.has(pair_hashes(hashes[code >> 32], hashes[code & 0xFFFFFFFF]))
            at, size, times = runs_of(ids, both & frequent[back] if len(back) else both, longest)
            text, ids = block.words(), ids.tolist()
            for i in range(0, len(at), 65_536):
                cut = slice(i, i + 65_536)
                g = [b" ".join(text[ids[a : a + s]]).decode() for a, s in zip(at[cut].tolist(), size[cut].tolist(), strict=True)]
                yield pd.DataFrame({"lang": lang, "k": size[cut], "g": g, "n": times[cut]})

    return texts.mapInPandas(count, "lang string, k int, g string, n bigint").groupBy("lang", "k", "g").agg(F.sum("n").alias("n"))


def head(g: str, k: int) -> Column:
    return F.substring_index(g, " ", k)


def tail(g: str, k: int) -> Column:
    return F.substring_index(g, " ", -k)


def graph(texts: DataFrame, longest: int, least: int) -> tuple[DataFrame, dict[int, DataFrame], DataFrame]:
    """Words of each language (``lang``, ``n``), counts by length (``lang``, ``g``, ``n``), and the nodes with their ways out.

    Counts of phrases that occur ``least`` times are exact; of others there may be less than all. ``texts``: ``lang`` and ``text`` (binary), not null.
    """
    counted = materialize(_word_counts(texts).where(F.col("lang").isNotNull() | (F.col("n") >= least)), "words")
    words = Bitmap(counted.where("lang is null"), "h")
    pairs = Bitmap(materialize(_pair_counts(texts, words).where(F.col("n") >= least).select("h"), "pairs"), "h")
    runs = materialize(_runs(texts, words, pairs, longest), "runs")
    counts, nodes = {longest: runs.where(F.col("k") == longest).select("lang", "g", "n")}, None
    for k in range(longest - 1, 0, -1):
        flow = counts[k + 1].select("lang", head("g", k).alias("g"), "n", F.col("n").alias("out"))
        ends = runs.where(F.col("k") == k).select("lang", "g", "n", F.lit(None).cast("bigint").alias("out"))
        each = flow.unionByName(ends).groupBy("lang", "g").agg(F.sum("n").alias("n"), F.sum("out").alias("out"), F.count("out").alias("ways"))
        level = materialize(each, f"runs{k}")
        nodes = level if nodes is None else nodes
        counts[k] = level.select("lang", "g", "n")
    return counted.where("lang is not null").select("lang", "n"), counts, nodes


def paths(edges: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``lang``, ``path`` (its words), ``n``, ``inner`` (nodes inside): the edges, unary chains of them as one row.

    A node with one way out, at which no piece ends, and into which one edge brings all that leaves it has no other way in, and
    no piece begins there. ``edges`` holds the edges whose chains are asked for, all those of such a node among them.
    """
    k = longest - 1
    edges = materialize(edges.select(F.monotonically_increasing_id().alias("id"), "lang", "g", "n"), "edges")
    through = nodes.where("ways = 1 and out = n").select("lang", "g", "n")
    came = edges.select("lang", tail("g", k).alias("g"), "n", F.col("id").alias("before"))
    goes = edges.select("lang", head("g", k).alias("g"), "id")
    steps = through.join(came, ["lang", "g", "n"]).join(goes, ["lang", "g"]).select("id", "before")
    back = edges.select("id").join(steps, "id", "left").select(
        "id", F.coalesce("before", "id").alias("start"), F.col("before").isNotNull().cast("bigint").alias("far")
    )
    while True:  # each round doubles how far back an edge sees
        back = materialize(back, "back")
        if is_empty(back.join(back.where("far > 0").select(F.col("id").alias("start")), "start", "left_semi")):
            break
        behind = back.select(F.col("id").alias("start"), F.col("start").alias("to"), F.col("far").alias("more"))
        back = back.join(behind, "start").select("id", F.col("to").alias("start"), (F.col("far") + F.col("more")).alias("far"))
    # Of the first edge all words, of each later one the last.
    each = edges.join(back, "id").select("start", "lang", "n", "far", F.when(F.col("far") == 0, F.col("g")).otherwise(tail("g", 1)).alias("w"))
    whole = each.groupBy("start", "lang", "n").agg(F.array_sort(F.collect_list(F.struct("far", "w"))).alias("w"))
    return whole.select("lang", F.concat_ws(" ", F.col("w.w")).alias("path"), "n", (F.size("w") - 1).alias("inner"))


def _within(path: str, k: int, first: int, last: Column) -> Column:
    """The runs of ``k`` words of a path from word ``first`` on; ``last`` is the number of the last one."""
    w = F.split(F.col(path), " ")
    at = F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))
    return F.explode(F.transform(at, lambda i: F.array_join(F.slice(w, i, k), " ")))


def phrases(
    docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, first: int | None = 2_000, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of 2 to ``longest`` words of each language.

    A-Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks. ``a`` is how often the phrase
    occurs (``least`` at least), ``l`` and ``r`` how often its two parts do at the cut with the lowest score (ties: the first),
    ``n`` the words of the language, ``score`` = floor(2,000,000 a / (l + r)), computed in whole numbers. A phrase inside a longer one
    that occurs ``share`` percent as often is left out. Order: score, a, phrase in bytes; ``first`` None returns all.
    A null language is ``und``, a null or empty text has no word, repeated rows count each, an empty table gives no row. Other
    columns are not read. ``longest`` is 2 or more.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").cast("binary").alias("text")
    ).where(F.length("text") > 0)
    totals, counts, nodes = graph(texts, longest, least)
    often = {k: c.where(F.col("n") >= least) for k, c in counts.items()}
    chains = materialize(paths(often[longest], nodes, longest), "paths")
    words = F.size(F.split("path", " "))
    inside = chains.where("inner > 0").select("lang", _within("path", longest - 1, 2, words - longest + 1).alias("g"))
    often[longest] = chains.select("lang", _within("path", longest, 1, words - longest + 1).alias("g"), "n")
    kept = []
    for k in range(2, longest + 1):
        own = often[k] if k < longest - 1 or k == longest or longest < 3 else often[k].join(inside, ["lang", "g"], "left_anti")
        if k < longest:  # a phrase of more words that holds it occurs no more often than one of k + 1 words does
            longer = often[k + 1].select("lang", F.explode(F.array(head("g", k), tail("g", k))).alias("g"), "n")
            most = longer.groupBy("lang", "g").agg(F.max("n").alias("most"))
            own = own.join(most, ["lang", "g"], "left").where(f"most is null or 100 * most < {share} * n").drop("most")
        kept.append(own.select("lang", "g", F.col("n").alias("a"), F.lit(k).alias("k")))
    kept = materialize(_union(kept), "kept")
    part = _union([often[k].select("lang", "g", "n") for k in range(1, longest)])
    cuts = kept.select("lang", "g", "a", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"gl": F.expr("substring_index(g, ' ', cut)"), "gr": F.expr("substring_index(g, ' ', cut - k)")})
    cuts = cuts.join(part.select("lang", F.col("g").alias("gl"), F.col("n").alias("l")), ["lang", "gl"])
    cuts = cuts.join(part.select("lang", F.col("g").alias("gr"), F.col("n").alias("r")), ["lang", "gr"])
    # Of decimals div gives the whole part as a long.
    score = F.expr("cast(a as decimal(20, 0)) * 2000000bd div cast(l + r as decimal(20, 0))")
    low = cuts.withColumn("score", score).groupBy("lang", "g", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("low.score").desc(), F.col("a").desc(), "g"))
    ranked = low.withColumn("rank", rank).where(F.col("rank") <= first if first else F.lit(True)).join(totals, "lang")
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), F.col("g").alias("phrase"), "a", "low.l", "low.r", "n", "low.score"
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
