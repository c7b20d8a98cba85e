"""Exact search, hard negatives and phrases against brute force, on odd rows and on data where pruning works."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardfile.llm import anchor_lists, phrases, voronoi

ODD = [
    (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (200, [], 2), (300, [0.25], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5, 2.0], 2),
    (3, None, 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1), (6, [1.0, None], 1), (None, [1.0, 1.0], 1), (7, [-1.0, 0.3], None),
    (8, [-1.0, 0.3], 2), (8, [-1.0, 0.3], 2), (8, [3.0, 0.3], 2), (0, [0.3, 0.3], 1), (9, [1e300, 0.0], 1), (-100, [1.0, 0.5], 3), (50, [0.2, -0.7], 1),
]
SCHEMA = "vec_id long, embedding array<double>, label int, v string, cls long, rank int, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "v", 1, 2, "i") for i, v, x in rows], SCHEMA)


def known(rows, scale, labelled=False):
    out = set()
    for i, v, x in rows:
        if i is None or v is None or (labelled and x is None):
            continue
        if any(c is None or not math.isfinite(c) or abs(c) * scale > 2**26 for c in v):
            continue
        out.add((i, tuple(math.floor(c * scale) for c in v), x if labelled else None))
    return sorted(out, key=str)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def top(rows, k, scale):
    out = []
    have = known(rows, scale)
    for q in (r for r in have if r[0] % 100 == 0):
        best = sorted((-dot(q[1], r[1]), r[0]) for r in have if r != q)[:k]
        out += [(q[0], n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def negatives(rows, scale=256):
    out, have = [], known(rows, scale, labelled=True)
    for a in (r for r in have if r[0] % 50 == 0):
        met = sorted((-dot(a[1], r[1]), r[0], r[2]) for r in have if r != a)
        for s, p, _ in [m for m in met if m[2] == a[2]][:5]:
            fits = [m for m in met if m[2] != a[2] and 50 * -s <= 100 * -m[0] <= 95 * -s][:3]
            out += [(a[0], p, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def clustered(n, spread, seed=3, dims=12):
    """Rows in tight groups, a third of them copies of one vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    rows = []
    for i in range(n):
        v = centres[0] if i % 3 == 0 else centres[rng.integers(20)] + spread * rng.normal(size=dims)
        rows.append((i, [float(x) for x in v], int(rng.integers(4))))
    return rows


def searched(spark, rows, **options):
    return sorted(tuple(r) for r in voronoi.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, scale=256, **options).collect())


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in anchor_lists.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, F.col("label"), **options).collect())


def test_top_k_of_odd_rows(spark):
    assert searched(spark, ODD, k=4) == top(ODD, 4, 256)
    assert searched(spark, ODD, k=100, group=1, share=2) == top(ODD, 100, 256)
    assert searched(spark, []) == [] and searched(spark, [(5, [1.0], 1)]) == [] and searched(spark, [(0, [1.0], 1)]) == []
    assert searched(spark, [(0, [0.0], 1), (1, [0.0], 1)]) == [(0, 1, 1, 0)]


def written(monkeypatch, module):
    rows, write = defaultdict(list), module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: (out := write(df, label), rows[label].append(out))[0])
    return rows


def test_groups_get_what_they_need(spark, monkeypatch):
    rows = [(i, [x / math.sqrt(dot(v, v)) for x in v], label) for i, v, label in clustered(1500, 0.02)]
    tables = written(monkeypatch, voronoi)
    assert searched(spark, rows, k=10, n_pivots=40, group=2, share=50) == top(rows, 10, 256)
    copies = tables["copies"][0]
    groups = copies.select(F.explode("groups")).distinct().count()
    assert groups >= 3 and copies.select(F.explode("groups")).count() < 0.5 * groups * 1000


def test_bounds_hold():
    """The angle that the summaries promise holds the rows that it promises."""
    rng = np.random.default_rng(0)
    nearest = np.sort(rng.random((5, 3)), axis=1)
    angles = rng.random((4, 5))
    for a, w in zip(angles, voronoi.within(angles, nearest, 4), strict=True):
        assert w == pytest.approx(sorted((a[:, None] + nearest).ravel())[3])
    assert (voronoi.within(angles, nearest, 16) == np.pi).all()
    groups = voronoi.packed({0: 5, 1: 3, 2: 1, 4: 130}, rng.random((5, 5)), 64)
    assert len(groups[4]) == 3 and groups[0] == groups[1] == groups[2] and not set(groups[0]) & set(groups[4])


def test_hard_negatives_of_odd_rows(spark):
    assert mined(spark, ODD) == negatives(ODD)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], None)]) == []


def test_members_stop_when_certain(spark, monkeypatch):
    rows, tables = clustered(1500, 0.3), written(monkeypatch, anchor_lists)
    assert mined(spark, rows, members=2, segment=16) == negatives(rows)
    left = [t.count() for t in tables["members"]]
    assert 0 < left[1] < left[0] or 0 in left  # some leave before the end of their list


def test_lists_are_cut_by_bound():
    lists = anchor_lists.Lists(np.eye(2), np.array([0.5, 0.5]), 10.0)
    counts = np.zeros(anchor_lists.BINS, dtype=np.int64)
    counts[[3, 4, 100, 900]] = [5, 5, 100, 1]
    lists.cut(0, counts, 10)
    assert lists.first[0][[3, 4, 100, 900]].tolist() == [0, 0, 1, 11] and lists.pieces[0][100] == 10
    assert lists.rounds[0] == [(0, 1), (1, 11), (11, 12)] and lists.ends[0][-1] == -math.inf
    assert lists.ends[0][0] == lists.top(100)


def counted(docs, longest, least, share, first=None):
    """Phrases by counting every run of words."""
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {g: a for g, a in c.items() if a >= least}
        held = Counter()
        for g, a in often.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    held[g[i : i + k]] = max(held[g[i : i + k]], a)
        best = []
        for g, a in often.items():
            if len(g) > 1 and 100 * held[g] < share * a:
                score, k = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, g, l, r) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, g.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4, 5])
def test_phrases(spark, longest):
    rng = random.Random(longest)
    words = ["the", "The", "of", "été", "ÉTÉ", "a b", "日本", "x#1", "\x00z"]
    ends = [" ", "  ", "\t", ", ", ".", "\n", " \x0b", "\r\n"]
    docs = [(rng.choice(["en", "fr", None, "und", ""]), "".join(rng.choice(words[: rng.randint(2, 9)]) + rng.choices(ends, [30, 3, 2, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    docs += [("en", "one long run of words that many have in common word for word")] * 9 + [("en", "long run of something else")] * 3
    docs += [("en", None), ("en", ""), ("en", "...,;"), ("en", "x" * 5000), ("fr", "a " * 3000), ("de", "only once")]
    df = spark.createDataFrame([(lang, t, "g", 1, "p") for lang, t in docs], "lang string, text string, g string, n int, path string")
    got = phrases.phrases(df.repartition(3), longest=longest, least=4, share=80, first=None)
    assert sorted(tuple(r) for r in got.collect()) == counted(docs, longest, 4, 80)
    if longest == 4:
        got = phrases.phrases(df, longest=4, least=4, share=80, first=7)
        assert sorted(tuple(r) for r in got.collect()) == counted(docs, 4, 4, 80, 7)
        assert phrases.phrases(df.limit(0)).count() == 0


def test_paths(spark):
    """A chain without branches is one path; nodes with two ways, or where pieces end, are not inside one."""
    docs = [("en", "a b c d e f g h")] * 4 + [("en", "a b c d e f x y")] * 3 + [("en", "m n o p q")] * 2 + [("en", "m n o p")]
    texts = spark.createDataFrame(docs, "lang string, text string").withColumn("text", F.col("text").cast("binary"))
    _, counts, nodes = phrases.graph(texts, 4, 1)
    got = {(r.path, r.n, r.inner) for r in phrases.paths(counts[4], nodes, 4).collect()}
    assert got == {("a b c d e f", 7, 2), ("d e f g h", 4, 1), ("d e f x y", 3, 1), ("m n o p", 3, 0), ("n o p q", 2, 0)}
    assert {r.g: r.n for r in counts[1].collect()}["c"] == 7 and {r.g: r.n for r in counts[3].collect()}["n o p"] == 3


def test_words_across_slices(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 3)
    block = phrases.Block()
    block.add("Aa bb, cc\tdd éé ee".encode())
    assert [block.words()[i] for i in block.ids()] == [b"aa", b"bb", b"\n", b"cc", b"dd", "éé".encode(), b"ee", b"\n"]
