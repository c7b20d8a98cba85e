"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centre c and widest angle w to a member no inner product of a member a with a
row x is larger than |a| * |x| * cos(max(0, angle(x, c) - w)). The rows are put in the order of this bound (without |a|), once for
each cluster, and all members walk that list from its top: the best so far of a member is certain as soon as it
beats the bound of everything that follows, and the member stops there.

A list is not held anywhere as a whole. Counts of rows by bound cut it into segments of neighbours; the walk takes one
segment, then four times as many, and so on. In a round the members that still walk meet the segments of that round, one
task for each segment and part of the members, and within a task the walk ends in the same way. Rows below
the last segment walked never leave the scan. The first walk finds the positives, the second the negatives under each positive's ceiling.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

from .vectors import best_rows, classes, padded, quantised, scores
from .words import is_empty

#: Anchors for each cluster, and clusters at most: a row is in one list for each cluster.
MEMBERS, CLUSTERS = 256, 64
#: Anchors that the centres are fitted on (those with the smallest hashes), and rounds of fitting.
SAMPLE, ROUNDS = 4_096, 8
#: Numbers that all centres together may have.
CENTRE_NUMBERS = 2**22
#: Rows of a segment, rows of a list that are taken at a time inside a task, classes of bounds.
SEGMENT, STEP, BINS = 4_096, 512, 1_024
#: Members in a task.
PART = 512
#: Bounds are doubles; they are raised by this share of the lengths, so that rounding never ends a walk too early.
SLACK = 1e-9


def centres_of(vectors: list, n: int) -> np.ndarray:
    """Unit vectors: ``n`` centres of a bounded sample, by spherical k-means from evenly spread rows."""
    x = padded(pa.array(vectors, pa.list_(pa.int32())), max(len(v) for v in vectors))
    x = x[np.abs(x).sum(axis=1) > 0]
    if not len(x):
        return np.ones((1, 1))
    x /= np.linalg.norm(x, axis=1)[:, None]
    at = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        own = (x @ at.T).argmax(axis=1)
        for c in np.unique(own):
            mean = x[own == c].sum(axis=0)
            if np.linalg.norm(mean) > 0:
                at[c] = mean / np.linalg.norm(mean)
    return at


def angles(v: pa.Array, n2: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Radians between vectors and centres; 0 for vectors of length zero."""
    length = np.sqrt(np.maximum(1, n2))[:, None]
    return np.where(n2[:, None] > 0, np.arccos(np.clip(padded(v, centres.shape[1]) @ centres.T / length, -1, 1)), 0.0)


class Lists:
    """The order of each cluster's list, as far as the driver needs it: cuts of the bound into segments and rounds."""

    def __init__(self, centres: np.ndarray, wide: np.ndarray, longest: float):
        self.centres, self.wide, self.longest = centres, wide, longest
        self.first, self.pieces, self.rounds, self.ends = {}, {}, {}, {}

    def bounds(self, v: pa.Array, n2: np.ndarray) -> np.ndarray:
        """The bound of each row in each list, for a member of length 1."""
        length = np.sqrt(n2)[:, None]
        return length * np.cos(np.maximum(0, angles(v, n2, self.centres) - self.wide)) + SLACK * self.longest

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        """The class of a bound; 0 has the highest."""
        return np.clip(((self.longest * (1 + SLACK) - bounds) / (2 * self.longest) * BINS).astype(np.int64), 0, BINS - 1)

    def top(self, bin: int) -> float:
        """No bound of this class or a later one is higher."""
        return self.longest * (1 + SLACK) - bin / BINS * 2 * self.longest if bin < BINS else -math.inf

    def cut(self, cluster: int, counts: np.ndarray, segment: int) -> None:
        """Neighbouring classes become segments of about ``segment`` rows (a larger class several), segments become rounds."""
        segments, base, pieces, room = 0, np.zeros(BINS, np.int64), np.ones(BINS, np.int64), 0
        start = []  # first class of each segment
        for b in np.flatnonzero(counts):
            n = int(counts[b])
            if n <= room:
                base[b], room = segments - 1, room - n
                continue
            pieces[b], base[b] = math.ceil(n / segment), segments
            start += [b] * int(pieces[b])
            segments, room = segments + int(pieces[b]), max(0, segment - n)
        self.first[cluster], self.pieces[cluster] = base, pieces
        self.rounds[cluster], self.ends[cluster], at, size = [], [], 0, 1
        while at < segments:
            end = min(segments, at + size)
            while end < segments and start[end] == start[end - 1]:  # a class is walked in one round
                end += 1
            self.rounds[cluster].append((at, end))
            self.ends[cluster].append(self.top(start[end]) if end < segments else -math.inf)
            at, size = end, size * 4


def lists_of(data: DataFrame, centres: np.ndarray, wide: np.ndarray, segment: int) -> Lists:
    lists = Lists(centres, wide, max(1.0, math.sqrt(data.agg(F.max("n2")).first()[0])))

    def count(batches):
        total = np.zeros((len(wide), BINS), dtype=np.int64)
        for b in batches:
            bins = lists.bins(lists.bounds(b["v"], b["n2"].to_numpy()))
            for c in range(len(wide)):
                total[c] += np.bincount(bins[:, c], minlength=BINS)
        c, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(b, pa.int32()), pa.array(total[c, b])], ["cluster", "bin", "n"])

    counted = data.select("v", "n2").mapInArrow(count, "cluster int, bin int, n bigint")
    counts = np.zeros((len(wide), BINS), dtype=np.int64)
    for r in counted.groupBy("cluster", "bin").agg(F.sum("n").alias("n")).collect():  # CLUSTERS x BINS rows at most
        counts[r.cluster, r.bin] = r.n
    for c in range(len(wide)):
        lists.cut(c, counts[c], segment)
    return lists


def _round(data: DataFrame, members: DataFrame, lists: Lists, spans: dict[int, tuple[int, int]], need: int, same: bool, parts: dict[int, int]) -> DataFrame:
    """``a``, ``t``, ``score``, ``id``, ``cls``: the best of each segment of a round for members and their targets."""
    walked = sorted(spans)
    low, high = (np.array([spans[c][i] for c in walked]) for i in (0, 1))
    first, pieces = (np.stack([x[c] for c in walked]) for x in (lists.first, lists.pieces))

    def listed(batches):
        for b in batches:
            bound = lists.bounds(b["v"], b["n2"].to_numpy())[:, walked]
            bins, column = lists.bins(bound), np.arange(len(walked))
            segment = first[column, bins] + (b["cls"].to_numpy()[:, None] * 0x9E3779B1 % 2**31) % pieces[column, bins]
            who, which = np.nonzero((segment >= low) & (segment < high))
            rows = pa.Table.from_batches([b]).select(["cls", "v", "label", "ids"]).take(pa.array(who))
            rows = rows.append_column("cluster", pa.array(np.array(walked)[which], pa.int32()))
            rows = rows.append_column("segment", pa.array(segment[who, which], pa.int32()))
            yield from rows.append_column("bound", pa.array(bound[who, which])).to_batches()

    rows = data.select("cls", "v", "label", "ids", "n2").mapInArrow(
        listed, "cls bigint, v array<int>, label bigint, ids array<bigint>, cluster int, segment int, bound double"
    )
    of = lambda values: F.create_map(*[F.lit(x) for c in walked for x in (c, values[c])])[F.col("cluster")]
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), of(parts) - 1)).alias("part"))
    steps = F.sequence(of({c: spans[c][0] for c in walked}), of({c: spans[c][1] - 1 for c in walked}))
    coming = members.where(F.col("cluster").isin(walked)).select("*", F.explode(steps).alias("segment"))
    key = ["cluster", "segment", "part"]

    def walk(rows: pa.Table, members: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and members.num_rows:
            rows = rows.take(pa.array(np.argsort(-rows["bound"].to_numpy(), kind="stable")))
            width = max(len(v) for v in members["v"])
            bound, label = rows["bound"].to_numpy(), rows["label"].to_numpy()
            cls, ids = rows["cls"].to_pylist(), rows["ids"].to_pylist()
            first, length = np.array([i[0] for i in ids]), np.sqrt(members["n2"].to_numpy())
            a, own, targets = members["a"].to_pylist(), members["label"].to_numpy(), members["targets"].to_pylist()
            best = [{t["t"]: [] for t in ts} for ts in targets]
            open_, x = np.arange(len(a)), padded(members["v"], width)
            for at in range(0, len(cls), STEP):
                met = scores(x[open_], padded(rows["v"].slice(at, STEP), width))
                after = bound[at + STEP] if at + STEP < len(cls) else math.inf
                still = []
                for m, s in zip(open_.tolist(), met, strict=True):
                    fits = (label[at : at + STEP] == own[m]) == same
                    for t in targets[m]:
                        ok = fits & (s >= t["lo"]) & (s <= t["hi"])
                        if ok.any():
                            new = best_rows(s, first[at : at + STEP], ids[at : at + STEP], need, ok)
                            all_ = best[m][t["t"]] + [(v, i, at + c) for v, i, c in new]
                            best[m][t["t"]] = sorted(all_, key=lambda r: (-r[0], r[1]))[:need]
                    # Certified: the last of the best beats what follows, or what follows is below the floor.
                    if any((b[-1][0] if len(b := best[m][t["t"]]) == need else t["lo"] - 1) <= length[m] * after for t in targets[m]):
                        still.append(m)
                open_ = np.array(still, dtype=np.int64)
                if not len(open_):
                    break
            out = [(a[m], t, s, i, cls[c]) for m, ts in enumerate(best) for t, rs in ts.items() for s, i, c in rs]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "t", "score", "id", "cls"), columns, strict=True)})

    met = rows.groupBy(*key).cogroup(coming.groupBy(*key))
    return met.applyInArrow(walk, "a bigint, t bigint, score bigint, id bigint, cls bigint")


def walked(data: DataFrame, members: DataFrame, lists: Lists, need: int, same: bool) -> DataFrame:
    """``a``, ``t``, ``score``, ``id``, ``cls``: the ``need`` best rows for each target of each member.

    ``members``: ``a``, ``v``, ``label``, ``n2``, ``cluster``, ``targets`` (array of ``t``, ``lo``, ``hi``). A target takes rows of the
    same label, or of another one, with a score from ``lo`` to ``hi``; higher scores first, then smaller ids.
    """
    nth = F.row_number().over(Window.partitionBy("a", "t").orderBy(F.col("score").desc(), "id", "cls"))
    found, k = None, 0
    while True:
        left = {r.cluster: r.n for r in members.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        spans = {c: lists.rounds[c][k] for c in left if k < len(lists.rounds[c])}
        if not spans and found is not None:
            return found
        if not spans:
            return members.sparkSession.createDataFrame([], "a bigint, t bigint, score bigint, id bigint, cls bigint")
        parts = {c: math.ceil(n / PART) for c, n in left.items()}
        part = F.create_map(*[F.lit(x) for c in sorted(parts) for x in (c, parts[c])])[F.col("cluster")]
        dealt = members.withColumn("part", F.pmod(F.xxhash64("a"), part).cast("int"))
        new = _round(data, dealt, lists, spans, need, same, parts)
        every = new if found is None else found.unionByName(new)
        found = materialize(every.withColumn("nth", nth).where(F.col("nth") <= need).drop("nth"), "found")
        # Who is certain of all targets leaves: the last of the best beats every bound further down the list.
        end = F.create_map(*[F.lit(x) for c in sorted(left) for x in (c, lists.ends[c][k] if c in spans else -math.inf)])[F.col("cluster")]
        last = found.groupBy("a", "t").agg(F.when(F.count("*") == need, F.min("score")).alias("last"))
        each = members.select("a", "cluster", "n2", F.explode("targets").alias("x")).select("a", "cluster", "n2", "x.*")
        each = each.join(last, ["a", "t"], "left")
        unsure = F.coalesce("last", F.col("lo") - 1) <= F.sqrt("n2") * end
        keep = each.where(unsure).groupBy("a").agg(F.collect_list(F.struct("t", "lo", "hi")).alias("targets"))
        members, k = materialize(members.drop("targets").join(keep, "a"), "members"), k + 1


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, key: str = "vec_id", vector: str = "embedding", members: int = MEMBERS, segment: int = SEGMENT,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    An anchor's positives are the ``positives`` rows of its label with the highest inner product, itself left out. For each of
    them come the first ``negatives`` rows of another label whose score is from ``low`` to ``high`` percent of the positive's (so none
    below a negative positive score). Higher scores come first, ties by smaller id; fewer rows if there are fewer. Rows with a null key, label or vector, and those
    with a null, non-finite or (beyond 2**26 once scaled) huge component take no part. Equal rows are one row; rows that share a key only are
    different rows. A shorter vector counts as filled up with zeros. An empty table gives no row. ``is_anchor`` and
    ``label`` are expressions on ``vectors``; other columns are not read.
    """
    need = positives + 1  # the anchor's own row may be among them
    rows = quantised(vectors, key, vector, scale, label=label.cast("bigint"), anchor=F.coalesce(is_anchor, F.lit(False)))
    rows = rows.where("label is not null")
    data = classes(rows.select("id", "v", "label").distinct(), max(need, negatives), "label")
    asked = rows.where("anchor").select("id", "v", "label").distinct()
    asked = materialize(asked.join(data.select("v", "label", "cls"), ["v", "label"]).select("id", F.col("cls").alias("a")), "asked")
    if is_empty(asked):
        return asked.sparkSession.createDataFrame([], _RESULT)
    anchors = data.join(asked.select(F.col("a").alias("cls")).distinct(), "cls", "left_semi")
    size = anchors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n = max(1, min(CLUSTERS, math.ceil(size.n / members), CENTRE_NUMBERS // max(1, size.width)))
    sampled = max(1, min(SAMPLE, CENTRE_NUMBERS // max(1, size.width)))
    centres = centres_of([r.v for r in anchors.select("v").orderBy(F.xxhash64("v"), "v").limit(sampled).collect()], n)

    def place(batches):
        for b in batches:
            angle = angles(b["v"], b["n2"].to_numpy(), centres)
            own = angle.argmin(axis=1)
            columns = [b["cls"], b["v"], b["label"], b["n2"], pa.array(own, pa.int32()), pa.array(angle[np.arange(len(own)), own])]
            yield pa.RecordBatch.from_arrays(columns, ["a", "v", "label", "n2", "cluster", "angle"])

    placed = anchors.select("cls", "v", "label", "n2").mapInArrow(
        place, "a bigint, v array<int>, label bigint, n2 bigint, cluster int, angle double"
    )
    placed = materialize(placed, "anchors")
    wide = np.full(len(centres), 0.0)
    for r in placed.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        wide[r.cluster] = r.angle + 1e-6
    lists = lists_of(data, centres, wide, segment)
    whole = F.array(F.struct(*[F.lit(x).cast("bigint").alias(c) for c, x in (("t", 0), ("lo", -(2**62)), ("hi", 2**62))]))
    liked = walked(data, placed.drop("angle").withColumn("targets", whole), lists, need, same=True)
    top = liked.groupBy("a").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "cls"))).alias("best"))
    top = materialize(top, "positives")
    # lo = ceil(low * s / 100), hi = floor(high * s / 100) in whole numbers, for each different score.
    s = top.select("a", F.explode(F.array_distinct(F.transform("best", lambda b: -b["s"]))).alias("t"))
    floor = lambda p: F.floor(F.col("t").cast("decimal(38,0)") * p / 100).cast("bigint")
    s = s.select("a", "t", (-floor(-low)).alias("lo"), floor(high).alias("hi")).where("lo <= hi")
    s = s.groupBy("a").agg(F.collect_list(F.struct("t", "lo", "hi")).alias("targets"))
    disliked = walked(data, materialize(placed.drop("angle").join(s, "a"), "members"), lists, negatives, same=False)
    under = disliked.groupBy("a", "t").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("worst"))
    others = F.filter("best", lambda b: ~((b["id"] == F.col("id")) & (b["cls"] == F.col("a"))))
    each = asked.join(top, "a").select("a", F.col("id").alias("anchor_id"), F.explode(F.slice(others, 1, positives)).alias("p"))
    each = each.select("a", "anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.s")).alias("t")).join(materialize(under, "negatives"), ["a", "t"])
    each = each.select("anchor_id", "positive_id", F.col("t").alias("positive_score"), F.posexplode("worst").alias("place", "b"))
    return each.select(
        "anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("b.id").alias("negative_id"), "positive_score",
        (-F.col("b.s")).alias("negative_score"),
    )


_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
