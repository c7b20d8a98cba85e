"""Personal data: base patterns, and boosted trees that judge what looser generators propose.

Base spans are the matches of four strict patterns that pass their check (octets, Luhn, number of digits); they are
always reported. What they cover is blanked, then loose generators propose spans in the rest: addresses with spelled
or spaced signs, dotted and spaced card numbers, phone numbers without a plus sign. One stretch may be proposed as
several kinds. Boosted trees score a proposal by its format and by what stands around it. They are trained on a
bounded sample: base spans and proposals after a word for their kind (call, mail, card) are the positive rows; what fails
a check, what follows a word for another number (order, version, invoice) and a bare number that nothing calls a phone
are negative. The threshold of a kind is the lowest score that keeps the stated precision on rows held out of the
training. Everything is DataFrame work; the trees become column expressions, so no span is shuffled to be scored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardfile.session import materialize

from .words import free_name, let, whole_text

KINDS = ("email", "ip", "card", "phone")
#: The patterns with possessive repeats and anchored starts: the same matches, in linear time on junk.
#: A match starts at the first character of a run, or where the match before has ended (\G).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HOST = r"[A-Za-z0-9-]{1,63}"
_SPELLED = r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
_MORE = rf"(?:(?:\.|{_SPELLED}){_HOST}){{0,8}}"
#: A sign or a bracketed word may be followed by plain dots; a bare "at" needs a spelled dot, or prose would fit.
_AT_HOST = (
    rf"(?:(?:\x20?@\x20?|\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?){_HOST}{_MORE}(?:\.|{_SPELLED})|\x20at\x20{_HOST}{_MORE}{_SPELLED}(?:{_HOST}\.)?)"
)
LOOSE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT_HOST}[A-Za-z]{{2,24}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\x20\.\x20?|\.\x20)[0-9]{1,3}+){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{4}){2}[._/\x20-]{1,2}[0-9]{1,7}(?![0-9])",
    "phone": (
        r"(?<![0-9A-Za-z.,])(?:(?:00[1-9]|0[1-9]|\([0-9]{2,5}\)|[2-9][0-9]{2}[-.][0-9]{3})(?:[\x20()./-]{0,2}[0-9]){5,12}"
        r"|[2-9][0-9]{2}[-.\x20][0-9]{3}[-.\x20][0-9]{4}|[1-9][0-9]{8,14})(?![0-9])"
    ),
}
#: A text without any of these characters has no span of any kind.
_HINT = r"[0-9@]|(?i:\x20dot\x20|[(\[{](?:at|dot)[)\]}])"
_AROUND, _CHUNK, _BLOCK = 24, 128, 1024
FEATURES = (
    "kind", "length", "digits", "parts", "plus", "brackets", "dots", "gaps", "at_sign", "lead_zero", "luhn",
    "word_before", "word_after", "says_email", "says_ip", "says_card", "says_phone", "says_other",
)
SAYS = {
    "says_email": r"(?i)mail|contact|write to",
    "says_ip": r"(?i)\bip\b|host|server|address",
    "says_card": r"(?i)card|visa|credit|amex",
    "says_phone": r"(?i)tel|phone|call|fax|mobil|cell",
    "says_other": (
        r"(?i)\b(?:order|invoice|version|release|build|ticket|serial|tracking|article|item|isbn|issn|sku|part|ref|reference|"
        r"case|account|customer|id|date|section|chapter)(?:\W{0,3}\b(?:number|no|nr|id))?\W{0,3}$"
    ),
}
#: Values of a feature that has more than two, from 0. The trees see whether a feature is above each value but the last: these
#: splits are all there are, where ``pyspark.ml`` would take those of a number from a sample of the rows.
LEVELS = {"kind": 4, "length": 65, "digits": 33, "parts": 17}
STEPS = [(name, step) for name in FEATURES for step in range(LEVELS.get(name, 2) - 1)]
#: Parts of the labelled rows, different rows that one task learns from, and the precision that the thresholds keep.
FOLDS, TOGETHER, PRECISION = 3, 200_000, 0.98


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v)


def _luhn(digits: Column) -> Column:
    def total(d):
        n = F.length(d)
        each = F.transform(
            F.sequence(F.lit(1), n),
            lambda i: let(
                F.substring(d, i, F.lit(1)).cast("int") * (1 + (n - i) % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)
            ).cast("bigint"),
        )
        return (n > 0) & (_sum(each) % 10 == 0)

    return let(digits, total)


def _passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        octet = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substring(p, -3, 3).cast("int") <= 255)
        return F.forall(F.split(match, r"\."), octet)
    d = _digits(match)
    if kind == "card":
        return F.length(d).between(12, 19) & _luhn(d)
    return F.length(d).between(9, 15)


def _before(values: Column, combine, total) -> Column:
    """What the entries before each one add up to (0 before the first), by chunks: n entries cost n to the power 1.5."""

    def running(part, start):
        return F.aggregate(
            part,
            F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda a, v: F.struct(combine(a["at"], v).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"],
        )

    def whole(x):
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _CHUNK).cast("int")), lambda c: F.slice(x, c * _CHUNK + 1, _CHUNK)
        )
        return let(
            chunks,
            lambda cs: F.flatten(F.zip_with(cs, running(F.transform(cs, total), F.lit(0).cast("bigint")), running)),
        )

    return F.when(F.size(values) > 0, let(values, whole)).otherwise(F.array().cast("array<bigint>"))


_SPAN = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Places (code points, end exclusive) of the leftmost non-overlapping matches, with what stands around them."""

    def placed(found, pieces):
        lengths = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: (F.length(p) + F.length(m)).cast("bigint"))
        starts = _before(lengths, lambda a, v: a + v, _sum)
        return let(
            starts,
            lambda s: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(s, i) + F.length(F.get(pieces, i))).alias("start"),
                    (F.get(s, i) + F.length(F.get(pieces, i)) + F.length(m)).alias("end"),
                    m.alias("match"),
                    F.right(F.get(pieces, i), F.lit(_AROUND)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(_AROUND)).alias("after"),
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(
            F.size(found) > 0, let(F.split(text, pattern, -1), lambda pieces: placed(found, pieces))
        ).otherwise(F.array().cast(_SPAN)),
    )


def _cut(text: Column, spans: Column, put) -> Column:
    """The text with every span (sorted, disjoint) replaced by ``put(span)``; a piece is put together from blocks of the text."""
    zero = F.lit(0).cast("bigint")

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / _BLOCK).cast("bigint"), F.floor((b - 1) / _BLOCK).cast("bigint")

        def part(i):
            skip = F.greatest(a - i * _BLOCK, zero)
            return F.substring(F.get(blocks, i.cast("int")), (skip + 1).cast("int"), (F.least(b - i * _BLOCK, F.lit(_BLOCK)) - skip).cast("int"))

        return F.when(b > a, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")

    starts = F.concat(F.array(zero), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("bigint")))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    return let(
        F.struct(F.arrays_zip(starts.alias("a"), ends.alias("b")).alias("kept"), F.transform(spans, put).alias("put"), blocks.alias("blocks")),
        lambda x: F.array_join(
            F.transform(x["kept"], lambda k, i: F.concat(piece(x["blocks"], k["a"], k["b"]), F.coalesce(F.get(x["put"], i), F.lit("")))), ""
        ),
    )


def _merged(spans: Column) -> Column:
    """Sorted spans (``start``, ``end``, ``kind``) with overlapping ones joined; the kind is that of the first."""

    def joined(s):
        ends = F.transform(s, lambda x: x["end"])

        def heads(reached):
            """Spans that start where all spans before have ended; each lasts as far as those before the next have reached."""
            first = F.filter(
                F.transform(s, lambda x, i: F.struct(i.alias("i"), x["start"].alias("start"), x["kind"].alias("kind"))),
                lambda h: h["start"] >= F.get(reached, h["i"]),
            )
            return let(
                F.struct(first.alias("h"), F.array_max(ends).alias("last")),
                lambda y: F.transform(
                    y["h"],
                    lambda h, j: F.struct(
                        h["start"].alias("start"),
                        F.coalesce(F.get(reached, F.get(y["h"], j + 1)["i"]), y["last"]).alias("end"),
                        h["kind"].alias("kind"),
                    ),
                ),
            )

        return let(_before(ends, lambda a, v: F.greatest(a, v), F.array_max), heads)

    return F.when(F.size(spans) > 0, let(spans, joined)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>"))


def _features(kind: Column, s) -> Column:
    m, d = s["match"], _digits(s["match"])
    has = lambda x, p: x.rlike(p).cast("double")
    values = {
        "kind": kind.cast("double"),
        "length": F.least(F.length(m), F.lit(64)).cast("double"),
        "digits": F.least(F.length(d), F.lit(32)).cast("double"),
        "parts": F.least(F.regexp_count(m, F.lit("[0-9]+")), F.lit(16)).cast("double"),
        "plus": has(m, r"^\+|^00"),
        "brackets": has(m, r"[()\[\]{}]"),
        "dots": has(m, r"\.|(?i)dot"),
        "gaps": has(m, r"[\x20/_-]"),
        "at_sign": has(m, r"@|(?i)\bat\b"),
        "lead_zero": has(m, "^0"),
        "luhn": _luhn(d).cast("double"),
        "word_before": has(s["before"], r"[\p{L}\p{N}]$"),
        "word_after": has(s["after"], r"^[\p{L}\p{N}]"),
        **{k: has(s["before"], p) for k, p in SAYS.items()},
    }
    return F.struct(*[values[k].alias(k) for k in FEATURES])


def _hard_fail(kind: str, m: Column) -> Column:
    """What cannot be of the kind: these are the negative rows."""
    d = _digits(m)
    if kind == "email":
        return m.rlike(r"[0-9]$") | ~m.rlike("[A-Za-z]")
    if kind == "ip":
        return F.exists(F.filter(F.split(m, "[^0-9]+"), lambda p: p != ""), lambda p: p.cast("int") > 255)
    if kind == "card":
        return ~(F.length(d).between(12, 19) & _luhn(d))
    return ~F.length(d).between(9, 15)


def _label(kind: str, s: Column) -> Column:
    """Of a proposal: 0 if it is of no use, 2 if the words before it name its kind, null if nothing tells."""
    says = s["before"].rlike(SAYS[f"says_{kind}"])
    other = s["before"].rlike(SAYS["says_other"])
    if kind == "phone":
        other = other | (~s["match"].rlike("[^0-9]") & ~s["match"].startswith("0") & ~says)
    return F.when(_hard_fail(kind, s["match"]) | other, F.lit(0)).when(says, F.lit(2))


def _row(kind: int, s: Column, label: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        label.cast("int").alias("label"), s["match"].alias("match"), s["before"].alias("before"), s["after"].alias("after"),
    )


def _hinted(text: Column, found: Column) -> Column:
    return F.when(text.rlike(_HINT), found.cast(f"array<{_ROW}>")).otherwise(F.array().cast(f"array<{_ROW}>"))


def _strict(text: Column) -> Column:
    """What the base patterns match; label 1 if it passes the check, else 0."""
    each = lambda k: lambda s: _row(k, s, _passes(KINDS[k], s["match"]))
    return _hinted(text, F.concat(*[F.transform(matches(text, BASE[name]), each(k)) for k, name in enumerate(KINDS)]))


def _covered(strict: Column) -> Column:
    """What base spans cover, in order and without overlaps."""
    good = F.transform(
        F.filter(strict, lambda s: s["label"] == 1),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return _merged(F.sort_array(good))


def _blanked(text: Column, covered: Column) -> Column:
    blank = lambda s: F.repeat(F.lit("\x01"), (s["end"] - s["start"]).cast("int"))
    return F.when(F.size(covered) > 0, _cut(text, covered, blank)).otherwise(text)


def _loose(blanked: Column) -> Column:
    """What the loose generators propose in the rest of a text."""
    each = lambda k: lambda s: _row(k, s, _label(KINDS[k], s))
    return _hinted(blanked, F.concat(*[F.transform(matches(blanked, LOOSE[name]), each(k)) for k, name in enumerate(KINDS)]))


def spans_of(text: Column) -> Column:
    """All spans of a text: struct of ``kind`` (place in KINDS), places, what stands around, and ``label``.

    ``label`` is 1 for a base span, 0 for one that fails its check or is said to be something else. Proposals that are to
    be scored have 2 if the words before them name their kind, else null.
    """
    return let(_strict(text), lambda s: F.concat(s, let(let(_covered(s), lambda c: _blanked(text, c)), _loose)))


def with_spans(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with the spans of ``text`` as ``name``, as ``spans_of`` gives them, found in steps: a short plan."""
    strict, rest = free_name(docs, "_strict"), free_name(docs, "_rest")
    found = docs.withColumn(strict, _strict(text)).withColumn(rest, _covered(F.col(strict)))
    found = found.withColumn(rest, _blanked(text, F.col(rest))).withColumn(rest, _loose(F.col(rest)))
    return found.withColumn(name, F.concat(strict, rest)).drop(strict, rest)


_ROW = "struct<kind:int,start:bigint,end:bigint,label:int,match:string,before:string,after:string>"


def _tree(node, f: Column) -> Column:
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    name, step = STEPS[node.split().featureIndex()]
    low, high = node.leftChild(), node.rightChild()
    if 0.0 not in list(node.split().leftCategories()):
        low, high = high, low
    return F.when(f[name] <= float(step), _tree(low, f)).otherwise(_tree(high, f))


def _fitted(data: DataFrame, rounds: int, depth: int):
    """Score of a features column by trees that learn from all rows of ``data``; None without both labels."""
    if len(data.select("label").distinct().take(2)) < 2:
        return None
    gbt = GBTClassifier(labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=7, subsamplingRate=1.0)
    model = gbt.fit(data.select("label", "weight", "features"))
    roots, weights = [t._java_obj.rootNode() for t in model.trees], list(model.treeWeights)

    def score(f: Column) -> Column:
        total = F.lit(0.0)
        for root, weight in zip(roots, weights, strict=True):
            total = total + F.lit(float(weight)) * _tree(root, f)
        return 1 / (1 + F.exp(-2 * total))

    return score


def train(spans: DataFrame, rounds: int = 10, depth: int = 3):
    """(score of a features column, threshold for each kind) from all labelled rows of ``spans``.

    Equal rows are one row with a weight, which bounds the table to learn from by the different features. Each row is in
    one of FOLDS parts by its hash. The trees learn from all parts. For the thresholds a row is scored by trees that
    have learned from the other parts. None if there are not both labels to learn from.
    """
    fold = F.pmod(F.xxhash64("id", "kind", "start", "end"), F.lit(FOLDS)).cast("int")
    rows = spans.where("label is not null").select(fold.alias("fold"), "kind", F.least("label", F.lit(1)).alias("label"), "f")
    grouped = materialize(rows.groupBy("fold", "kind", "label", "f").agg(F.count("*").cast("double").alias("weight")), "counted")
    # Sums over one partition have one order, so reruns agree; only a table of very many different rows has more.
    parts = max(1, math.ceil(grouped.count() / TOGETHER))
    steps = [
        (F.col("f")[name] > float(step)).cast("double").alias(f"{name}_{step}", metadata={"ml_attr": {"type": "binary"}})
        for name, step in STEPS
    ]
    flat = grouped.repartition(parts, "f").sortWithinPartitions("fold", "kind", "label", "f").select("*", *steps)
    data = VectorAssembler(inputCols=flat.columns[len(grouped.columns) :], outputCol="features").transform(flat)
    data = materialize(data.select(*grouped.columns, "features"), "training")
    # One after the other: side by side their hundreds of short jobs fill the driver's memory.
    score, *others = [_fitted(t, rounds, depth) for t in (data, *[data.where(F.col("fold") != k) for k in range(FOLDS)])]
    if score is None:
        return None
    unseen = F.coalesce(*[F.when(F.col("fold") == k, s(F.col("f"))) for k, s in enumerate(others) if s], F.lit(None).cast("double"))
    return score, _thresholds(data.select("kind", "label", "weight", F.round(unseen, 6).alias("s")))


def _thresholds(scored: DataFrame) -> dict[int, float]:
    """For each kind the lowest score ``s`` at and above which rows are right to the share PRECISION.

    A kind without a negative row or without a positive one takes the highest threshold of the others. Rows without a score, as
    the parts without them lack a label, do not count.
    """
    good = F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0))
    table = scored.where("s is not null").groupBy("kind", "s").agg(good.alias("good"), F.sum("weight").alias("all"))
    # Scores have six digits, so a kind has a million of them at most.
    kind = W.partitionBy("kind")
    down = kind.orderBy(F.desc("s")).rowsBetween(W.unboundedPreceding, 0)
    summed = table.select(
        "kind", "s", F.sum("good").over(down).alias("good"), F.sum("all").over(down).alias("all"),
        F.sum("good").over(kind).alias("of_good"), F.sum("all").over(kind).alias("of_all"),
    )
    least = summed.where((F.col("of_good") > 0) & (F.col("of_good") < F.col("of_all")) & (F.col("good") >= PRECISION * F.col("all")))
    return {r["kind"]: r["s"] for r in least.groupBy("kind").agg(F.min("s").alias("s")).collect()}


def find_spans(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with ``name``: array of (``start``, ``kind``, ``end``, ``base``), sorted; kind is the place in KINDS.

    Null and empty texts have no span. Repeated rows are judged alike, an empty table stays empty, other columns do
    not matter (one called ``name`` is replaced). The texts are scanned twice: once for the labelled rows, once for
    the result.
    """
    t = whole_text(text)
    mark = free_name(docs, "_found")
    hinted = with_spans(docs.where(t.rlike(_HINT)).select(t.alias("text")), F.col("text"), "spans")
    # The text itself must not go along with each of its spans. An inner generator would add a filter on their number,
    # which is pushed below the steps and finds all spans once more.
    labelled = hinted.select(F.xxhash64("text").alias("id"), "spans").select("id", F.inline_outer("spans")).where("label is not null")
    around = {c: F.col(c) for c in ("match", "before", "after")}
    model = train(labelled.select("id", "kind", "start", "end", "label", _features(F.col("kind"), around).alias("f")))
    if model is None:
        chosen = lambda s: s["label"] == 1
    else:
        score, thresholds = model
        other = max(thresholds.values(), default=1.0)
        least = F.array(*[F.lit(thresholds.get(k, other)) for k in range(len(KINDS))])

        def chosen(s):
            judged = F.round(let(_features(s["kind"], s), score), 6) >= F.get(least, s["kind"])
            return F.when(s["label"] == 1, True).when(s["label"] == 0, False).otherwise(judged)

    picked = F.transform(
        F.filter(mark, lambda s: F.coalesce(chosen(s), F.lit(False))),
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.coalesce(s["label"] == 1, F.lit(False)).alias("base"),
        ),
    )
    return with_spans(docs, t, mark).withColumn(name, F.sort_array(picked)).drop(mark)


def digest_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The texts with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    A text without a span, also null, stays as it is. ``n_chars``, if the table has it, is counted anew where the
    text changes. Columns as they were.
    """
    mark = free_name(docs, "_spans")
    found = find_spans(docs, text, mark)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    plain = F.transform(
        F.col(mark), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    cleaned = let(_merged(plain), lambda g: _cut(whole_text(text), g, lambda s: F.element_at(names, s["kind"] + 1)))
    new = F.when(F.size(mark) > 0, cleaned).otherwise(F.col(f"`{text}`"))
    changed = free_name(docs, "_changed")
    out = found.withColumn(changed, F.size(mark) > 0).withColumn(text, new)
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(changed), F.length(text)).otherwise(F.col(n_chars)).cast(docs.schema[n_chars].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
