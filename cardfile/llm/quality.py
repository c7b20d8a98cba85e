"""Quality rules as a short-circuit cascade.

Every rule is a boolean column over facts of the text. On a bounded sample the cost of each rule (seconds) and what it
rejects are measured; rules then run in the order of rejections per cost, counted on what the rules before them
leave. One ``CASE`` evaluates them, so a rule runs only on texts that no earlier rule has rejected. The order
changes the cost alone: a text is kept if no rule rejects it, whatever the order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfile.session import materialize

from .words import count_of, free_name, let, n_words, whole_text, windows, word_chars, words

SYMBOLS = "#*$%&|<>"
#: Rows on which cost and selectivity are measured. Only the order of the rules follows from them.
SAMPLE_ROWS = 1_000


class Facts:
    """What rules ask of a text, as columns: computed from the text, or taken from columns that hold it already."""

    def __init__(self, text: Column, **known: Column):
        self.text, self._known = text, known

    def __getattr__(self, name: str) -> Column:
        return self._known[name] if name in self._known else _FACTS[name](self.text)


@dataclass(frozen=True)
class Rule:
    """A name and a function from the facts of a text to a boolean column that is true for a rejected text."""

    name: str
    rejects: Callable[[Facts], Column]


def n_duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_lines(text: Column) -> Column:
    """Lines with a word: each is one match from its first word on."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D][^\n]*+")).cast("long")


def n_repeated_words(tokens: Column, k: int = 3) -> Column:
    """Words that lie in a run of ``k`` words found twice or more in the text, by the 64-bit hash of the run.

    The hashes are sorted with their places, so equal runs are neighbours: n log n for a text of n words.
    """

    def covered(keyed):
        same = lambda x, j: F.coalesce(F.get(keyed, j)["h"] == x["h"], F.lit(False))
        starts = F.transform(F.filter(keyed, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["p"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + (k - 1))))))

    def counted(hashes):
        keyed = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        # Most texts repeat no run: their hashes need no sorting.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(keyed, covered))

    return let(windows(tokens, k), counted).cast("long")


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed (null text: empty)."""
    tokens = free_name(docs, "_words")
    t = whole_text(text)
    out = docs.withColumn(tokens, words(t)).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(tokens).cast("long").alias("n_words"),
        word_chars(t).alias("word_chars"),
        count_of(t, SYMBOLS).alias("n_symbols"),
        n_duplicate_lines(t).alias("n_dup_lines"),
        n_repeated_words(F.col(tokens)).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _base_fails(text: Column) -> Column:
    return let(words(text), lambda w: (F.size(w) < 50) | (100 * n_repeated_words(w) > 50 * F.size(w)))


def _without(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


_FACTS = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": lambda t: count_of(t, SYMBOLS),
    "n_lines": n_lines,
    "n_dup_lines": n_duplicate_lines,
    "n_letters": lambda t: _without(t, r"\p{L}+"),
    "n_capitals": lambda t: _without(t, r"\p{Lu}+"),
    "base_failed": _base_fails,
}

#: Thresholds are far from what prose in any of the languages shows; see the tests for clean texts.
RULES = (
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 20 * f.n_words)),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > f.n_lines),
    Rule("few_letters", lambda f: 2 * f.n_letters < f.word_chars),
    Rule("capitals", lambda f: 2 * f.n_capitals > f.n_letters),
)
BASE = Rule("base", lambda f: f.base_failed)


def measure(docs: DataFrame, rules, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules in the order to run them, each with its seconds and what it rejects of what is left.

    Works on ``sample_rows`` rows at most. An empty table leaves the rules in the order given.
    """
    sample = materialize(docs.select(whole_text(text).alias("t")).limit(sample_rows), "rules")
    seconds = {}
    for rule in rules:
        times = []
        for _ in range(2):  # the first run compiles
            start = time.perf_counter()
            sample.agg(F.count_if(rule.rejects(Facts(F.col("t"))))).collect()
            times.append(time.perf_counter() - start)
        seconds[rule.name] = min(times)
    # One row for each pattern of verdicts: at most 2 to the number of rules, however many rows.
    flags = [F.coalesce(r.rejects(Facts(F.col("t"))), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    patterns = [tuple(x) for x in sample.select(*flags).groupBy(*[f"r{i}" for i in range(len(rules))]).count().collect()]
    left, order = list(range(len(rules))), []
    while left:
        hits = {i: sum(p[-1] for p in patterns if p[i]) for i in left}
        best = max(left, key=lambda i: (hits[i] / max(seconds[rules[i].name], 1e-6), -i))
        order.append({"rule": rules[best], "seconds": seconds[rules[best].name], "rejected": hits[best]})
        patterns = [p for p in patterns if not p[best]]
        left.remove(best)
    return order


def rejected_by(facts: Facts, ordered) -> Column:
    """The first rule, in the given order, that rejects the text; null for a text that is kept."""
    out = F
    for rule in ordered:
        out = out.when(rule.rejects(facts), F.lit(rule.name))
    return out


def quality_cascade(
    docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, name: str = "rejected_by"
) -> DataFrame:
    """``docs`` with the rule that rejects a row, or null.

    Null and empty texts are judged as empty ones. Repeated rows are judged alike, an empty table stays empty,
    other columns (also one called ``name``, which is replaced) do not matter.
    """
    order = [x["rule"] for x in measure(docs, rules, text, sample_rows)]
    return docs.withColumn(name, rejected_by(Facts(whole_text(text)), order))


def keep_good(docs: DataFrame, rules=(BASE, *RULES), text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows that no rule rejects, columns as they were."""
    why = free_name(docs, "_rejected_by")
    return quality_cascade(docs, rules, text, sample_rows, why).where(F.col(why).isNull()).drop(why)
