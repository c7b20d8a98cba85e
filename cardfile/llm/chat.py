"""Chat formatting: layouts are told apart by a fingerprint of their field paths and mapped to canonical turns.

A record may be a prompt with a completion, an instruction with input and output, a list of messages or a single
turn. The paths of the fields that a row fills (``messages[].role``) are hashed; the hash selects a declarative
mapping. Turns are then written with marks around them; control strings inside texts are escaped, so the formatted
text can be read back exactly, and the loss mask covers what an assistant says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import free_name, let

TURNS = "array<struct<role:string,text:string>>"
#: Escapes in the order of escaping. The escape sign comes first there and last on the way back.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"


@dataclass(frozen=True)
class Mapping:
    """``needs`` and ``may`` are field paths; ``turns`` makes the canonical turns from a function that gives a field."""

    name: str
    needs: tuple[str, ...]
    turns: Callable[[Callable[[str], Column]], Column]
    may: tuple[str, ...] = field(default=())

    def fingerprints(self) -> list[str]:
        """One for each choice of the optional paths."""
        picks = [c for n in range(len(self.may) + 1) for c in combinations(self.may, n)]
        return [path_hash((*self.needs, *c)) for c in picks]

    def paths(self) -> tuple[str, ...]:
        return (*self.needs, *self.may)


def path_hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def turn(role, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.struct(blank(role).alias("role"), blank(text).alias("text"))


_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _known_role(role: Column) -> Column:
    out = role
    for said, meant in _NAMES.items():
        out = F.when(F.lower(role) == said, meant).otherwise(out)
    return out


def _asked(f, *names: str) -> Column:
    """The filled ones of some fields, with an empty line between."""
    return F.concat_ws("\n\n", *[F.when(f(n) != "", f(n)) for n in names])


MAPPINGS = (
    Mapping("turn_row", (), lambda f: F.array(turn(f("role"), f("text"))), ("turn", "role", "text")),
    Mapping(
        "messages",
        ("messages[].role",),
        lambda f: F.transform(f("messages"), lambda m: turn(m["role"], m["content"])),
        ("messages[].content",),
    ),
    Mapping(
        "conversations",
        ("conversations[].from",),
        lambda f: F.transform(f("conversations"), lambda m: turn(_known_role(m["from"]), m["value"])),
        ("conversations[].value",),
    ),
    Mapping(
        "prompt",
        ("prompt", "completion"),
        lambda f: F.concat(
            F.when(F.coalesce(f("system"), F.lit("")) != "", F.array(turn("system", f("system")))).otherwise(
                F.array().cast(TURNS)
            ),
            F.array(turn("user", f("prompt")), turn("assistant", f("completion"))),
        ),
        ("system",),
    ),
    Mapping(
        "instruction",
        ("instruction", "output"),
        lambda f: F.array(turn("user", _asked(f, "instruction", "input")), turn("assistant", f("output"))),
        ("input",),
    ),
)


def _field(df: DataFrame, path: str) -> tuple[Column, T.DataType] | None:
    """A column by its name, or a field inside structs by names with dots between; null if the table has none."""
    kinds = {f.name: f.dataType for f in df.schema}
    if path in kinds:
        return F.col(f"`{path}`"), kinds[path]
    top, *rest = path.split(".")
    if top not in kinds:
        return None
    column, kind = F.col(f"`{top}`"), kinds[top]
    for name in rest:
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return None
        column, kind = column[name], kind[name].dataType
    return column, kind


def _leaf(df: DataFrame, path: str) -> Column | None:
    """Whether a row fills the path; null if the table has no such field."""
    top, _, rest = path.partition("[].")
    if (found := _field(df, top)) is None:
        return None
    column, kind = found
    if not rest:
        return None if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else column.isNotNull()
    element = kind.elementType if isinstance(kind, T.ArrayType) else None
    names = rest.split(".")
    for name in names:
        if not isinstance(element, T.StructType) or name not in element.fieldNames():
            return None
        element = element[name].dataType

    def inside(m: Column) -> Column:
        for name in names:
            m = m[name]
        return m.isNotNull()

    return F.coalesce(F.exists(column, inside), F.lit(False))


def with_fingerprint(df: DataFrame, name: str = "layout", mappings=MAPPINGS) -> DataFrame:
    """``df`` with the hash of the field paths that the row fills. Paths that no mapping names do not count."""
    paths = sorted({p for m in mappings for p in m.paths()})
    filled = {p: c for p in paths if (c := _leaf(df, p)) is not None}
    if not filled:
        return df.withColumn(name, F.lit(path_hash(())))
    present = F.concat_ws("\n", *[F.when(c, F.lit(p)) for p, c in filled.items()])
    return df.withColumn(name, F.sha2(present, 256))


def with_turns(df: DataFrame, name: str = "turns", mappings=MAPPINGS) -> DataFrame:
    """``df`` with the canonical turns of each row, null if no mapping fits its layout.

    A mapping whose paths are those that the row fills comes first. If there is none, the first one takes the row whose
    needed paths the row fills; one that needs none takes rows with any of its paths, after the others. A null text or role is an
    empty one. Repeated rows are mapped alike; an empty table stays empty; columns that no mapping names do not
    matter, one called ``name`` is replaced.
    """
    layout = free_name(df, "_layout")
    marked = with_fingerprint(df, layout, mappings)

    def get(n: str) -> Column:
        found = _field(df, n)
        return F.lit(None).cast("string") if found is None else found[0]

    def one(m: Mapping) -> Column | None:
        if any(_leaf(df, p) is None for p in m.needs) or not any(_leaf(df, p) is not None for p in m.paths()):
            return None
        return m.turns(get).cast(TURNS)

    def fits(m: Mapping) -> Column:
        if m.needs:
            return reduce(Column.__and__, [_leaf(df, p) for p in m.needs])
        return reduce(Column.__or__, [c for p in m.may if (c := _leaf(df, p)) is not None])

    turns, seen = F.when(F.lit(False), F.lit(None).cast(TURNS)), set()
    for m in mappings:
        known = [p for p in m.fingerprints() if p not in seen]
        seen.update(known)
        if known and (made := one(m)) is not None:
            turns = turns.when(F.col(layout).isin(known), made)
    for m in sorted(mappings, key=lambda m: not m.needs):
        if (made := one(m)) is not None:
            turns = turns.when(fits(m), made)
    return marked.withColumn(name, turns).drop(layout)


def escape(text: Column) -> Column:
    for sign, code in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for sign, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def segments(turns: Column) -> Column:
    """Pieces of the formatted text, in order, with whether loss is counted on them."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    none = F.lit(False)
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                piece(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)), none),
                piece(escape(t["text"]), t["role"] == "assistant"),
                piece(F.lit(END), none),
            ),
        )
    )


def formatted(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def read_turns(text: Column) -> Column:
    """The turns of a formatted text. Escaped texts hold no bracket, so the marks are the only ones."""
    pieces = F.filter(F.split(text, END, -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: let(
            F.substring_index(p, CLOSE, 1),
            lambda head: F.struct(
                unescape(F.substring(head, F.lit(len(OPEN) + 1), F.length(head))).alias("role"),
                unescape(F.substring(p, F.length(head) + 2, F.length(p))).alias("text"),
            ),
        ),
    )


def read_loss(pieces: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: p["text"]), ""))


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """``df`` with ``segments`` (text, loss) and ``formatted``; null turns have no segment and an empty text."""
    made = F.coalesce(F.col(turns), F.array().cast(TURNS))
    return df.withColumn("segments", segments(made)).withColumn("formatted", formatted(F.col("segments")))


def unmapped(rows: DataFrame, name: str = "layout", mappings=MAPPINGS) -> DataFrame:
    """The rows that no mapping fits, with the hash of the paths they fill: what ``collect_turns`` does not have."""
    turns = free_name(rows, "_turns")
    return with_fingerprint(with_turns(rows, turns, mappings).where(F.col(turns).isNull()).drop(turns), name, mappings)


def collect_turns(rows: DataFrame, conversation: str, order: str, mappings=MAPPINGS) -> DataFrame:
    """``conversation``, ``turns`` from rows that each hold one turn or more, in the order of ``order`` (null first).

    Rows of equal order are put by role and text; repeated rows are repeated turns; a null conversation is one. A
    conversation is one row of the result and so must fit into memory; nothing else is gathered. Rows that no mapping
    fits are in ``unmapped``.
    """
    each = with_turns(rows, "_turns", mappings).select(
        F.col(f"`{conversation}`").alias(conversation), F.col(f"`{order}`").alias("at"), F.col("_turns").alias("turns")
    )
    grouped = each.where("turns is not null").groupBy(conversation).agg(F.sort_array(F.collect_list(F.struct("at", "turns"))).alias("t"))
    return grouped.select(conversation, F.flatten(F.transform("t", lambda x: x["turns"])).alias("turns"))
