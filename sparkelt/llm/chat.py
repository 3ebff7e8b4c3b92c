"""Chat formatting: conversations to marked text in segments, each with a loss flag, and back.

A template is data: what opens and closes a turn of each role, which roles bear loss, and the
transitions of a finite-state machine over roles. A state is what the last turn was, so the machine
runs on a row and the one before it. Control strings inside texts are escaped, so the formatted text
alone tells turns, roles and texts; ``read_back`` does so in a stream, holding one turn at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import importable

ESCAPE = "\\"
#: Rows taken out of a batch at once.
ROWS_AT_ONCE = 512
#: Segments of a turn: opening, text, closing.
PIECES = 3


@dataclass(frozen=True)
class Turn:
    """How a role's turn is written. ``loss``: its text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of a conversation and of its turns, and the turn order.

    ``begin`` opens a conversation. ``turns`` gives the marks by role; a role without marks is
    written with ``other``, a mark, the escaped role, a mark, the text and a mark. At most one role
    may have an empty opening: whatever no mark opens is its turn. ``first`` are the roles that may
    come first, ``follows`` maps a state, the role of the last turn, to those that may come next, and
    ``ends`` are those that may come last. Control strings begin with a character that they hold only
    there, so none can arise where a text meets a mark.
    """

    begin: str
    turns: Mapping[str, Turn]
    other: tuple[str, str, str]
    first: tuple[str, ...]
    follows: Mapping[str, tuple[str, ...]]
    ends: tuple[str, ...]

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        if ESCAPE in "".join(self.controls) or any(h in c[1:] for c in self.controls for h in heads):
            raise ValueError("a control string begins with a character that no control string holds elsewhere")
        opens = [self.other[0], *[t.open for t in self.turns.values()]]
        if any(a.startswith(b) for i, a in enumerate(opens) for j, b in enumerate(opens) if b and i != j) or opens.count("") > 1:
            raise ValueError("no opening of a turn begins another one")
        if not all([self.begin.strip(), *[m.strip() for m in self.other], *[t.close.strip() for t in self.turns.values()]]):
            raise ValueError("a conversation has an opening mark, every turn a closing one")

    @property
    def controls(self) -> list[str]:
        """All marks, without the white space around them."""
        marks = [self.begin, *self.other, *[m for t in self.turns.values() for m in (t.open, t.close)]]
        return sorted({m.strip() for m in marks if m.strip()})


INSTRUCT = Template(
    begin="<s>",
    turns={
        "system": Turn("[SYS] ", " [/SYS]"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("", "</s>", loss=True),
    },
    other=("[TURN] ", " [TEXT] ", " [/TURN]"),
    first=("system", "user"),
    follows={
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    ends=("assistant",),
)


# --- escapes --------------------------------------------------------------------------------------


def escaped(text: Column, template: Template) -> Column:
    """``text`` with every escape character doubled and one put behind the head of control strings."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    heads = {c[0] for c in template.controls}
    tails = {h: "|".join(re.escape(c[1:]) for c in template.controls if c[0] == h) for h in heads}
    pattern = "|".join(f"{re.escape(h)}(?={t})" for h, t in sorted(tails.items()))
    return F.regexp_replace(doubled, pattern, "$0" + ESCAPE * 2)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


# --- formatting -----------------------------------------------------------------------------------


def segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, number, seq, text, loss and problem: the formatted text, in order, piece by piece.

    ``number`` counts a conversation's turns from zero, by ``turn``, then role and text. ``problem``
    says, on a turn's first segment, what is wrong with the turn order: a role that may not come
    first, or not after the last one, or not last; else null. Defined results: every turn is written, also where
    the order is wrong; a null text or role is empty; a null conv_id is a conversation of its own;
    repeated rows are turns each; an empty table gives no segments; other columns are left out.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns(
        {
            "number": F.row_number().over(order) - 1,
            "state": F.lag("role").over(order),
            "last": F.lead("role").over(order).isNull(),
        }
    )

    def known(pairs: Mapping[str, object], of: Column, default: Column) -> Column:
        out = default
        for role, value in pairs.items():
            out = F.when(of == role, F.lit(list(value) if isinstance(value, tuple) else value)).otherwise(out)
        return out

    role, none = F.col("role"), F.lit(None).cast("string")
    next_ones = known(template.follows, F.col("state"), F.array().cast("array<string>"))
    problem = (
        F.when(F.col("state").isNull() & ~role.isin(*template.first), F.concat(F.lit("begins with "), role))
        .when(F.col("state").isNotNull() & ~F.array_contains(next_ones, role), F.concat(role, F.lit(" after "), F.col("state")))
        .when(F.col("last") & ~role.isin(*template.ends), F.concat(F.lit("ends with "), role))
    )

    mark, middle, close = template.other
    unmarked = F.concat(F.lit(mark), escaped(role, template), F.lit(middle))
    opening = known({r: t.open for r, t in template.turns.items()}, role, unmarked)
    opening = F.concat(F.when(F.col("number") == 0, template.begin).otherwise(""), opening)
    closing = known({r: t.close for r, t in template.turns.items()}, role, F.lit(close))
    loss = known({r: t.loss for r, t in template.turns.items()}, role, F.lit(False))

    def piece(text: Column, loss: Column, problem: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"), problem.alias("problem"))

    no = F.lit(False)
    pieces = F.array(
        piece(opening, no, problem), piece(escaped(F.col("text"), template), loss, none), piece(closing, no, none)
    )
    out = rows.select("conv_id", "number", F.posexplode(pieces).alias("seq", "s"))
    return out.select("conv_id", "number", "seq", "s.text", "s.loss", "s.problem")


# --- reading back ---------------------------------------------------------------------------------


class _Reader:
    """Reads one conversation's segments in order and keeps no more than the turn it is in."""

    def __init__(self, template: Template):
        self.template, self.held, self.begun = template, "", False
        self.role = self.close = None
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss, self.valid = hashlib.sha256(), hashlib.sha256(), True

    def take(self, text: str, loss: bool, problem: str | None) -> None:
        self.formatted_chars += len(text)
        self.valid &= problem is None
        if loss:
            plain = unescaped(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.held += text
        while self.held and (self.close is not None or self._opened()):
            body, ended, rest = self.held.partition(self.close)
            if not ended:
                return
            self.turns.update(f"{self.role}\n{unescaped(body)}\n".encode())
            self.n_turns += 1
            self.held, self.close = rest, None

    def _opened(self) -> bool:
        """Takes the marks that open a turn off the text held; false if it ends within them."""
        t = self.template
        if not self.begun:
            if not self.held.startswith(t.begin):
                raise ValueError("a conversation does not open with its mark")
            self.held, self.begun = self.held.removeprefix(t.begin), True
        mark, middle, close = t.other
        if self.held.startswith(mark):
            named, found, rest = self.held.removeprefix(mark).partition(middle)
            if found:
                self.role, self.close, self.held = unescaped(named), close, rest
            return bool(found)
        marked = [r for r, turn in t.turns.items() if turn.open and self.held.startswith(turn.open)]
        bare = [r for r, turn in t.turns.items() if not turn.open]
        if not self.held:
            return False
        if not marked and not bare:
            raise ValueError("text outside of a turn")
        self.role = (marked or bare)[0]
        self.close, self.held = t.turns[self.role].close, self.held.removeprefix(t.turns[self.role].open)
        return True

    def row(self, conv_id) -> tuple:
        if self.held or self.close is not None or not self.begun:
            raise ValueError(f"conversation {conv_id} is cut off")
        sums = (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)
        return (conv_id, *sums, self.valid)


def read_back(found: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, what its formatted text holds: turns, roles and texts, and the text with loss.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars,
    loss_sha256 (the text under the loss mask), formatted_chars, and valid (no problem in the turn
    order). Segments pass in order through a reader that holds one turn, so a conversation of any
    length takes no more memory. Text that does not follow the template, and a gap between segments,
    are errors.
    """
    importable(found.sparkSession)
    kinds = T.StructType(
        [
            T.StructField("conv_id", found.schema["conv_id"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("valid", T.BooleanType()),
        ]
    )
    arrow = [to_arrow_type(f.dataType) for f in kinds.fields]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), arrow)]
        return pa.RecordBatch.from_arrays(columns, kinds.names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader = None, None
        for batch in batches:
            done = []
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                columns = [c.to_pylist() for c in batch.slice(start, ROWS_AT_ONCE).columns]
                for conv, place, due, text, loss, problem in zip(*columns):
                    if place == 1:
                        if reader is not None:
                            done.append(reader.row(current))
                        current, reader = conv, _Reader(template)
                    if place != due:
                        raise ValueError(f"conversation {conv} lacks segments")
                    reader.take(text, loss, problem)
            if done:
                yield batch_of(done)
        if reader is not None:
            yield batch_of([reader.row(current)])

    # The window asks for whole conversations in order, which segments() already gives.
    order = Window.partitionBy("conv_id").orderBy("number", "seq")
    due = F.col("number").cast("long") * PIECES + F.col("seq") + 1
    rows = found.select("conv_id", F.row_number().over(order).alias("place"), due.alias("due"), "text", "loss", "problem")
    return rows.mapInArrow(read, kinds)
