"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names, per role, the strings before and after a turn and whether the
turn's text is trained on. ``format_conversations`` orders the turns, runs the
state machine over their roles and emits one row per conversation with its
segments (text and loss flag), the formatted string and the spans of the string
under the loss mask. ``parse_formatted`` reads the turns back from the string.

Control strings inside a text are escaped reversibly: the escape character and
the two characters every control string starts with are written as two-character
codes, so that no text can contain a control string.

Defined results: a null text is empty; a null role is written as the empty role;
turns are ordered by (turn, role, text), nulls first, so ties and repeated rows
have a fixed order; rows with a null conversation id form one conversation. An
unknown role is formatted with the generic markers and counts as an invalid turn.
Columns other than the four named are ignored. Everything is built-in functions:
the one shuffle is on the conversation id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPE = "\\"
# Fixed codes of the format: the escape character and the control characters.
CODES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_CODES = CODES + (("]", "\\c"),)      # a role written in a marker must not close it


@dataclass(frozen=True)
class Turn:
    """How a role is written. Markers start with ``<`` or ``[``."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers of the conversation and of each role, and the state machine:
    ``follows[state]`` maps a role to the next state; a conversation begins in
    ``start`` and is complete in one of ``final``. A role that has no transition
    is an invalid turn and leaves the state as it is."""

    begin: str = "<s>"
    end: str = "</s>"
    turns: dict = field(default_factory=lambda: {
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("[ANS]", "[/ANS]", loss=True),
    })
    other: tuple = ("[ROLE=", "]", "[/ROLE]")
    start: str = "start"
    follows: dict = field(default_factory=lambda: {
        "start": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    final: tuple = ("answered",)

    def __post_init__(self):
        marks = [self.begin, self.end, self.other[0], self.other[2]]
        marks += [m for t in self.turns.values() for m in (t.before, t.after)]
        if not all(m[:1] in ("<", "[") for m in marks) or any(ESCAPE in m for m in marks):
            raise ValueError("markers start with < or [ and hold no backslash")
        before = [t.before for t in self.turns.values()] + [self.other[0]]
        if any(a != b and b.startswith(a) for a in before for b in before) or len(set(before)) < len(before):
            raise ValueError("no marker may begin another one")


def escape(text: Column, codes=CODES) -> Column:
    for char, code in codes:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column, codes=CODES) -> Column:
    for char, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _by_role(role: Column, template: Template, pick, other: Column) -> Column:
    out = None
    for name, turn in template.turns.items():
        out = (F.when if out is None else out.when)(role == name, F.lit(pick(turn)))
    return out.otherwise(other)


def _next_state(state: Column, role: Column, template: Template) -> Column:
    """The state after ``role``, or null where the machine has no transition."""
    out = None
    for at, moves in template.follows.items():
        for name, to in moves.items():
            out = (F.when if out is None else out.when)((state == at) & (role == name), F.lit(to))
    return out


def _run(template: Template) -> Column:
    """State and number of invalid turns after all turns."""
    def step(acc, turn):
        to = _next_state(acc["state"], turn["role"], template)
        return F.struct(F.coalesce(to, acc["state"]).alias("state"),
                        (acc["invalid"] + F.when(to.isNull(), 1).otherwise(0)).alias("invalid"))
    return F.aggregate("turns", F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("invalid")), step)


def format_conversations(rows: DataFrame, template: Template | None = None, id_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_turns, n_invalid, complete, formatted, segments, loss_spans``.

    ``segments`` is an array of (text, loss) whose texts concatenate to
    ``formatted``; ``loss_spans`` holds (start, length) in code points, from 1.
    The texts under the loss mask are those of the trained roles, without markers.
    """
    template = template or Template()
    open_, close, done = template.other
    generic = F.concat(F.lit(open_), escape(F.col("role"), ROLE_CODES), F.lit(close))
    turns = rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    turns = turns.select(
        "*", _by_role(F.col("role"), template, lambda x: x.before, generic).alias("before"),
        _by_role(F.col("role"), template, lambda x: x.after, F.lit(done)).alias("after"),
        _by_role(F.col("role"), template, lambda x: x.loss, F.lit(False)).alias("loss"))
    # Offsets by a running sum; it shares the shuffle on conv_id with the grouping.
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("before") + F.length("text") + F.length("after")
    text_end = F.sum(length).over(so_far) - F.length("after") + len(template.begin)
    turns = turns.withColumn("start", text_end - F.length("text") + 1)
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "before", "after", "loss", "start"))).alias("turns"))

    mark = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
    segments = F.concat(
        F.array(mark(F.lit(template.begin))),
        F.flatten(F.transform("turns", lambda t: F.array(
            mark(t["before"]), F.struct(t["text"].alias("text"), t["loss"].alias("loss")), mark(t["after"])))),
        F.array(mark(F.lit(template.end))))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(
        t["start"].alias("start"), F.length(t["text"]).alias("length")))
    out = convs.select("conv_id", "turns", _run(template).alias("end"), segments.alias("segments"),
                       spans.alias("loss_spans"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.col("end.invalid").cast("long").alias("n_invalid"),
        ((F.col("end.invalid") == 0) & F.col("end.state").isin(*template.final)).alias("complete"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments", "loss_spans")


def parse_formatted(formatted: Column, template: Template | None = None) -> Column:
    """The turns of a formatted string: array of (role, text), unescaped."""
    template = template or Template()
    open_, close, _ = template.other
    body = r"[^<\[]*"
    starts = [re.escape(t.before) for t in template.turns.values()]
    starts.append(re.escape(open_) + r"[^<\[\]]*" + re.escape(close))
    pattern = f"({'|'.join(starts)})({body})"
    heads = F.regexp_extract_all(formatted, F.lit(pattern), 1)
    texts = F.regexp_extract_all(formatted, F.lit(pattern), 2)

    def role(head):
        out = None
        for name, turn in template.turns.items():
            out = (F.when if out is None else out.when)(head == turn.before, F.lit(name))
        named = F.substr(head, F.lit(len(open_) + 1), F.length(head) - len(open_) - len(close))
        return out.otherwise(unescape(named, ROLE_CODES))
    return F.zip_with(heads, texts, lambda h, t: F.struct(role(h).alias("role"), unescape(t).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text of the segments under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
