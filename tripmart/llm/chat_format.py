"""Chat formatting: a finite-state machine over roles and segments with loss flags.

A template is data: the marks around a turn, the loss flag of each role and the
machine's transitions and final states.  A conversation becomes a list of
segments (text, loss flag); joined, they are the formatted text.  Control
strings inside roles and texts are escaped with a backslash so that the
formatted text reads back to the very same turns.  DataFrame expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import let


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, loss flags and the role machine."""

    opening: str = "<turn "
    after_role: str = ">"
    closing: str = "</turn>"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    final: tuple[str, ...] = ("assistant",)
    wrong: str = "wrong"


    def __post_init__(self):
        for mark in (self.opening, self.after_role, self.closing):
            if not mark or "\\" in mark or mark[0] in mark[1:]:
                raise ValueError("a mark holds no backslash and its first character only once")

    def codes(self) -> list[tuple[str, str]]:
        """What stands for each mark inside a role or text; backslashes come first."""
        return [("\\", "\\b"), (self.opening, "\\o"), (self.closing, "\\c"), (self.after_role, "\\r")]


DEFAULT = ChatTemplate()


def escape_text(text: Column, t: ChatTemplate) -> Column:
    for plain, code in t.codes()[:3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def escape_role(role: Column, t: ChatTemplate) -> Column:
    return F.replace(escape_text(role, t), F.lit(t.after_role), F.lit("\\r"))


def unescape(text: Column, t: ChatTemplate) -> Column:
    """Every backslash of an escaped string begins a code, so codes can be put back one kind after another."""
    for plain, code in reversed(t.codes()):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def final_state(turns: Column, t: ChatTemplate) -> Column:
    """State of the role machine after the last turn; a missing transition leads to ``wrong`` for good."""
    step = F.create_map(*[F.lit(x) for (state, role), to in t.transitions.items() for x in (f"{state}\n{role}", to)])
    return F.aggregate(turns, F.lit(t.start), lambda state, turn: F.coalesce(
        step[F.concat(state, F.lit("\n"), turn["role"])], F.lit(t.wrong)))


def segments_of(turns: Column, t: ChatTemplate) -> Column:
    """Header, body and end of each turn as (text, loss); only a body can bear loss."""
    def of(turn: Column) -> Column:
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            part(F.concat(F.lit(t.opening), escape_role(turn["role"], t), F.lit(t.after_role)), F.lit(False)),
            part(escape_text(turn["text"], t), turn["role"].isin(*t.loss_roles)),
            part(F.lit(t.closing), F.lit(False)))
    return F.flatten(F.transform(turns, of))


def format_conversations(rows: DataFrame, template: ChatTemplate = DEFAULT, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, segments, formatted, valid, state), one row per conversation.

    Rows are ordered by turn (NULL first), then role and text, so ties and
    repeated rows have a defined place.  A NULL role or text is empty; the rows
    without a conversation id are one conversation; an invalid order of roles
    is formatted all the same and marked ``valid = false``; extra columns are
    not read; no rows give no conversations.
    """
    empty = F.lit("")
    turns = F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text"))))
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(turns.alias("turns"))
    made = grouped.select("conv_id", segments_of(F.col("turns"), template).alias("segments"),
                          final_state(F.col("turns"), template).alias("state"))
    return made.select("conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"),
                       F.col("state").isin(*template.final).alias("valid"), "state")


def read_turns(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """The turns (role, text) that a formatted text holds."""
    def of(part: Column) -> Column:
        body = F.substr(part, F.lit(len(template.opening) + 1))
        at = F.instr(body, template.after_role)
        return F.struct(unescape(F.substr(body, F.lit(1), at - 1), template).alias("role"),
                        unescape(F.substr(body, at + len(template.after_role)), template).alias("text"))
    closing = "\\Q" + template.closing + "\\E"
    return F.transform(F.filter(F.split(formatted, closing), lambda p: p != ""), lambda p: let(p, of))


def loss_text(segments: Column, t: ChatTemplate = DEFAULT) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t)), "")


def read_back(formatted: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """(conv_id, turns, loss_text, formatted, valid) read from formatted rows."""
    return formatted.select("conv_id", read_turns(F.col("formatted"), template).alias("turns"),
                            loss_text(F.col("segments"), template).alias("loss_text"), "formatted", "valid")
