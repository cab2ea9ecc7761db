"""Operator 5: chat formatting from a declarative template, with loss flags per segment."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Codes that stand for the first characters of control strings; no control string has them.
_CODES = "0123456789"


@dataclass(frozen=True)
class Turn:
    """How one role is written: text before and after, and whether its text is learned."""

    prefix: str
    suffix: str
    loss: bool = False


def _default_roles() -> dict[str, Turn]:
    return {
        "system": Turn("### System: ", " </turn>\n"),
        "user": Turn("### User: ", " </turn>\n"),
        "assistant": Turn("### Assistant: ", " </turn>\n", loss=True),
    }


@dataclass(frozen=True)
class Template:
    """Roles, the machine that says which may follow which, and the strings that texts must not
    contain unescaped.

    `moves` maps a state to the roles it lets in; the state after a turn is its role, the first
    state is `start`. A conversation is valid if every move is allowed and it ends in `final`.
    `other` writes roles that the template does not know (null too): such a conversation is not
    valid, but still formatted. The role stands there in hexadecimal digits.
    """

    roles: dict[str, Turn] = field(default_factory=_default_roles)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = ("###", "</turn>")
    other: Turn = Turn("### Role ", " </turn>\n")

    def __post_init__(self):
        turns = [*self.roles.values(), self.other]
        if len(self.control) > len(_CODES):
            raise ValueError(f"at most {len(_CODES)} control strings")
        if any(len(c) < 2 or set(c) & {"\\", *_CODES} for c in self.control):
            raise ValueError("control strings have two characters or more, no digit, no backslash")
        if len({t.suffix for t in turns}) > 1 or not any(c in turns[0].suffix for c in self.control):
            raise ValueError("all turns end with one suffix that holds a control string")
        if len({t.prefix for t in turns}) < len(turns):
            raise ValueError("each role has its own prefix")

    @property
    def suffix(self) -> str:
        return self.other.suffix


DEFAULT = Template()


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Double each backslash; write the first character of each control string as \\ and a code."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for code, control in zip(_CODES, template.control, strict=False):
        pattern = f"{_quoted(control[0])}(?={_quoted(control[1:])})"
        text = F.regexp_replace(text, pattern, r"\\" + code)
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    """The text that `escape` was given."""

    def codes(piece: Column) -> Column:
        for code, control in zip(_CODES, template.control, strict=False):
            piece = F.replace(piece, F.lit("\\" + code), F.lit(control[0]))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\"), codes), "\\")


def _pick(role: Column, of: dict, otherwise) -> Column:
    chosen = otherwise
    for name, value in of.items():
        chosen = F.when(role.eqNullSafe(F.lit(name)), F.lit(value)).otherwise(chosen)
    return chosen


def _follows(template: Template) -> Column:
    allowed = [f"{a}>{b}" for a, after in template.moves.items() for b in after]
    return F.array(*[F.lit(x) for x in allowed])


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, error, segments, formatted.

    `turns` has conv_id, turn, role, text; other columns are ignored. `segments` lists
    (text, loss) in order, a turn giving three: prefix, escaped text, suffix; `formatted` joins
    them. The state machine runs over the roles: `valid` says that it accepts, `error` names the
    first turn (from 0) at which it fails, or the end.

    Defined cases: a null text is empty; a null or unknown role is written by `template.other`
    and makes the conversation invalid; turns of one number are ordered by role and text, null
    numbers come first, a repeated row is a turn of its own; a row without conv_id is a
    conversation of its own. Invalid conversations are formatted as they are: the caller
    filters by `valid`. A conversation is one output value, so one task holds it.
    """
    turns = turns.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("__alone"),
        "turn",
        F.col("role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = turns.groupBy("conv_id", "__alone").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("turn").isNotNull().alias("numbered"), "turn",
            F.coalesce("role", F.lit("")).alias("order"), "text", "role",
        ))).alias("turns")
    ).drop("__alone")
    step = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("wrong"))
    follows = _follows(template)

    def move(state: Column, turn: Column) -> Column:
        role = F.coalesce(turn["role"], F.lit(""))
        allowed = F.array_contains(follows, F.concat(state["state"], F.lit(">"), role))
        wrong = F.when((state["wrong"] < 0) & ~allowed, state["at"]).otherwise(state["wrong"])
        return F.struct(
            role.alias("state"), (state["at"] + 1).alias("at"), wrong.alias("wrong")
        )

    machine = F.aggregate("turns", step, move)

    def parts(turn: Column) -> Column:
        role = turn["role"]
        unknown = F.concat(
            F.lit(template.other.prefix),
            F.coalesce(F.hex(role), F.lit("-")),
            F.lit(": "),
        )
        prefix = _pick(role, {k: v.prefix for k, v in template.roles.items()}, unknown)
        loss = _pick(role, {k: v.loss for k, v in template.roles.items()},
                     F.lit(template.other.loss))
        return F.array(
            F.struct(prefix.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"], template).alias("text"), loss.alias("loss")),
            F.struct(F.lit(template.suffix).alias("text"), F.lit(False).alias("loss")),
        )

    ended = F.array_contains(
        F.array(*[F.lit(x) for x in template.final]), F.col("machine")["state"]
    )
    done = whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        machine.alias("machine"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    wrong = F.col("machine")["wrong"]
    return done.select(
        "conv_id",
        "n_turns",
        ((wrong < 0) & ended).alias("valid"),
        F.when(wrong >= 0, F.concat(F.lit("turn "), wrong.cast("string")))
        .when(~ended, F.lit("end"))
        .alias("error"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) that a formatted conversation says."""
    pieces = F.split(formatted, _quoted(template.suffix))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    other = f"(?s)^{_quoted(template.other.prefix)}([0-9A-F]*|-): (.*)$"

    def parsed(piece: Column) -> Column:
        code = F.regexp_extract(piece, other, 1)
        role = F.when(code != "-", F.decode(F.unhex(code), "UTF-8"))
        text = F.regexp_extract(piece, other, 2)
        for name, turn in template.roles.items():
            starts = F.startswith(piece, F.lit(turn.prefix))
            role = F.when(starts, F.lit(name)).otherwise(role)
            text = F.when(starts, F.substr(piece, F.lit(len(turn.prefix) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(pieces, parsed)


def read_loss(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss flags, unescaped, with nothing between."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")
