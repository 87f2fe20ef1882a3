"""Conversations as training text: a declarative template and a state machine over roles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """A turn is ``open role gap text close``.

    Inside roles and texts the escape character and the first character of every control string
    are written as the escape character and a letter, so that no control string occurs there.
    ``follows`` is the state machine: which roles may follow a state; a state is the last role, "" the start.
    """

    open: str = "### "
    gap: str = "###\n"
    close: str = "</turn>\n"
    learn: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    ends: tuple[str, ...] = ("assistant",)

    def escapes(self) -> list[tuple[str, str]]:
        """The escape character first, then the leads of the control strings, each with its written form."""
        leads = dict.fromkeys([ESCAPE, self.open[0], self.gap[0], self.close[0]])
        return [(c, ESCAPE + "abcd"[i]) for i, c in enumerate(leads)]

    def write(self, text: Column) -> Column:
        for plain, written in self.escapes():
            text = F.replace(text, F.lit(plain), F.lit(written))
        return text

    def read(self, text: Column) -> Column:
        for plain, written in reversed(self.escapes()):
            text = F.replace(text, F.lit(written), F.lit(plain))
        return text

    def step(self, state: Column, role: Column) -> Column:
        """The next state, or null once an order is broken."""
        moves = F.create_map(*[F.lit(x) for a, bs in self.follows.items() for b in bs for x in (f"{a}>{b}", b)])
        return F.try_element_at(moves, F.concat(state, F.lit(">"), role))


DEFAULT = Template()


def format_conversations(
    turns: DataFrame, template: Template = DEFAULT, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, segments, formatted, valid, end_state.

    ``segments`` is an array of (text, loss); joined, its texts are ``formatted``. Loss is true for
    the escaped text of the roles the template learns, never for control strings. ``valid`` says
    whether the state machine accepts the order of turns; an order that it rejects is formatted all
    the same (``end_state`` is then null). Null texts and roles are empty; rows with a null
    conversation form one conversation; rows that share a turn number, repeated ones too, follow by
    role and text, a null number first. A conversation becomes one row, as its training text is one text.
    Other columns are ignored; an empty table gives no rows.
    """
    said = F.struct(
        F.col(turn_column).alias("turn"), _filled(role_column).alias("role"), _filled(text_column).alias("text"),
    )
    # the whole turn sorts stably whatever order the shuffle brings
    grouped = turns.groupBy(F.col(id_column).alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("said"))
    t = template

    def parts(turn: Column) -> Column:
        head = F.concat(F.lit(t.open), t.write(turn["role"]), F.lit(t.gap))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(t.write(turn["text"]).alias("text"), turn["role"].isin(*t.learn).alias("loss")),
            F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")),
        )

    state = F.aggregate("said", F.lit(""), lambda s, turn: t.step(s, turn["role"]))
    formatted = grouped.select("conv_id", F.flatten(F.transform("said", parts)).alias("segments"), state.alias("end_state"))
    return formatted.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.coalesce(F.col("end_state").isin(*t.ends), F.lit(False)).alias("valid"), "end_state",
    )


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """Turns (role, text) read back from formatted text."""
    t = template
    each = F.filter(F.split(formatted, _literal(t.close)), lambda x: x != "")

    def turn(piece: Column) -> Column:
        head = F.substring(piece, F.lit(len(t.open) + 1), F.length(piece))
        cut = F.split(head, _literal(t.gap), 2)
        return F.struct(t.read(cut[0]).alias("role"), t.read(cut[1]).alias("text"))

    return F.transform(each, turn)


def read_learned(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: template.read(s["text"])), "")


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
