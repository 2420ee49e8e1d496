"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a template.

A turn is written as ``open + role + between + text + close``. Control strings inside a role or text are broken by a
backslash after their first character (one more if some are there already), which reading takes back. Only the text of
the template's loss roles is under the loss mask.

All of it is DataFrame expressions. A conversation is one row of the result and so is gathered in one place, as its
digest needs; conversations are independent of each other.

Defined cases: a null role or text is empty. Turns are ordered by turn number, nulls first, equal ones by role and text;
repeated rows are turns of their own. Rows with a null conv_id form one conversation with that id. An empty table
gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "<s>[INST] "
    between: str = " [/INST] "
    close: str = "</s>"
    # What must not stand in a text: a first character and the rest, as regular expressions.
    control_first: str = r"[<\[]"
    control_rest: str = r"/?s>|/?INST\]"
    loss_roles: tuple[str, ...] = ("assistant",)
    # State and role to next state; what isn't listed is invalid.
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("user", "assistant")

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self.control_first})(\\*)({self.control_rest})", r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self.control_first})\\(\\*)({self.control_rest})", r"$1$2$3")

    def end_state(self, roles: Column) -> Column:
        """Where the roles lead from the start; null if a turn isn't allowed."""
        moves = F.create_map(*(F.lit(x) for (s, r), t in self.moves.items() for x in (f"{s} {r}", t)))
        return F.aggregate(
            roles, F.lit(self.start), lambda state, role: F.try_element_at(moves, F.concat(state, F.lit(" "), role))
        )


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """(``conv_id``, ``valid``, ``segments`` of ``text`` and ``loss``, ``formatted``), one row a conversation.

    The segments joined are the formatted text.
    """
    t = template or Template()
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))

    def segments(turn: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(t.open), t.escape(turn["role"]), F.lit(t.between)), F.lit(False)),
            piece(t.escape(turn["text"]), turn["role"].isin(*t.loss_roles)),
            piece(F.lit(t.close), F.lit(False)),
        )

    made = ordered.select(
        "conv_id",
        F.coalesce(t.end_state(F.col("turns.role")).isin(*t.final), F.lit(False)).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return made.select("*", F.array_join("segments.text", "").alias("formatted"))


def parse(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """(``conv_id``, ``turns`` of ``role`` and ``text``) read back from the formatted text alone."""
    t = template or Template()
    quote = lambda s: "\\Q" + s + "\\E"
    parts = F.split("formatted", quote(t.close))
    turns = F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.split(F.substring(p, len(t.open) + 1, 2**31 - 1), quote(t.between), 2),
    )
    return formatted.select(
        "*",
        F.transform(
            turns, lambda p: F.struct(t.unescape(p[0]).alias("role"), t.unescape(p[1]).alias("text"))
        ).alias("turns"),
    )


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what is read back from the formatted text and from the loss mask."""
    t = template or Template()
    read = parse(formatted, t)
    whole = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: t.unescape(s["text"])), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
