"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions alone.

A template names the strings around a turn and the roles whose text is trained on. The machine is a table of
allowed next roles; it reports how many turns break the order, the first that does, and the state it ends in.
The output is one text a conversation, its segments with loss flags, and the machine's verdict. Control strings
inside texts and roles are escaped, so that the text parses back into the same turns.

Defined cases: a null text or role is empty; a null turn comes first; equal turns go by role, then text; rows
without an id form the conversation with the null id; an empty table gives an empty result. Conversations that
break the order are formatted all the same and marked.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What surrounds a turn. start and end must begin with the characters that `guard` escapes."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    guard: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may follow; a state is the last role, or "" before the first turn.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column, template: Template) -> Column:
    """Reversible: afterwards the text holds neither the guard nor a bare percent sign."""
    guard = template.guard
    text = F.replace(text, F.lit("%"), F.lit("%25"))
    return F.replace(text, F.lit(guard), F.lit(f"%{ord(guard[0]):02X}{guard[1:]}"))


def unescape(text: Column, template: Template) -> Column:
    text = F.replace(text, F.lit(f"%{ord(template.guard[0]):02X}"), F.lit(template.guard[0]))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def _escape_role(role: Column, template: Template) -> Column:
    return F.replace(escape(role, template), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column, template: Template) -> Column:
    return unescape(F.replace(role, F.lit("%0A"), F.lit("\n")), template)


def format_chats(
    turns: DataFrame,
    template: Template = CHATML,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row a conversation: conv, formatted, segments (length, loss), state, n_violations, first_violation, valid.

    The order of turns needs a conversation's rows in one place, and so does the one text that is asked for:
    rows meet in an aggregate by conversation, which holds one conversation at a time.
    """
    t = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = t.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    follows = F.array(*[F.lit(f"{a}\n{b}") for a, bs in template.follows.items() for b in bs])

    def step(i: Column) -> Column:
        before = F.when(i == 0, F.lit("")).otherwise(F.get("ts", i - 1)["role"])
        return ~F.array_contains(follows, F.concat(before, F.lit("\n"), F.get("ts", i)["role"]))

    loss = lambda r: r.isin(*template.loss_roles)
    head = lambda r: F.concat(F.lit(template.start), _escape_role(r, template), F.lit(template.after_role))
    segs = F.flatten(
        F.transform(
            "ts",
            lambda x: F.array(
                F.struct(head(x["role"]).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(x["text"], template).alias("text"), loss(x["role"]).alias("loss")),
                F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    bad = F.filter(F.sequence(F.lit(0), F.size("ts") - 1), step)
    state = F.element_at("ts", -1)["role"]
    return (
        grouped.select("conv", segs.alias("segs"), bad.alias("bad"), state.alias("state"))
        .select(
            F.col("conv").alias(conv),
            F.array_join(F.transform("segs", lambda s: s["text"]), "").alias("formatted"),
            F.transform(
                "segs",
                lambda s: F.struct(F.length(s["text"]).cast("long").alias("length"), s["loss"].alias("loss")),
            ).alias("segments"),
            "state",
            F.size("bad").alias("n_violations"),
            F.get("bad", F.lit(0)).alias("first_violation"),
            ((F.size("bad") == 0) & F.col("state").isin(*template.final)).alias("valid"),
        )
    )


def parse_chats(formatted: DataFrame, template: Template = CHATML, conv: str = "conv_id") -> DataFrame:
    """Reads formatted texts back by their segments: adds turns (role, text, loss), in order.

    A turn ends where the template's end stands, which no escaped text holds; within it the segments' lengths cut head,
    text and end, and the text's flag is that of its own segment. Lengths that do not fit the text are an error."""
    pieces = F.split("formatted", r"\Q" + template.end + r"\E")
    before, behind = len(template.start), len(template.after_role)

    def back(piece: Column, i: Column) -> Column:
        head, text = F.get("segments", 3 * i), F.get("segments", 3 * i + 1)
        role = F.substr(piece, F.lit(before + 1), head["length"].cast("int") - F.lit(before + behind))
        turn = F.struct(
            _unescape_role(role, template).alias("role"),
            unescape(F.substr(piece, head["length"].cast("int") + 1, text["length"].cast("int")), template).alias("text"),
            text["loss"].alias("loss"),
        )
        fits = (head["length"] + text["length"] == F.length(piece)) & (F.size("segments") == 3 * (F.size(pieces) - 1))
        return F.when(fits, turn).otherwise(F.raise_error(F.lit("the segments do not fit the formatted text")))

    ts = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), back)
    return formatted.withColumn("turns", ts)


def digest(parsed: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The contract's columns, from texts read back."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return (
        parsed.withColumns({"joined": joined, "trained": trained}).select(
            conv,
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2("joined", 256).alias("turns_sha256"),
            F.length("trained").cast("long").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            F.col("n_violations").cast("long").alias("n_violations"),
        )
    )
