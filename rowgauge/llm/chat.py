"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor, one
expression per kind, turns each part into what the formatted string holds:
escaped text, or a placeholder for an attachment, whose reference and number of
tokens it stands for are recorded in order. All of it is built-in expressions.

A turn is ``<|turn ROLE|>``, a line break, the parts, ``<|end|>``, a line break.
In texts a backslash is doubled and ``<|`` becomes ``<\\|``, so that no text can
hold a control string, and both steps can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The type of a message's parts.
PARTS = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
ATTACHED = ("image", "audio", "document")

TURN, TURN_END, END = "<|turn ", "|>\n", "<|end|>\n"

#: Tokens that an attachment stands for once expanded.
IMAGE_PATCH = 28  # pixels on a side, a token each
AUDIO_PER_SECOND = 25
PER_PAGE = 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _role_escaped(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("|>"), F.lit("|\\>"))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("|\\>"), F.lit("|>")))


def _empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _at_least_one(number: Column) -> Column:
    return F.greatest(F.coalesce(number, F.lit(1)).cast("long"), F.lit(1).cast("long"))


def words(text: Column) -> Column:
    """A stand-in count of tokens for text: its runs of non-blanks."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")


def visit(part: Column) -> Column:
    """What a part becomes: ``body, kind, ref, tokens``. Any kind but an attachment's is read as text."""
    kind = F.lower(_empty(part["kind"]))
    patches = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    text = _empty(part["text"])
    return F.struct(
        F.when(kind.isin(*ATTACHED), F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise(escaped(text)).alias("body"),
        F.when(kind.isin(*ATTACHED), kind).otherwise("text").alias("kind"),
        F.when(kind.isin(*ATTACHED), part["ref"]).alias("ref"),
        F.when(kind == "image", _at_least_one(patches))
        .when(kind == "audio", _at_least_one(F.ceil(part["seconds"] * AUDIO_PER_SECOND)))
        .when(kind == "document", _at_least_one(part["pages"]) * PER_PAGE)
        .otherwise(words(text))
        .alias("tokens"),
    )


def text_part(text: Column) -> Column:
    """The parts of a message that is text alone."""
    return F.array(F.struct(F.lit("text").alias("kind"), _empty(text).alias("text"))).cast(
        "array<struct<kind:string,text:string>>"
    )


def widened(parts: Column, names: set[str]) -> Column:
    """Parts with every field of ``PARTS``; those that the input lacks are null."""
    fields = [f.split(":") for f in PARTS[len("array<struct<") : -2].split(",")]
    return F.transform(
        parts,
        lambda p: F.struct(
            *[(p[n].cast(t) if n in names else F.lit(None).cast(t)).alias(n) for n, t in fields]
        ),
    )


def format_chat(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    learned: str = "assistant",
) -> DataFrame:
    """A row per conversation.

    ``conv_id, formatted, n_turns, n_tokens, attachments`` (turn, place, kind, ref,
    tokens, in order) and ``loss_spans`` (start and end, in code points, of what
    the learned role says). Rows with equal turn numbers are ordered by role and
    content; a null role is the empty role, null parts are no parts; null
    conversation ids make one conversation; other columns are left behind.
    """
    names = {f.name for f in messages.schema[parts].dataType.elementType.fields}
    none = F.array().cast(PARTS)
    said = messages.select(
        messages[conv].alias("conv_id"),
        messages[turn].alias("turn"),
        _empty(messages[role]).alias("role"),
        F.transform(F.coalesce(widened(messages[parts], names), none), visit).alias("seen"),
    ).withColumn("body", F.array_join(F.col("seen.body"), ""))
    head = F.concat(F.lit(TURN), _role_escaped(F.col("role")), F.lit(TURN_END))
    whole = F.concat(head, F.col("body"), F.lit(END))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = (
        said.withColumn("whole", whole)
        .withColumn("nth", F.row_number().over(in_order))
        .withColumn("till", F.sum(F.length("whole")).over(so_far))
        .withColumn("from", F.col("till") - F.length("whole") + F.length(head))
        .select(
            "conv_id",
            F.struct(
                "nth",
                "turn",
                "whole",
                (F.col("role") == learned).alias("learned"),
                F.col("from").alias("start"),
                (F.col("from") + F.length("body")).alias("end"),
                F.col("seen"),
            ).alias("t"),
        )
    )
    turns = lined.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    placed = F.flatten(
        F.transform(
            "t",
            lambda t: F.transform(
                F.filter(t["seen"], lambda s: s["kind"] != "text"),
                lambda s: F.struct(
                    t["turn"].alias("turn"), s["kind"].alias("kind"), s["ref"].alias("ref"), s["tokens"].alias("tokens")
                ),
            ),
        )
    )
    return turns.select(
        "conv_id",
        F.array_join(F.col("t.whole"), "").alias("formatted"),
        F.size("t").cast("long").alias("n_turns"),
        F.aggregate(
            F.flatten(F.col("t.seen")), F.lit(0).cast("long"), lambda total, s: total + s["tokens"]
        ).alias("n_tokens"),
        F.transform(
            placed,
            lambda a, i: F.struct(i.alias("place"), a["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
        ).alias("attachments"),
        F.transform(
            F.filter("t", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``role`` and ``text``; placeholders stay in the text."""
    pieces = F.filter(F.split(formatted, r"<\|turn ", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TURN_END, 1)
        first = F.length(role) + len(TURN_END)
        body = F.substr(piece, first + 1, F.length(piece) - first - len(END))
        return F.struct(_role_unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def under_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))),
        "",
    )
