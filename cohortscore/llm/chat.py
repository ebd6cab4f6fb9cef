"""Chat formatting with typed content parts.

A message is a role and an array of parts, each text, image, audio or document.
The visitor ``part_text`` turns a part into text: texts are escaped, attachments
become a numbered placeholder of the control set. Turns are formatted row by
row; a window gives each its place in the conversation and an aggregate joins
the pieces.

The template is, for each turn,

    <|im_start|>ROLE<|im_sep|>CONTENT<|im_end|>

Control strings all begin with ``<|``. In roles and texts a backslash becomes
two and ``<|`` becomes ``<\\|``, so no control string can come from a text, and
one rule, "a backslash stands before the character meant", reads both back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Attachments by kind: the control string and the tokens that a model expands it to.
ATTACHMENTS = {"image": 576, "audio": 750, "document": 1024}
PART = "struct<type:string,text:string,ref:string>"


def escape(text: Column) -> Column:
    clean = F.coalesce(text, F.lit(""))
    return F.replace(F.replace(clean, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as an array of one part."""
    return F.array(
        F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"))
    )


def part_text(part: Column, attachments: dict[str, int] = ATTACHMENTS) -> Column:
    """The text that stands for a part; kinds that are not known count as text."""
    out = escape(part["text"])
    for kind in attachments:
        out = F.when(part["type"] == kind, F.lit(f"<|{kind}|>")).otherwise(out)
    return out


def part_tokens(part: Column, attachments: dict[str, int] = ATTACHMENTS) -> Column:
    out = F.lit(0)
    for kind, tokens in attachments.items():
        out = F.when(part["type"] == kind, F.lit(tokens)).otherwise(out)
    return out


def format_turns(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    trained: tuple[str, ...] = ("assistant",),
    attachments: dict[str, int] = ATTACHMENTS,
) -> DataFrame:
    """One row per message: conv_id, place, start, piece, loss_start, loss_length, attached, expanded_tokens.

    ``piece`` is the message in the template and ``start`` the code points of
    the conversation before it. The loss mask covers ``loss_length`` code
    points of the piece from ``loss_start``: the content of trained roles, and
    nothing for others. ``attached`` has (kind, ref, offset in the piece) of
    each attachment in order; ``expanded_tokens`` sums what they expand to.

    Messages go by turn, null first, then role and content, so ties and
    repeated rows have a fixed order. A null role or text counts as empty,
    null parts as none. A null conversation is one of its own.
    """
    none = F.array().cast(f"array<{PART}>")
    rows = messages.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{parts}`").cast(f"array<{PART}>"), none).alias("parts"),
    )
    texts = F.transform("parts", lambda p: F.coalesce(part_text(p, attachments), F.lit("")))
    kinds = F.array(*[F.lit(k) for k in attachments])
    pieces = rows.select("*", texts.alias("texts"), F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR)).alias("head"))
    pieces = pieces.select("*", F.array_join("texts", "").alias("content"))
    # Attachments with the code points that stand before them in the piece.
    listed = F.transform("parts", lambda p, i: F.struct(i.alias("at"), p["type"].alias("kind"), p["ref"].alias("ref")))
    attached = F.filter(listed, lambda x: F.array_contains(kinds, F.coalesce(x["kind"], F.lit(""))))
    attached = F.transform(
        attached,
        lambda x: F.struct(
            x["kind"].alias("kind"),
            x["ref"].alias("ref"),
            (F.length("head") + F.length(F.array_join(F.slice("texts", F.lit(1), x["at"]), ""))).cast("long").alias("offset"),
        ),
    )
    learns = F.col("role").isin(*trained)
    done = pieces.select(
        "conv_id",
        "turn",
        "role",
        F.concat("head", "content", F.lit(END)).alias("piece"),
        F.length("head").cast("long").alias("loss_start"),
        F.when(learns, F.length("content")).otherwise(0).cast("long").alias("loss_length"),
        attached.alias("attached"),
        F.aggregate("parts", F.lit(0), lambda n, p: n + part_tokens(p, attachments)).cast("long").alias("expanded_tokens"),
    )
    order = W.partitionBy("conv_id").orderBy("turn", "role", "piece")
    before = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(W.unboundedPreceding, -1))
    return done.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        F.coalesce(before, F.lit(0)).alias("start"),
        "piece",
        "loss_start",
        "loss_length",
        "attached",
        "expanded_tokens",
    )


def format_conversations(messages: DataFrame, **options) -> DataFrame:
    """One row per conversation: conv_id, formatted, pieces, loss_spans, attachments, expanded_tokens.

    Options and cases as in ``format_turns``. ``loss_spans`` are (start,
    length) in code points of ``formatted``; ``attachments`` (kind, ref,
    start). A conversation is one string in one row by its nature; everything
    up to here is done per message.
    """
    turns = format_turns(messages, **options)
    piece = F.struct("place", "start", "piece", "loss_start", "loss_length", "attached")
    joined = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("expanded_tokens").alias("expanded_tokens")
    )
    spans = F.transform(
        F.filter("pieces", lambda p: p["loss_length"] > 0),
        lambda p: F.struct((p["start"] + p["loss_start"]).alias("start"), p["loss_length"].alias("length")),
    )
    attachments = F.flatten(
        F.transform(
            "pieces",
            lambda p: F.transform(
                p["attached"],
                lambda a: F.struct(a["kind"].alias("kind"), a["ref"].alias("ref"), (p["start"] + a["offset"]).alias("start")),
            ),
        )
    )
    return joined.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        "pieces",
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        "expanded_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn, from the formatted string alone."""
    ended = F.split(formatted, r"<\|im_end\|>", -1)
    bodies = F.slice(ended, F.lit(1), F.size(ended) - 1)

    def turn(body: Column) -> Column:
        inner = F.substr(body, F.lit(len(START) + 1))
        return F.struct(
            unescape(F.split_part(inner, F.lit(SEPARATOR), F.lit(1))).alias("role"),
            unescape(F.split_part(inner, F.lit(SEPARATOR), F.lit(2))).alias("text"),
        )

    return F.transform(bodies, turn)


def masked_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            pieces,
            lambda p: unescape(F.substr(p["piece"], (p["loss_start"] + 1).cast("int"), p["loss_length"].cast("int"))),
        ),
        "",
    )
