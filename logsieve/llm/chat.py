"""Chat formatting: typed content parts, placeholders and loss masks, all in Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One content part. `units` is what a kind is measured in: image width and
#: height in pixels, audio seconds (`units`), document pages (`units`).
PART = "struct<kind:string,text:string,ref:string,units:double,width:int,height:int>"

OPEN, CLOSE, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are marked and what attachments cost in tokens."""

    loss_roles: tuple[str, ...] = ("assistant",)
    image_patch: int = 28
    audio_tokens_per_second: float = 25.0
    document_tokens_per_page: int = 256
    placeholders: Mapping[str, str] = field(
        default_factory=lambda: {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
    )
    unknown: str = "<|attachment|>"


def escape(text: Column) -> Column:
    """A backslash more inside every `<|`, `<\\|`, `<\\\\|` ...: no escaped text
    holds `<|`, and `unescape` gives the text back."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def text_part(text: Column) -> Column:
    """A content of one text part."""
    empty = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"), empty.cast("string").alias("ref"),
        empty.cast("double").alias("units"), empty.cast("int").alias("width"), empty.cast("int").alias("height"),
    ))


def _visit(part: Column, template: ChatTemplate) -> Column:
    """struct(kind, ref, tokens, piece) of one part, by its kind.

    Text is escaped; any other kind becomes its placeholder, with the number
    of tokens it expands to. A null kind or a null part is empty text; an
    unknown kind is an attachment of no tokens.
    """
    kind = F.coalesce(part["kind"], F.lit("text"))
    cells = lambda size: F.ceil(F.coalesce(size, F.lit(0)) / template.image_patch)
    units = F.greatest(F.coalesce(part["units"], F.lit(0.0)), F.lit(0.0))
    tokens = (
        F.when(kind == "image", cells(part["width"]) * cells(part["height"]))
        .when(kind == "audio", F.ceil(units * template.audio_tokens_per_second))
        .when(kind == "document", F.ceil(units) * template.document_tokens_per_page)
        .otherwise(F.lit(0))
    )
    piece = F.when(kind == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for name, mark in template.placeholders.items():
        piece = piece.when(kind == name, F.lit(mark))
    return F.struct(
        kind.alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"),
        piece.otherwise(F.lit(template.unknown)).alias("piece"),
    )


def format_chat(
    messages: DataFrame, template: ChatTemplate = ChatTemplate(), *,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content_col: str = "text",
) -> DataFrame:
    """One row per conversation: (conv_col, n_turns, formatted, loss_spans,
    attachments, attachment_tokens).

    Content is a string (one text part) or an array of PART. Each turn is
    written `<|im_start|>role\\ntext<|im_end|>\\n`, its parts in order.
    loss_spans are [start, length] in code points of `formatted`, one for
    every text part of a turn in `template.loss_roles`. attachments lists, in
    order, (turn place, kind, ref, start of the placeholder, tokens).

    Control strings inside texts and roles are escaped reversibly; line
    breaks in a role become `<|nl|>`. Null roles and texts are empty. Turns
    are ordered by turn (nulls first), then role, then text as given (parts by
    their fields), so repeated rows and ties keep one defined order and each
    row is a turn. Texts of any length are read whole. A row with a null
    conversation id is a conversation of its own. Extra columns are ignored;
    no rows in, no rows out.

    One shuffle, by conversation: the places of a turn's spans are running
    sums of turn lengths over the sorted partition, and the turns are put
    together from the same sort.
    """
    content = messages.schema[content_col].dataType
    parts = F.col(content_col) if isinstance(content, T.ArrayType) else text_part(F.col(content_col))
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(parts, F.array().cast(f"array<{PART}>")).alias("content"),
        F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id()).alias("alone"),
    )
    visited = F.transform("content", lambda p: _visit(p, template))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    message = lambda parts: F.concat(
        head, F.array_join(F.transform(parts, lambda p: p["piece"]), ""), F.lit(CLOSE + "\n")
    )
    # The contents themselves are shuffled and sorted by, with the turn's length; what is written comes after.
    rows = rows.withColumn("size", F.length(message(visited)).cast("long"))
    order = Window.partitionBy("conv", "alone").orderBy("turn", "role", "content")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"place": F.row_number().over(order), "at": F.coalesce(before, F.lit(0))})
    rows = rows.withColumn("parts", visited).withColumns({"head": head, "message": message(F.col("parts"))})
    # Of a turn of one part the part begins where the head ends.
    ahead = lambda i: F.aggregate(
        F.slice("parts", F.lit(1), i), F.lit(0).cast("long"), lambda n, p: n + F.length(p["piece"])
    )
    start = F.col("at") + F.length("head")
    placed = F.transform("parts", lambda p, i: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
        F.length(p["piece"]).cast("long").alias("length"), F.when(i == 0, start).otherwise(start + ahead(i)).alias("start"),
    ))
    rows = rows.select("conv", "alone", "place", "message", "role", placed.alias("parts"))
    learns = F.col("role").isin(*template.loss_roles)
    spans = F.transform(F.filter("parts", lambda p: learns & (p["kind"] == "text")),
                        lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))
    held = F.transform(F.filter("parts", lambda p: p["kind"] != "text"), lambda p: F.struct(
        F.col("place").alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"),
        p["start"].alias("start"), p["tokens"].alias("tokens"),
    ))
    turns = F.sort_array(F.collect_list(F.struct("place", "message", spans.alias("spans"), held.alias("held"))))
    out = rows.groupBy("conv", "alone").agg(turns.alias("turns"))
    out = out.select(
        F.col("conv").alias(conv_col), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["message"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda t: t["spans"])).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["held"])).alias("attachments"),
    )
    count = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return out.withColumn("attachment_tokens", count)


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation;
    placeholders stay in the text."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    messages = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    role = lambda m: unescape(F.replace(F.substring_index(m, "\n", 1), F.lit(NEWLINE), F.lit("\n")))
    body = lambda m: m.substr(F.length(F.substring_index(m, "\n", 1)) + 2, F.length(m))
    text = lambda m: unescape(F.substring_index(body(m), CLOSE, 1))
    return F.transform(messages, lambda m: F.struct(role(m).alias("role"), text(m).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    taken = F.transform(spans, lambda s: unescape(formatted.substr(s["start"].cast("int") + 1, s["length"].cast("int"))))
    return F.array_join(taken, "")
