"""Chat turns of typed content parts as one template string per conversation, with a loss mask.

A turn is a list of parts, and a visitor turns each into text by its type. Text stays text; an image, audio or document
part becomes a placeholder with its type and its number within the turn, and its reference and the tokens it will expand to
are recorded in order. The tokens follow from the part's size: tiles of an image, frames of an audio, pages of a document; a
count given with the part stands. The template opens a turn with ``<|role|>`` and a line
break and ends it with ``<|end|>``. Inside texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can
hold a mark of the template, and both are undone exactly. The loss mask lists start and length, in code points, of
every assistant text.

Turns are put together in blocks of ``block`` turn numbers first and then block by block, so the partial strings of a
long conversation come from many tasks.

Defined results: a NULL text is empty, a NULL role is the role ``null``, a NULL turn comes first; equal turn numbers are
ordered by role, then content; a NULL conversation id is one conversation; an unknown part type is an attachment of
that type; repeated rows are turns of their own; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,n_tokens:long,width:long,height:long,seconds:double,pages:long>"
END = "<|end|>"

# Tokens that a part expands to. Images are cut into square tiles after one overview, audio into frames a second.
TILE, TILE_TOKENS, OVERVIEW_TOKENS = 512, 170, 85
FRAMES_PER_SECOND = 25
PAGE_TOKENS = 600


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def part(kind: str, **fields: Column) -> Column:
    """A part of type ``kind`` with the fields given."""
    types = dict(f.split(":") for f in PART[len("struct<") : -1].split(","))
    return F.struct(
        *[(F.lit(kind) if name == "type" else fields.get(name, F.lit(None))).cast(t).alias(name) for name, t in types.items()]
    )


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(part("text", text=text))


def is_text(p: Column) -> Column:
    return p["type"].eqNullSafe(F.lit("text"))


def expanded_tokens(p: Column) -> Column:
    """What a part expands to: the count given with it, else by its size; NULL or negative sizes count as none."""
    size = lambda name: F.greatest(F.coalesce(p[name], F.lit(0)), F.lit(0))
    tiles = F.ceil(size("width") / TILE) * F.ceil(size("height") / TILE)
    by_size = (
        F.when(p["type"] == "image", F.when(tiles > 0, OVERVIEW_TOKENS + TILE_TOKENS * tiles).otherwise(0))
        .when(p["type"] == "audio", F.ceil(size("seconds") * FRAMES_PER_SECOND))
        .when(p["type"] == "document", size("pages") * PAGE_TOKENS)
        .otherwise(0)
    )
    return F.greatest(F.coalesce(p["n_tokens"], by_size), F.lit(0)).cast("long")


def visit(parts: Column) -> Column:
    """(content, attached) of a turn: the visitor goes through its parts in order, numbering what is no text from 1."""
    attachment = "array<struct<type:string,ref:string,n_tokens:long,ordinal:int>>"

    def step(acc: Column, p: Column) -> Column:
        number = F.size(acc["attached"]) + 1
        name = F.replace(escape(F.coalesce(p["type"], F.lit("null"))), F.lit("|>"), F.lit("|\\>"))
        mark = F.concat(F.lit("<|attach:"), name, F.lit("#"), number.cast("string"), F.lit("|>"))
        kept = F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("n_tokens"), number.alias("ordinal"))
        return F.struct(
            F.concat(acc["content"], F.array(F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark))).alias("content"),
            F.when(is_text(p), acc["attached"]).otherwise(F.concat(acc["attached"], F.array(kept))).alias("attached"),
        )

    start = F.struct(F.array().cast("array<string>").alias("content"), F.array().cast(attachment).alias("attached"))
    return F.aggregate(parts, start, step)


def format_conversations(turns: DataFrame, block: int = 64) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, attachments) from (conv_id, turn, role, parts).

    loss_spans: array of (start, length) in ``formatted``. attachments: array of (type, ref, n_tokens, ordinal) in the
    order of their placeholders, ordinal the number within the turn. ``parts`` are structs like ``PART``.
    """
    turns = turns.withColumn("seen", visit(F.coalesce("parts", F.array().cast(f"array<{PART}>"))))
    content, attached = F.array_join("seen.content", ""), F.col("seen.attached")
    role = F.coalesce("role", F.lit("null"))
    head = F.concat(F.lit("<|"), F.replace(escape(role), F.lit("|>"), F.lit("|\\>")), F.lit("|>\n"))
    one = turns.select(
        "conv_id",
        F.floor(F.coalesce("turn", F.lit(-(2**62))) / block).alias("block"),
        F.struct(
            F.coalesce("turn", F.lit(-(2**62))).alias("turn"),
            role.alias("role"),
            content.alias("content"),
            head.alias("head"),
            attached.alias("attached"),
        ).alias("t"),
    )
    add = lambda acc, t: F.struct(
        (acc["at"] + F.length(t["head"]) + F.length(t["content"]) + len(END)).cast("long").alias("at"),
        F.when(
            t["role"] == "assistant",
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(t["head"])).cast("long").alias("start"),
                        F.length(t["content"]).cast("long").alias("length"),
                    )
                ),
            ),
        )
        .otherwise(acc["spans"])
        .alias("spans"),
    )
    none = F.array().cast("array<struct<start:long,length:long>>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
    sorted_turns = F.array_sort(F.collect_list("t"))
    blocks = one.groupBy("conv_id", "block").agg(sorted_turns.alias("turns")).select(
        "conv_id",
        F.struct(
            "block",
            F.size("turns").cast("long").alias("n"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["content"], F.lit(END))), "").alias("text"),
            F.aggregate("turns", zero, add).alias("walk"),
            F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attached"),
        ).alias("b"),
    )
    join_blocks = lambda acc, b: F.struct(
        (acc["at"] + b["walk"]["at"]).alias("at"),
        F.concat(
            acc["spans"],
            F.transform(
                b["walk"]["spans"],
                lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["length"].alias("length")),
            ),
        ).alias("spans"),
    )
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("bs"))
    return whole.select(
        "conv_id",
        F.aggregate("bs", F.lit(0).cast("long"), lambda acc, b: acc + b["n"]).alias("n_turns"),
        F.array_join(F.transform("bs", lambda b: b["text"]), "").alias("formatted"),
        F.aggregate("bs", zero, join_blocks)["spans"].alias("loss_spans"),
        F.flatten(F.transform("bs", lambda b: b["attached"])).alias("attachments"),
    )


MARK = r"(?s)<\|attach:(.*?)#(\d+)\|>"


def plain(content: Column) -> Column:
    """What the text parts of a formatted content said: no text can hold a placeholder, so each one found is real."""
    return unescape(F.regexp_replace(content, MARK, ""))


def read_turns(formatted: Column) -> Column:
    """Array of (role, content, placeholders): content the text parts, unescaped, placeholders as ``type#number``."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def read(p: Column) -> Column:
        body = F.regexp_replace(p, r"(?s)^<\|.*?\|>\n", "")
        marks = F.transform(
            F.regexp_extract_all(body, F.lit(MARK), F.lit(0)),
            lambda m: F.concat(unescape(F.regexp_extract(m, MARK, 1)), F.lit("#"), F.regexp_extract(m, MARK, 2)),
        )
        return F.struct(
            unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>\n", 1)).alias("role"),
            plain(body).alias("content"),
            marks.alias("placeholders"),
        )

    return F.transform(pieces, read)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. Placeholders in an assistant's turn lie under it, but are no text."""
    return F.array_join(
        F.transform(spans, lambda s: plain(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
