"""Chat formatting with typed content parts, in DataFrame expressions only.

A turn's content is an array of parts ``struct<type, text, ref, tokens>``. The
visitor walks the parts in order: text parts are escaped and laid in place,
image, audio and document parts leave a placeholder, and their references and
the tokens they expand to are recorded in the same order. Parts of any other
type are kept as text, so nothing is lost.

    <|turn|>ROLE \\n CONTENT <|end|>        per turn, nothing in between

Only the template writes ``<``. In texts and roles ``~`` becomes ``~0``, ``<``
becomes ``~1`` and, in roles, a line feed becomes ``~2``; undoing these in the
reverse order gives the text back whatever control strings it holds.

Turns are in the order of turn (null first), then role, then content. A null
text, role or part list is empty; a null conversation id is a conversation of
its own; repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<type:string,text:string,ref:string,tokens:bigint>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("<")), F.lit("~0"), F.lit("~"))


def text_part(text: str | Column) -> Column:
    """A content of one text part."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens")
    ))


def _visited(part: Column) -> Column:
    kind, out = part["type"], escaped(F.coalesce(part["text"], F.lit("")))
    placeholder = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in PLACEHOLDERS.items()])
    return F.coalesce(placeholder, out)


def formatted(turns: DataFrame, content: str = "content", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans``, ``attachments``, ``expanded_tokens``, ``n_turns``.

    ``loss_spans`` are places (from 1) and lengths in ``formatted``; ``attachments`` has one entry per
    placeholder, in order, with the number of its turn.
    """
    parts = F.coalesce(F.col(content), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col("role"), F.lit(""))
    attached = F.filter(parts, lambda p: p["type"].isin(*PLACEHOLDERS))
    turn = F.struct(
        F.col("turn").alias("turn"), role.alias("role"),
        F.array_join(F.transform(parts, _visited), "").alias("body"),
        F.transform(attached, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens"))).alias("parts"),
    )
    # One row per turn is rendered before the shuffle; a conversation is one row by contract.
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("~2")), F.lit("\n"))
    rendered = grouped.withColumn("pieces", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), t["body"].alias("body"), (t["role"] == loss_role).alias("loss")
    )))
    spans = F.aggregate(
        F.col("pieces"),
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length")
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(
        t["parts"], lambda p: F.struct(i.alias("turn"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))
    )))
    return rendered.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda acc, a: acc + a["tokens"]).alias("expanded_tokens"),
        F.size("turns").cast("long").alias("n_turns"),
    )


def _plain(body: Column) -> Column:
    return unescaped(F.regexp_replace(body, "<\\|[a-z]+\\|>", ""))


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns and the text under the loss mask, from ``formatted`` and ``loss_spans`` alone."""
    segments = F.slice(F.split("formatted", "<\\|turn\\|>"), 2, 1 << 30)
    turns = F.transform(segments, lambda s: F.struct(
        unescaped(F.replace(F.substring_index(s, "\n", 1), F.lit("~2"), F.lit("\n"))).alias("role"),
        _plain(F.substr(s, F.length(F.substring_index(s, "\n", 1)) + 2, F.length(s) - F.length(F.substring_index(s, "\n", 1)) - 1 - len(END))).alias("text"),
    ))
    loss = F.array_join(F.transform(
        "loss_spans", lambda p: _plain(F.substr(F.col("formatted"), p["start"], p["length"]))
    ), "")
    return conversations.withColumns({"read_turns": turns, "loss_text": loss})


def digests(conversations: DataFrame) -> DataFrame:
    """What the formatted text holds: number and digest of turns, length and digest of the text under the loss mask."""
    read = read_back(conversations)
    spelled = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
