"""Chat formatting of typed content parts (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.llm.secrets import let

START, END = "<|im_start|>", "<|im_end|>"
BLOCK = 4096
PART = "struct<type:string,text:string,ref:string,tokens:long>"


def escape(text: Column) -> Column:
    """Backslashes double and ``<|`` becomes ``<\\|``, so no control string is
    left in a text; ``unescape`` gives the text back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which ends the role, becomes ``<\\n|``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n|"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n|"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """One text part, for tables that hold plain texts."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"),
    ).cast(PART))


def format_chat(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per ``conv_id`` from rows ``(conv_id, turn, role, parts)``.

    The visitor goes through the parts in order. A text part gives its escaped
    text; image, audio and document parts give the placeholder ``<|type|>``
    and an attachment record (turn, place, type, ref, tokens). An unknown type
    is treated as an attachment. Result: ``formatted``, ``loss_spans`` (start,
    end in code points: the body of each assistant turn), ``attachments`` and
    ``expanded_tokens`` (sum of the attachments' tokens).

    Null texts, roles and parts count as empty. Equal turn numbers are ordered
    by role and body; repeated rows stay. Other columns are ignored.
    """
    part = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    body = F.concat_ws("", F.transform(part, lambda p: F.when(
        F.coalesce(p["type"], F.lit("text")) == "text", escape(F.coalesce(p["text"], F.lit("")))
    ).otherwise(F.concat(F.lit("<|"), escape(p["type"]), F.lit("|>")))))
    seen = F.filter(
        F.transform(part, lambda p, i: F.struct(
            F.col("turn").alias("turn"), i.alias("place"), p["type"].alias("type"),
            p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens"),
        )), lambda a: F.coalesce(a["type"], F.lit("text")) != "text",
    )
    role = F.coalesce("role", F.lit(""))
    rows = turns.select(
        "conv_id", "turn", role.alias("role"), body.alias("body"), seen.alias("seen")
    ).withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    before = (
        Window.partitionBy("conv_id").orderBy("turn", "role", "body")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    begin = F.col("at") + F.length("head")
    span = F.when(F.col("role") == "assistant", F.struct(
        begin.alias("start"), (begin + F.length("body")).alias("end")
    ))
    return rows.groupBy("conv_id").agg(
        F.concat_ws("", F.transform(
            F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]
        )).alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
        F.flatten(F.transform(
            F.sort_array(F.collect_list(F.struct("at", "seen"))), lambda x: x["seen"]
        )).alias("attachments"),
        F.sum(F.aggregate("seen", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))
        .alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.regexp_extract(p, r"^<\|im_start\|>([^\n]*)\n", 1)).alias("role"),
        unescape(F.regexp_replace(p, r"^<\|im_start\|>[^\n]*\n", "")).alias("text"),
    ))


def cut(text: Column, spans: Column) -> Column:
    """The texts of ``spans``, structs (start, end) in code points. The text is
    cut into blocks once, and a span is read from its blocks only, so the work
    grows with the text and not with its square."""
    def one(blocks: Column, s: Column) -> Column:
        first = F.floor(s["start"] / BLOCK).cast("int")
        n = F.floor(s["end"] / BLOCK).cast("int") - first + 1
        return F.substring(
            F.concat_ws("", F.slice(blocks, first + 1, n)),
            (s["start"] - first * BLOCK + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

    blocks = F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % BLOCK), F.lit(0))
    return let(blocks, lambda b: F.transform(spans, lambda s: one(b, s)))


def digest(chats: DataFrame) -> DataFrame:
    """Figures read back from ``formatted`` and ``loss_spans``."""
    loss = F.concat_ws("", F.transform(cut(F.col("formatted"), F.col("loss_spans")), unescape))
    return chats.withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
