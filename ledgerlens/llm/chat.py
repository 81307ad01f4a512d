"""Chat formatting with typed content parts.

A turn is a role and an ordered list of parts (type, text, ref, units). A visitor, one branch per
type, flattens the parts in order: text is written escaped; image, audio and document parts
become placeholders ``<|image|>``.. whose references go to the attachment list, and the tokens
they expand to are counted (``EXPANSION`` per unit: image tiles, audio seconds, document pages).

Template, for each turn: ``<|turn|>role<|text|>content<|end|>``. Escaping puts a backslash before
every backslash and inside every control string (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``), so a text can't close a turn; ``unescape`` drops each such backslash again.

All of it is DataFrame expressions: a turn is formatted in its own row, then turns are put in
order per conversation (the formatted conversation is one value by its nature).

Cases: null text or role counts as empty; null parts as no parts; rows of equal turn number are
ordered by role, then content, and repeated rows stay; a null conv_id is a conversation of its
own kind; a conversation without assistant has an empty loss text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
EXPANSION = {"image": 256, "audio": 25, "document": 512}    # tokens of a tile, a second, a page
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(text, r"(<(?=\||/?s>)|\[(?=/?INST\]))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A text as a list of one typed part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units")))


def _visit(part: Column, i: Column) -> Column:
    """The visitor: what a part puts into the content. A text right after a text starts with a
    backslash, so that no control string arises where they meet."""
    text = escape(part["text"])
    meets = (F.get("parts", i - 1)["type"] == "text") & (text != "") & ~text.startswith("\\")
    out = F.when(part["type"] == "text", F.when(meets, F.concat(F.lit("\\"), text)).otherwise(text))
    for kind in EXPANSION:
        out = out.when(part["type"] == kind, F.lit(f"<|{kind}|>"))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown content part: "), F.coalesce(part["type"], F.lit("null")))))


def _tokens(part: Column) -> Column:
    out = F.lit(None).cast("bigint")
    for kind, each in EXPANSION.items():
        out = F.when(part["type"] == kind, F.lit(each) * F.coalesce(part["units"], F.lit(1))).otherwise(out)
    return out.cast("bigint")


def format_turns(turns: DataFrame, parts: Column, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """Per conversation: conv, formatted, attachments (turn, type, ref, expanded tokens, in order)
    and loss_spans (start, length of every assistant content in ``formatted``, code points)."""
    who = F.coalesce(F.col(role), F.lit(""))
    listed = F.coalesce(parts, F.lit(None).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), who.alias("role"), listed.alias("parts"))
    others = F.filter("parts", lambda p: p["type"] != "text")
    rows = rows.select("conv", F.struct(
        "turn", "role", F.array_join(F.transform("parts", _visit), "").alias("content"),
        F.transform(others, lambda p: F.struct(F.col("turn"), p["type"].alias("type"), p["ref"].alias("ref"),
                                               _tokens(p).alias("tokens"))).alias("attached")).alias("row"))
    convs = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    head = lambda r: F.concat(F.lit(TURN), escape(r["role"]), F.lit(TEXT))
    whole = lambda r: F.concat(head(r), r["content"], F.lit(END))
    # Offsets: the running length of what is written before each turn.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    mask = F.aggregate("rows", start, lambda acc, r: F.struct(
        (acc["at"] + F.length(whole(r))).alias("at"),
        F.when(r["role"] == "assistant", F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + F.length(head(r))).cast("long").alias("start"), F.length(r["content"]).cast("long").alias("length")))))
        .otherwise(acc["spans"]).alias("spans")), lambda acc: acc["spans"])
    return convs.select(F.col("conv").alias(conv), F.array_join(F.transform("rows", whole), "").alias("formatted"),
                        F.flatten(F.transform("rows", lambda r: r["attached"])).alias("attachments"), mask.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")
    return F.transform(pieces, lambda x: F.struct(
        unescape(F.split_part(F.substr(x, F.lit(len(TURN) + 1)), F.lit(TEXT), F.lit(1))).alias("role"),
        unescape(F.substr(x, F.instr(x, TEXT) + F.lit(len(TEXT)))).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the output says when it is read back."""
    out = (formatted.withColumn("__turns", read_back(F.col("formatted")))
           .withColumn("__loss", loss_text(F.col("formatted"), F.col("loss_spans"))))
    said = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        conv, F.size("__turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"), F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        F.coalesce(F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]), F.lit(0)).alias("attachment_tokens"))
