"""Chat formatting with a grammar that is read back before a text is accepted.

    conversation = { block }
    block        = "<|im_start|>" [ "&" ] role LF text "<|im_end|>" LF

"&" before the role says that role and text of the block are escaped. Everything here is made of
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_CLOSE = r"\Q<|im_end|>\E\n"
_BLOCK = "struct<role:string,text:string>"


def _escape(value: Column, is_role: bool) -> Column:
    value = F.replace(value, F.lit("&"), F.lit("&amp;"))
    value = F.replace(value, F.lit("<|"), F.lit("&lt;|"))
    return F.replace(value, F.lit("\n"), F.lit("&#10;")) if is_role else value


def _unescape(value: Column) -> Column:
    """Undoes ``_escape``: every "&" of the original has become "&amp;", so no code of the
    original is mistaken for one of the escaping."""
    for code, plain in (("&#10;", "\n"), ("&lt;", "<"), ("&amp;", "&")):
        value = F.replace(value, F.lit(code), F.lit(plain))
    return value


def _render(role: Column, text: Column, escaped: bool) -> Column:
    head = F.lit(START + "&" if escaped else START)
    if escaped:
        role, text = _escape(role, True), _escape(text, False)
    return F.concat(head, role, F.lit("\n"), text, F.lit(END + "\n"))


def _read_block(block: Column) -> Column:
    """Role and text of a block without its closing mark; NULL where the grammar is broken."""
    body = F.substr(block, F.lit(len(START) + 1))
    line = F.instr(body, "\n")
    role, text = F.substr(body, F.lit(1), line - 1), F.substr(body, line + 1)
    escaped = F.startswith(role, F.lit("&"))
    broken = (
        ~F.startswith(block, F.lit(START))
        | (line == 0)
        | F.contains(body, F.lit(START))
        | F.contains(body, F.lit(END))
    )
    role = F.when(escaped, _unescape(F.substr(role, F.lit(2)))).otherwise(role)
    text = F.when(escaped, _unescape(text)).otherwise(text)
    return F.when(~broken, F.struct(role.alias("role"), text.alias("text")))


def _blocks(formatted: Column) -> Column:
    """The blocks of a rendered conversation without their closing marks. Where something stands
    behind the last mark an empty block, which breaks the grammar, takes its place."""
    pieces = F.split(formatted, _CLOSE, -1)
    closed = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.when(F.element_at(pieces, -1) == "", closed).otherwise(F.concat(closed, F.array(F.lit(""))))


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of (role, text); an element is NULL where
    the grammar is broken."""
    return F.transform(_blocks(formatted), _read_block)


def loss_spans(formatted: Column) -> Column:
    """Where the texts of the loss role stand in the rendered conversation: an array of
    (start, length, escaped) in code points from 0, in order."""

    def step(state: Column, block: Column) -> Column:
        head = F.instr(block, "\n")
        role = F.substr(block, F.lit(len(START) + 1), head - 1 - len(START))
        under = role.isin(LOSS_ROLE, "&" + LOSS_ROLE)
        span = F.struct(
            (state["at"] + head).cast("bigint").alias("start"),
            (F.length(block) - head).cast("bigint").alias("length"),
            F.startswith(role, F.lit("&")).alias("escaped"),
        )
        return F.struct(
            (state["at"] + F.length(block) + len(END) + 1).cast("bigint").alias("at"),
            F.when(under, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    empty = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint,escaped:boolean>>").alias("spans"),
    )
    return F.aggregate(_blocks(formatted), empty, step, lambda state: state["spans"])


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""

    def cut(span: Column) -> Column:
        text = F.substr(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
        return F.when(span["escaped"], _unescape(text)).otherwise(text)

    return F.array_join(F.transform(spans, cut), "")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (the source, in order) and loss_spans.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Each turn is rendered
    plainly and reparsed; where the turn read back differs from the source it is escaped. The
    whole conversation is then reparsed and compared, with all its turns escaped if need be, and
    the query fails if even that does not give the source back.

    A null role or text is empty, a null turn number comes first, turns of one number are ordered
    by role and text, repeated rows are kept, and rows without conv_id form one conversation. The
    output of a conversation is one string, so the turns of one conversation, and only those, meet
    in a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = _render(F.col("role"), F.col("text"), False)
    source = F.struct("role", "text")
    read = parse(plain)
    same = (F.size(read) == 1) & read[0].eqNullSafe(source)
    rows = rows.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.when(same, plain)
            .otherwise(_render(F.col("role"), F.col("text"), True))
            .alias("block"),
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    source = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    first = F.array_join(F.transform("rows", lambda r: r["block"]), "")
    again = F.array_join(
        F.transform("rows", lambda r: _render(r["role"], r["text"], True)), ""
    )
    tried = grouped.select("conv_id", source.alias("turns"), first.alias("first"), "rows")
    chosen = tried.select(
        "conv_id",
        "turns",
        F.when(parse(F.col("first")).eqNullSafe(F.col("turns")), F.col("first"))
        .otherwise(again)
        .alias("formatted"),
    )
    checked = F.when(
        parse(F.col("formatted")).eqNullSafe(F.col("turns")), F.col("formatted")
    ).otherwise(F.raise_error(F.lit("a conversation does not survive formatting")))
    return chosen.select("conv_id", "turns", checked.alias("formatted")).withColumn(
        "loss_spans", loss_spans(F.col("formatted"))
    )


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """What is read back from rendered conversations: counts, lengths and digests."""
    read = formatted.select(
        "conv_id",
        "formatted",
        parse(F.col("formatted")).alias("read"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
