"""Chat formatting with a grammar round trip, in built-in functions only.

    conversation := turn*
    turn         := "<s>" role flag "\\n" body "</s>"
    flag         := "" | "<e>"                       <e>: the body is escaped
    body         := "[INST] " text " [/INST]"        in turns of the user
                  | text                             in all other turns

No control string may stand in a role or text.  Every turn is first rendered as it is, parsed again and compared with
its source; a turn that does not come back is rendered again one level higher.  Level 1 writes the first character of
every control string as a reference, which no parse can take for a mark, so the levels end there.  The whole
conversation is parsed and compared once more; a difference there is an error, never a silent change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, ESCAPED = "<s>", "</s>", "<e>"
ASK, ASKED = "[INST] ", " [/INST]"
#: What may not stand in a body as it is.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LEVELS = (0, 1)


def escape(text: Column) -> Column:
    for plain, reference in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(plain), F.lit(reference))
    return text


def unescape(text: Column) -> Column:
    for plain, reference in (("<", "&lt;"), ("[", "&#91;"), ("\n", "&#10;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def head(role: Column, level: int) -> Column:
    """All of a rendered turn that stands before its text."""
    name = F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))
    asks = F.when(role == "user", F.lit(ASK)).otherwise(F.lit(""))
    return F.concat(F.lit(OPEN), name, F.lit(ESCAPED if level else ""), F.lit("\n"), asks)


def rendered(role: Column, text: Column, level: int) -> Column:
    asked = F.when(role == "user", F.lit(ASKED)).otherwise(F.lit(""))
    return F.concat(head(role, level), escape(text) if level else text, asked, F.lit(CLOSE))


def _turn(piece: Column) -> Column:
    """One turn from a piece without its close; null if the piece is not a turn."""
    line = F.substring_index(piece, "\n", 1)
    escaped = F.endswith(line, F.lit(ESCAPED))
    name = F.substring(line, F.lit(len(OPEN) + 1), F.length(line) - len(OPEN) - F.when(escaped, len(ESCAPED)).otherwise(0))
    role = unescape(name)
    inner = F.substring(piece, F.length(line) + 2, F.length(piece))
    asks = F.startswith(inner, F.lit(ASK)) & F.endswith(inner, F.lit(ASKED)) & (F.length(inner) >= len(ASK + ASKED))
    body = F.when(role == "user", F.substring(inner, F.lit(len(ASK) + 1), F.length(inner) - len(ASK + ASKED))).otherwise(inner)
    marks = F.lit(False)
    for mark in CONTROL:
        marks = marks | F.contains(body, F.lit(mark)) | F.contains(name, F.lit(mark))
    right = F.startswith(piece, F.lit(OPEN)) & F.contains(piece, F.lit("\n")) & ((role != "user") | asks) & ~marks
    text = F.when(escaped, unescape(body)).otherwise(body)
    return F.when(right, F.struct(role.alias("role"), text.alias("text"), escaped.alias("escaped")))


def parse(formatted: Column) -> Column:
    """The turns (role, text, escaped) of a formatted conversation; an element is null where the grammar is broken."""
    pieces = F.split(formatted, CLOSE)
    last = F.element_at(pieces, -1)
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _turn)
    broken = F.array(F.lit(None).cast("struct<role:string,text:string,escaped:boolean>"))
    return F.when(last == "", turns).otherwise(F.concat(turns, broken))


def format_chats(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, formatted, loss_spans) for every conversation.

    ``loss_spans`` are the spans of the assistant's texts in ``formatted``, in code points, ends exclusive: the text a
    model is trained on.  Turns stand by ``turn`` (null first), then role and text; repeated rows are repeated turns.
    Null roles and texts are empty.  Rows without a conversation id form one conversation without an id.  An empty
    table has no conversations.  A conversation is one value, so its turns meet in one row.
    """
    plain = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    level = F.lit(None).cast("int")
    for n in reversed(LEVELS):  # the lowest level that comes back as the source
        back = parse(rendered(F.col("role"), F.col("text"), n))
        same = (F.size(back) == 1) & F.coalesce((back[0]["role"] == F.col("role")) & (back[0]["text"] == F.col("text")), F.lit(False))
        level = F.when(same, F.lit(n)).otherwise(level)
    done = plain.withColumn("level", level)
    mark = F.when(F.col("level") == 0, rendered(F.col("role"), F.col("text"), 0)).otherwise(rendered(F.col("role"), F.col("text"), 1))
    lead = F.when(F.col("level") == 0, F.length(head(F.col("role"), 0))).otherwise(F.length(head(F.col("role"), 1)))
    body = F.when(F.col("level") == 0, F.length("text")).otherwise(F.length(escape(F.col("text"))))
    done = done.select("conv", "turn", "role", "text", mark.alias("mark"), lead.alias("lead"), body.alias("body"))
    in_order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = done.withColumn("no", F.row_number().over(in_order)).withColumn("till", F.sum(F.length("mark")).over(so_far))
    start = F.col("till") - F.length("mark") + F.col("lead")
    one = F.struct("no", "role", "text", "mark", start.alias("start"), (start + F.col("body")).alias("end"))
    turns = placed.groupBy("conv").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    formatted = turns.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["mark"]), ""))
    theirs = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    ours = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == "assistant"),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")),
    )
    differs = F.raise_error(F.concat(F.lit("a conversation does not read back as its source: "), F.coalesce(F.col("conv").cast("string"), F.lit("null"))))
    checked = F.when(theirs == ours, F.col("formatted")).otherwise(differs.cast("string"))
    return formatted.select(F.col("conv").alias(conv_id), checked.alias("formatted"), spans.alias("loss_spans"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, one after another."""
    answers = F.filter(parse(formatted), lambda t: t["role"] == "assistant")

    def under(span: Column, answer: Column) -> Column:
        cut = F.substring(formatted, span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int"))
        return F.when(answer["escaped"], unescape(cut)).otherwise(cut)

    return F.array_join(F.zip_with(spans, answers, under), "")
