"""Chat transcripts from event logs: streamed pieces and edits are folded, then rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template, and the roles whose text a model is trained on.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
#: How characters that control strings begin with are written inside texts; the backslash first.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    return _replaced(text, list(pairs))


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(pairs)])


def final_messages(
    log: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    seq_col: str | None = None,
    kind_col: str | None = None,
) -> DataFrame:
    """Fold an event log into ``conv``, ``turn``, ``nth``, ``role`` and ``text`` of final messages.

    Events of one turn are taken by ``seq_col`` (then role and text). By ``kind_col`` a ``message``
    (also null, or without such a column) opens a message, so that each row of a plain log is one;
    ``delta`` appends its text to the message open in its turn, ``edit`` replaces the text so far,
    and ``regenerate`` discards it and starts again from its own text (mostly none). Other kinds
    append nothing. An event before any message opens one. Null texts and roles are empty; null
    conversations, turns and sequence numbers are values that come first; equal rows of a plain log
    are as many messages.
    """
    kind = F.coalesce(F.col(kind_col), F.lit("message")) if kind_col else F.lit("message")
    events = log.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(seq_col or turn_col).alias("seq"),
        kind.alias("kind"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("starts", F.col("kind").isin("message", "edit", "regenerate").cast("int"))
    in_turn = Window.partitionBy("conv", "turn").orderBy("seq", "role", "text")
    so_far = in_turn.rowsBetween(Window.unboundedPreceding, 0)
    events = events.select(
        "*",
        (
            F.sum((F.col("kind") == "message").cast("int")).over(so_far)
            + (F.first("kind").over(so_far) != "message").cast("int")
        ).alias("nth"),
        F.sum("starts").over(so_far).alias("start"),
        F.row_number().over(in_turn).alias("at"),
    )
    message = Window.partitionBy("conv", "turn", "nth")
    valid = events.select(
        "*",
        F.max("start").over(message).alias("last_start"),
        F.min(F.struct("at", "role")).over(message)["role"].alias("speaker"),
    ).where("start = last_start and kind in ('message', 'delta', 'edit', 'regenerate')")
    pieces = F.sort_array(F.collect_list(F.struct("at", "text")))
    return valid.groupBy("conv", "turn", "nth").agg(
        F.max("speaker").alias("role"), F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row a conversation: ``conv``, ``formatted`` and ``loss_spans``.

    Every message is its role, a line break and its text between the template's marks. Inside roles
    and texts all characters that could begin a control string are escaped, so marks occur only
    where the template puts them. ``loss_spans`` has the code-point bounds of learned texts.
    """
    parts = messages.select(
        "conv",
        "turn",
        "nth",
        (F.col("role") == LEARNED).alias("learned"),
        F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
    ).withColumn("part", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("conv").orderBy("turn", "nth").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(
        "from", F.coalesce(F.sum(F.length("part")).over(before), F.lit(0)) + F.length("head")
    ).withColumn("until", F.col("from") + F.length("body"))
    listed = parts.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "nth", "part", "learned", "from", "until"))).alias("parts")
    )
    return listed.select(
        "conv",
        F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("formatted"),
        F.transform(
            F.filter("parts", lambda p: p["learned"]), lambda p: F.struct(p["from"].alias("from"), p["until"].alias("until"))
        ).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """``turns`` (role and text) and ``loss_text`` again from ``formatted`` and ``loss_spans``."""
    marks = F.filter(F.split("formatted", "<\\|im_start\\|>"), lambda p: p != "")

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(head) + 2, F.length(part) - F.length(head) - F.lit(1 + len(CLOSE)))
        return F.struct(unescape(head, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    learned = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["from"] + 1).cast("int"), (s["until"] - s["from"]).cast("int")))
    )
    return rendered.select("*", F.transform(marks, turn).alias("turns"), F.array_join(learned, "").alias("loss_text"))


def format_report(conversations: DataFrame) -> DataFrame:
    """Digests of all rendered conversations, read back from the rendering."""
    back = read_back(render(final_messages(conversations)))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
