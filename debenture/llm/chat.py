"""Chat formatting as a grammar with a deterministic parser. DataFrame functions only.

    chat := turn* "</s>"        turn := "<|im_start|>" role "\\n" body "<|im_end|>\\n"

No control string may stand inside a role or body. Each turn is first rendered as it is and parsed; where the parser doesn't
give back the very turn, its conflicting content is escaped: a control string with k backslashes behind its first character
gets k+1, so that unescaping (one backslash less) is exact for every text, nested escapes too. The whole chat is then parsed
once more and compared to its source; `verified` says that it is identical.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, STOP = "<|im_start|>", "<|im_end|>", "</s>"
#: Control strings without their first character; the first of each is < or [.
_REST = r"(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
CONTROL = rf"[<\[]\\*{_REST}"
_STUFF = rf"([<\[])(\\*)(?={_REST})"
_UNSTUFF = rf"([<\[])\\(\\*)(?={_REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _STUFF, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNSTUFF, "$1$2")


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_out(role: Column) -> Column:
    """Reads backslash-n and double backslashes from the left."""
    return F.array_join(F.transform(F.split(role, r"\\\\", -1), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END + "\n"))


def parse(chat: Column) -> Column:
    """array<struct<role,text>> of a chat with or without its STOP; null where the grammar doesn't hold."""
    pieces = F.split(F.regexp_replace(chat, "</s>$", ""), r"<\|im_start\|>", -1)
    turns = F.filter(pieces, lambda x, i: i > 0)

    def turn(x: Column) -> Column:
        cut, close = F.instr(x, "\n"), F.length(x) - len(END + "\n")
        body = F.substring(x, cut + 1, F.greatest(close - cut, F.lit(0)))
        good = (cut > 0) & (close >= cut) & x.endswith(END + "\n") & ~F.regexp_like(body, F.lit(r"[<\[](?:" + _REST[3:]))
        return F.when(good, F.struct(_role_out(unescape(F.substring(x, F.lit(1), cut - 1))).alias("role"), unescape(body).alias("text")))

    return F.transform(turns, turn)


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, loss_spans (array of start, length in code points of
    `formatted`, bodies of loss_roles in order), verified.

    Null text or role: empty. Null conv: a conversation of its own. Turns of equal number go by role, then text; repeated
    rows are repeated turns; a null turn number comes first. An empty table gives no rows. Other columns are dropped. A
    conversation is one row of the result, so it is held by one task."""
    t = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    source = F.struct("role", "text")
    plain = render(_role_in(F.col("role")), F.col("text"))
    back = parse(plain)
    same = F.coalesce((F.size(back) == 1) & (F.get(back, F.lit(0)) == source), F.lit(False))
    t = t.withColumn("fits", same)
    head = F.when(F.col("fits"), _role_in(F.col("role"))).otherwise(escape(_role_in(F.col("role"))))
    body = F.when(F.col("fits"), F.col("text")).otherwise(escape(F.col("text")))
    t = t.withColumns({"head": head, "body": body}).withColumn("piece", render(F.col("head"), F.col("body")))
    w = Window.partitionBy("conv").orderBy("turn", "role", "text")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumns({"n": F.row_number().over(w), "upto": F.sum(F.length("piece").cast("long")).over(run)})
    start = F.col("upto") - F.length("piece") + len(START) + F.length("head") + 1
    in_loss = reduce(lambda a, b: a | b, [F.col("role") == r for r in loss_roles], F.lit(False))
    t = t.withColumn("span", F.when(in_loss, F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))))
    out = t.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("n", "piece", "span", source.alias("source")))).alias("t"))
    out = out.select(
        F.col("conv").alias(conv),
        F.size("t").cast("long").alias("n_turns"),
        F.concat(F.array_join(F.col("t.piece"), ""), F.lit(STOP)).alias("formatted"),
        F.filter(F.col("t.span"), lambda x: x.isNotNull()).alias("loss_spans"),
        F.col("t.source").alias("source"),
    )
    return out.withColumn("verified", F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))).drop("source")


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
