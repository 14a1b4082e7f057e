"""Conversations as windows of formatted turns within a token budget, with a mask of what to learn.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns: turn and span are one
division apart, so no turn waits for the windows before it. Every window begins with the conversation's
system turn, repeats the few turns just before its span as history, and then has its span. Only the
assistant texts of the span itself are marked as targets, so each is learned exactly once.

Prefix sums are taken in two steps, over blocks of turn numbers and then inside each block, so a
conversation that holds a large part of all rows is spread over tasks like any other. A window's turns are
bounded by the budget, but for single longer turns, which are never cut.

Null texts and roles count as empty; turns stand in the order of ``turn`` (null first), ties by role, tokens
and text; repeated rows are turns like others; a null ``conv_id`` is a conversation. Other columns are left
out; an empty table gives no windows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written, by role; other roles are written out. A blank stands between marks and texts.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
BETWEEN = "\n"
#: The marks behind their first character; within texts, a backslash is put in after that character.
_REST = r"/?s>|/?INST\]|</?SYS>>|/?ROLE\]|/?TURN\]"
ESCAPE = (rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*)({_REST})", "$1$2$3")

#: Tokens of a window and of the history that it repeats; turn numbers of a block of prefix sums.
BUDGET, HISTORY, BLOCK = 1024, 256, 256


def escape(text: Column) -> Column:
    """No mark stands in the result, and ``unescape`` gives the text back: a mark gets one backslash inside, or one more than it has."""
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def tokens_of(text: Column) -> Column:
    """A stand-in for a tokenizer's count: four characters a token, and four tokens of marks."""
    return F.ceil(F.length(text) / 4) + 4


def render(role: Column, text: Column) -> Column:
    """A turn with its marks around the escaped text."""
    out = None
    for name, (lead, tail) in MARKS.items():
        turn = F.concat(F.lit(lead), escape(text), F.lit(tail))
        out = F.when(role == name, turn) if out is None else out.when(role == name, turn)
    return out.otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), escape(text), F.lit(OTHER[2])))


def spans(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=tokens_of) -> DataFrame:
    """Every turn with ``a`` and ``b``, its first token and its end in the conversation without the system turn, ``span``, and the conversation's ``stride``.

    A span holds the turns that begin within one stride. The stride leaves room for the longest turn,
    at least half of what system turn and history leave of the budget; so a window is over the budget
    only where a turn is longer than that half. A system turn longer than the rest of the budget has
    spans as long as itself, so that repeating it no more than doubles the text.
    """
    rows = turns.select(
        "conv_id", F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"), F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumns({"tokens": F.greatest(tokens(F.col("text")), F.lit(1)).cast("long"), "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62)))})
    blocks = rows.groupBy("conv", "block").agg(F.sum("tokens").alias("sum"), F.min(F.struct("turn", "role", "tokens")).alias("first"), F.max(F.when(F.col("role") != "system", F.col("tokens"))).alias("longest"))
    whole = Window.partitionBy("conv")
    blocks = blocks.select(
        "conv", "block", F.coalesce(F.sum("sum").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"), F.sum("sum").over(whole).alias("total"),
        F.min("first").over(whole).alias("first"), F.coalesce(F.max("longest").over(whole), F.lit(0)).alias("longest"),
    )
    system = F.when(F.col("first.role") == "system", F.col("first.tokens")).otherwise(0)
    blocks = blocks.withColumn("system", system)
    room = F.greatest(F.lit(budget - history) - F.col("system"), F.col("system"), F.lit(2 * history), F.lit(2))
    blocks = blocks.select("conv", "block", "offset", "system", (F.col("total") - F.col("system")).alias("total"), F.greatest(room - F.col("longest"), F.floor(room / 2)).cast("long").alias("stride"))
    order = Window.partitionBy("conv", "block").orderBy("turn", "role", "tokens", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(blocks, ["conv", "block"]).withColumn("at", F.col("offset") + F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    is_system = (F.col("at") == 0) & (F.col("system") > 0)
    placed = placed.withColumns({"is_system": is_system, "a": F.col("at") - F.when(is_system, 0).otherwise(F.col("system"))})
    return placed.withColumns({"b": F.col("a") + F.col("tokens"), "span": F.when(F.col("is_system"), 0).otherwise(F.floor(F.col("a") / F.col("stride")))})


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=tokens_of) -> DataFrame:
    """(conv_id, window, formatted, loss, n_repeated, n_tokens), one row a window.

    ``loss`` has the code points [start, end) of the targets in ``formatted``; the first ``n_repeated``
    turns stand in earlier windows too: the system turn and the history.
    """
    placed = spans(turns, budget, history, tokens)
    border = (F.col("span") + 1) * F.col("stride")
    entry = lambda span, repeated: F.struct(span.cast("long").alias("window"), F.lit(repeated).alias("repeated"))
    nothing = F.array().cast("array<struct<window:bigint,repeated:boolean>>")
    later = F.floor((F.col("total") - 1) / F.col("stride"))
    again = F.when(F.col("is_system"), F.when(later > 0, F.transform(F.sequence(F.lit(1), later), lambda w: entry(w, True))).otherwise(nothing))
    again = again.when((F.col("a") >= border - history) & (F.col("b") <= border + history), F.array(entry(F.col("span") + 1, True))).otherwise(nothing)
    copies = placed.withColumn("turn_text", render(F.col("role"), F.col("text"))).withColumn("copy", F.explode(F.concat(F.array(entry(F.col("span"), False)), again)))
    part = F.struct((~F.col("is_system")).alias("later"), F.col("a"), F.col("b"), F.col("copy.repeated").alias("repeated"), F.col("role"), F.col("turn_text"), F.col("tokens"))
    windows = copies.groupBy("conv", F.col("copy.window").alias("window")).agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(part)).alias("parts"))
    # A window that no turn begins in has repeats only, and history counts if it leads up to the span.
    windows = windows.where(F.exists("parts", lambda p: ~p["repeated"]))
    start = F.array_min(F.transform(F.filter("parts", lambda p: p["later"] & ~p["repeated"]), lambda p: p["a"]))
    upto = F.array_max(F.transform(F.filter("parts", lambda p: p["later"] & p["repeated"]), lambda p: p["b"]))
    windows = windows.withColumn("leads", F.coalesce(start == upto, F.lit(False)))
    windows = windows.withColumn("parts", F.filter("parts", lambda p: ~p["later"] | ~p["repeated"] | F.col("leads")))
    lead, tail = (len(mark) for mark in MARKS["assistant"])

    def mark(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p["turn_text"])
        span = F.struct((acc["at"] + lead).alias("start"), (end - tail).alias("end"))
        return F.struct((end + len(BETWEEN)).alias("at"), F.when((p["role"] == "assistant") & ~p["repeated"], F.array_append(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    return windows.select(
        "conv_id", "window", F.array_join(F.transform("parts", lambda p: p["turn_text"]), BETWEEN).alias("formatted"), F.aggregate("parts", none, mark)["loss"].alias("loss"),
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"), F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("n_tokens"),
    )


_TURN = "(?s)" + "|".join(f"{re.escape(lead)}.*?{re.escape(tail)}" for lead, tail in [*MARKS.values(), (OTHER[0], OTHER[2])])


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window, read back: an array of (role, text)."""

    def read(turn: Column) -> Column:
        inner = lambda lead, tail: unescape(F.substring(turn, F.lit(len(lead) + 1), F.length(turn) - len(lead) - len(tail)))
        middle = F.instr(turn, OTHER[1])
        role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, marks in MARKS.items():
            role, text = F.when(F.startswith(turn, F.lit(marks[0])), name).otherwise(role), F.when(F.startswith(turn, F.lit(marks[0])), inner(*marks)).otherwise(text)
        other = F.startswith(turn, F.lit(OTHER[0]))
        role = F.when(other, unescape(F.substring(turn, F.lit(len(OTHER[0]) + 1), middle - 1 - len(OTHER[0])))).otherwise(role)
        after = middle + len(OTHER[1])
        text = F.when(other, unescape(F.substring(turn, after, F.length(turn) - after + 1 - len(OTHER[2])))).otherwise(text)
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), read)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What stands in the windows of each conversation, read back: turns but for repeats, targets, characters.

    The digests are of whole conversations, so a conversation's text must meet in one row here; the windows themselves need no such row.
    """
    fresh = F.slice("turns", F.col("n_repeated") + 1, F.size("turns"))
    rows = windows.withColumn("turns", read_turns(F.col("formatted"))).withColumn("turns", fresh)
    target = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    rows = rows.select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join(target, "").alias("learned"), F.length("formatted").cast("long").alias("chars"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("window", "said", "learned"))).alias("w"))
    said, learned = (F.array_join(F.col(f"w.{c}"), "") for c in ("said", "learned"))
    return grouped.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")
