"""Chat formatting into budgeted, turn-aligned windows, with DataFrame functions only.

Prefix sums of turn tokens (words plus a constant per turn) choose spans: with stride s, a turn belongs to the span in which
its last token falls, so spans hold whole turns. Each span becomes a window: the conversation's system turn (its first
turn, if its role is ``system``), then the latest turns of the window before as far as they fit the history limit and the
budget, then the span. Loss covers the assistant texts of the span only; repeated turns are masked. A span stays whole
and may exceed the budget by itself: it holds its first turn and, beside it, less than half of the budget without the system turn, so
this takes a first turn of more than half of that; ``over_budget`` marks such windows. History takes 256 of 1024 tokens at most, so
windows of short turns hold up to three quarters of the budget. A system turn near the budget or above leaves room for nothing: then each
turn is a window of its own, all over budget, and each repeats the system turn.

Texts are never cut. Control strings inside texts are broken by a backslash after their first character; one more is put
where backslashes stand there already, so :func:`unescape` gives back every text.

Order: turns by number, null last, then role and text. Nulls: a null text or role is empty; rows with a null conversation
id form one conversation. Repeated rows are turns each. Prefix sums go over blocks of turns first, so a conversation's turns
needn't meet in one task, but turns with one number, or none, are one block, and :func:`read_back` joins a conversation in one row. Texts of
any length stay whole. An empty table gives an empty result. Only conv_id, turn, role, text and ``tokens_col`` are read, whatever
other columns are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: The marks of this template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: What may follow "<" or "[" in a control string of this template or of other common ones.
AFTER_FIRST = [
    "|im_start|>", "|im_end|>", "|im_sep|>", "|endoftext|>", "|startoftext|>", "|system|>", "|user|>", "|assistant|>", "s>", "/s>",
    "<SYS>>", "</SYS>>", "INST]", "/INST]", "unk>", "pad>", "bos>", "eos>", "start_of_turn>", "end_of_turn>",
]
_REST = "(" + "|".join(x.replace("|", r"\|").replace("]", r"\]") for x in AFTER_FIRST) + ")"
#: Turns per block of the prefix sums.
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(?=" + _REST + ")", r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\(?=" + _REST + ")", "$1$2")


def escape_role(role: Column) -> Column:
    """Control strings broken as in texts, and the role kept on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def turn_tokens(text: Column, per_turn: int) -> Column:
    return F.regexp_count(text, F.lit(shared.WORD)).cast("long") + per_turn


def format_windows(turns: DataFrame, budget: int = 1024, history: int = 256, per_turn: int = 4, tokens_col: str | None = None) -> DataFrame:
    """(conv_id, window, text, loss, context_turns, new_turns, tokens, over_budget), one row per window.

    A turn's tokens are its words plus ``per_turn``, or those of ``tokens_col`` (a vocabulary's counts per row, such as
    :mod:`.tokens` gives them; null: words) plus ``per_turn``. Words are fewer than a vocabulary's tokens, so a budget in words must leave room.
    ``loss`` holds (start, length) in code points of the escaped assistant texts that count; ``context_turns`` is the number
    of repeated turns at the window's start.
    """
    counted = F.col(tokens_col).cast("long") if tokens_col else F.lit(None).cast("long")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), body.alias("body"), counted.alias("counted"))
    t = t.withColumn("tokens", F.coalesce(F.col("counted") + per_turn, turn_tokens(F.col("body"), per_turn))).drop("counted").withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(2**62)))
    t = t.withColumn("key", F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "body"))

    # Per block of turns: what came before it, and the conversation's first turn.
    blocks = t.groupBy("conv_id", "block").agg(F.sum("tokens").alias("in_block"), F.min("key").alias("first"), F.min_by("tokens", "key").alias("first_tokens"))
    conv = Window.partitionBy("conv_id")
    up_to = conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = conv.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("in_block").over(up_to), F.lit(0)).alias("before"),
        F.first("first").over(every).alias("head"), F.first("first_tokens").over(every).alias("head_tokens"), F.first("block").over(every).alias("head_block"),
    )
    t = t.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    in_block = Window.partitionBy("conv_id", "block").orderBy("key")
    system = F.col("head.role") == "system"
    t = t.withColumn("nth", F.row_number().over(in_block))
    t = t.withColumn("is_head", (F.col("block") == F.col("head_block")) & (F.col("nth") == 1))
    t = t.withColumn("system_tokens", F.when(system, F.col("head_tokens")).otherwise(0))
    t = t.withColumn("end", F.col("before") + F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("system_tokens"))
    stride = F.greatest(F.lit(1), F.floor((F.lit(budget) - F.col("system_tokens")) / 2))
    t = t.withColumn("span", F.when(F.col("end") <= 0, 0).otherwise(F.floor((F.col("end") - 1) / stride)))

    # Windows, the one after each, and how much history that one has room for.
    is_system = F.col("is_head") & system
    spans = t.groupBy("conv_id", "span").agg(
        F.coalesce(F.sum(F.when(~is_system, F.col("tokens"))), F.lit(0)).alias("span_tokens"), F.max("system_tokens").alias("system_tokens"),
        F.min("end").alias("first_end"), F.min_by(F.when(is_system, 0).otherwise(F.col("tokens")), "end").alias("first_tokens"),
        F.first(F.when(system, F.col("head"))).alias("system"),
    )
    order = conv.orderBy("span")
    room = F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - F.col("system_tokens") - F.col("span_tokens")))
    spans = spans.withColumn("window", F.row_number().over(order) - 1).withColumn("room", room).withColumn("from", F.col("first_end") - F.col("first_tokens"))
    spans = spans.withColumn("next", F.lead(F.struct("span", "window", "room", "from")).over(order))
    heads = spans.select(F.col("conv_id").alias("c2"), F.col("span").alias("s2"), "window", "next")

    own = t.select("conv_id", "span", "key", "role", "body", "tokens", "end", is_system.alias("is_system"))
    own = own.join(heads, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("span") == F.col("s2")))
    reaches = F.col("next").isNotNull() & ~F.col("is_system") & (F.col("next.from") - (F.col("end") - F.col("tokens")) <= F.col("next.room"))
    here = F.struct(F.col("window").alias("w"), F.lit(True).alias("new"))
    follow = F.struct(F.col("next.window").alias("w"), F.lit(False).alias("new"))
    own = own.withColumn("place", F.explode(F.when(reaches, F.array(here, follow)).otherwise(F.array(here))))
    members = own.select(
        "conv_id", F.col("place.w").alias("window"), F.col("place.new").alias("new"), "tokens",
        F.struct(F.lit(1).alias("group"), "end", "key").alias("order"), escape_role(F.col("role")).alias("role"), escape(F.col("body")).alias("body"),
    )
    later = spans.filter((F.col("window") > 0) & F.col("system").isNotNull())
    repeated = later.select(
        "conv_id", "window", F.lit(False).alias("new"), F.col("system_tokens").alias("tokens"),
        F.struct(F.lit(0).alias("group"), F.lit(0).cast("long").alias("end"), F.col("system").alias("key")).alias("order"),
        escape_role(F.col("system.role")).alias("role"), escape(F.col("system.body")).alias("body"),
    )
    members = members.unionByName(repeated)
    members = members.withColumn("shown", F.concat(F.lit(OPEN), "role", F.lit("\n"), "body", F.lit(CLOSE)))
    lead, counts = F.length(F.lit(OPEN)) + F.length("role") + 1, F.col("new") & (F.col("role") == "assistant")
    members = members.withColumn("item", F.struct("order", "new", lead.alias("lead"), F.length("body").alias("length"), counts.alias("counts"), "shown"))
    out = members.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("item")).alias("items"), F.sum("tokens").alias("tokens"), F.sum(F.when(F.col("new"), 0).otherwise(1)).alias("context_turns"),
        F.sum(F.when(F.col("new"), 1).otherwise(0)).alias("new_turns"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))

    def step(acc, x):
        here = F.struct((acc["at"] + x["lead"]).alias("start"), x["length"].alias("length"))
        return F.struct((acc["at"] + F.length(x["shown"])).alias("at"), F.when(x["counts"], F.concat(acc["loss"], F.array(here))).otherwise(acc["loss"]).alias("loss"))

    return out.select(
        "conv_id", "window", F.array_join(F.transform("items", lambda x: x["shown"]), "").alias("text"), F.aggregate("items", start, step, lambda a: a["loss"]).alias("loss"),
        "context_turns", "new_turns", "tokens", (F.col("tokens") > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss_text, formatted_chars) from formatted windows alone.

    ``turns`` joins role, newline, text, newline of every turn, each once; ``loss_text`` is the text under the loss mask.
    """
    parts = F.filter(F.split(F.col("text"), r"<\|im_end\|>\n", -1), lambda x: x != "")
    parts = F.slice(parts, F.col("context_turns").cast("int") + 1, F.greatest(F.lit(1), F.col("new_turns").cast("int")))
    open_, nl = len(OPEN), F.lit("\n")

    def turn(p):
        at = F.instr(p, "\n")
        role = F.substring(p, F.lit(open_ + 1), at - open_ - 1)
        return F.concat(unescape_role(role), nl, unescape(F.substring(p, at + 1, F.length(p))), nl)

    loss = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    each = windows.select("conv_id", F.struct("window", F.array_join(F.transform(parts, turn), "").alias("turns"), F.array_join(loss, "").alias("loss")).alias("w"), "new_turns", F.length("text").alias("chars"))
    conv = each.groupBy("conv_id").agg(F.sum("new_turns").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").cast("long").alias("formatted_chars"))
    return conv.select(
        "conv_id", F.col("n_turns").cast("long"), F.array_join(F.transform("ws", lambda w: w["turns"]), "").alias("turns"),
        F.array_join(F.transform("ws", lambda w: w["loss"]), "").alias("loss_text"), "formatted_chars",
    )
