"""Chat formatting into budgeted, turn-aligned training windows with loss masks.

Prefix sums of turn tokens say where a turn starts. The budget, less what the system
turn and the repeated history may take, is the stride; a turn lies in the window of the
stride that holds it, and a turn that crosses a stride's end has a window of its own.
None needs a pass over the earlier ones. Each window begins with the system turn and with
the last turns that fit what the window's own turns leave of the budget, the history budget
at most, both without loss; every assistant turn is a target once. So no window exceeds the
budget, unless a single turn with the system turn does.

Prefix sums are taken within blocks of turns and completed by the sums of earlier
blocks, and history is found by an equi-join on position, so a conversation that holds
a third of all rows is spread over many tasks.

Texts and roles are escaped so that no template of the ``<...>`` or ``[...]`` kind can
occur in them; ``unescape`` restores them exactly.

Defined results: rows are ordered by turn (null last), role, text; null role and text
are empty; a null ``conv_id`` is a conversation; repeated rows are turns; an empty table
gives no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|turn|>", "<|end|>"
#: Escapes, in the order of writing; each is a backslash and a letter of its own.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\s"))
#: In roles a line break is escaped too: the first one ends the role.
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
#: Tokens of the two markers and the role.
MARKUP_TOKENS = 4
#: Turns of a block, by turn number.
BLOCK = 64
LAST = 2**63 - 1


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):  # the backslash last: what it yields is never read again
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def estimated_tokens(text: Column) -> Column:
    """Four characters a token, and the markup of a turn."""
    return (F.floor((F.char_length(text) + 3) / 4) + MARKUP_TOKENS).cast("long")


def positions(turns: DataFrame, budget: int, history: int, tokens=estimated_tokens) -> DataFrame:
    """Turns with their number ``idx``, first token ``start``, and the conversation's ``stride``."""
    rows = turns.select(
        F.struct("conv_id").alias("conv"),  # structs compare null-safely in joins
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text"))).withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, 0)
    blocks = rows.groupBy("conv", "block").agg(
        F.sum("tokens").alias("block_tokens"), F.count("*").alias("block_rows"),
        F.min(F.when(F.col("role") == "system", F.struct("turn", "role", "text", "tokens"))).alias("system"),
    )
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select(
        "conv", "block",
        (F.sum("block_tokens").over(upto) - F.col("block_tokens")).alias("before_tokens"),
        (F.sum("block_rows").over(upto) - F.col("block_rows")).alias("before_rows"),
        F.min("system").over(Window.partitionBy("conv")).alias("system"),
    ).withColumn(
        "stride", F.greatest(F.lit(1), budget - history - F.coalesce("system.tokens", F.lit(0))),
    ).select("conv", "block", "before_tokens", "before_rows", "stride")
    return rows.select(
        "*", F.sum("tokens").over(inside).alias("upto"), F.row_number().over(
            Window.partitionBy("conv", "block").orderBy("turn", "role", "text")).alias("nth"),
    ).join(blocks, ["conv", "block"]).select(
        "conv", "role", "text", "tokens", "stride",
        (F.col("before_rows") + F.col("nth") - 1).alias("idx"),
        (F.col("before_tokens") + F.col("upto") - F.col("tokens")).alias("start"),
    )


def windows(turns: DataFrame, budget: int = 1024, history: int = 256, tokens=estimated_tokens) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as one row per training window.

    Columns: conv_id, window (ascending), n_context (leading turns that repeat earlier
    ones), n_turns, formatted, and loss_spans, code points of ``formatted`` under the
    loss, end exclusive.
    """
    if history < 1 or budget <= history:
        raise ValueError("the budget must exceed the history, which must be positive")
    placed = positions(turns, budget, history, tokens)
    slot = "start div stride"
    placed = placed.withColumn(
        "window", F.expr(f"2 * ({slot}) + if({slot} = (start + tokens - 1) div stride, 0, 1)"))
    entry = [F.col("idx"), F.col("role"), F.col("text")]
    own = placed.select("conv", "window", F.struct(F.col("idx"), F.lit(False).alias("repeated"), *entry[1:]).alias("t"))
    system = placed.filter(F.col("role") == "system").groupBy("conv").agg(
        F.min(F.struct("idx", "role", "text", "tokens")).alias("s")).select("conv", "s.*")
    begins = placed.groupBy("conv", "window").agg(
        F.min("start").alias("begin"), F.min("idx").alias("first"), F.sum("tokens").alias("own")).join(
        system.select("conv", F.col("idx").alias("system"), F.col("tokens").alias("system_tokens")), "conv", "left")
    again = F.when(F.col("system") < F.col("first"), F.col("system_tokens")).otherwise(0)
    begins = begins.withColumn("room", F.least(F.lit(history), budget - F.col("own") - again))

    # History: turns that end at or before a window and start no more than `history` ahead of it.
    reach = placed.filter(F.col("tokens") <= history).withColumn("zone", F.explode(F.expr(
        f"sequence((start + tokens) div {history}, (start + {history}) div {history})")))
    earlier = begins.withColumn("zone", F.expr(f"begin div {history}")).join(reach.select(
        "conv", "zone", "start", "tokens", *entry), ["conv", "zone"]).filter(
        F.col("begin").between(F.col("start") + F.col("tokens"), F.col("start") + F.col("room")))
    repeated = F.struct(F.col("idx"), F.lit(True).alias("repeated"), *entry[1:]).alias("t")
    kept = begins.select("conv", "window", "first").join(system, "conv").filter(F.col("idx") < F.col("first"))

    turn = lambda t: F.concat(
        F.lit(BEGIN), escape(t["role"], ROLE_ESCAPES), F.lit("\n"), escape(t["text"]), F.lit(END))
    grouped = own.union(earlier.select("conv", "window", repeated)).union(
        kept.select("conv", "window", repeated),
    ).groupBy("conv", "window").agg(F.array_sort(F.collect_set("t")).alias("turns"))

    def step(acc, t):
        begin = acc["at"] + F.char_length(F.concat(F.lit(BEGIN), escape(t["role"], ROLE_ESCAPES))) + 1
        end = begin + F.char_length(escape(t["text"]))
        target = ~t["repeated"] & (t["role"] == "assistant")
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(target, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    start = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>))")
    return grouped.select(
        F.col("conv.conv_id").alias("conv_id"), "window",
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_context"),
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", turn), "").alias("formatted"),
        F.aggregate("turns", start, step, lambda acc: acc["spans"]).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window: its new turns (role, text) and its loss text, parsed from ``formatted``."""
    pieces = F.split("formatted", r"<\|end\|>")
    turns = F.slice(pieces, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))

    def parse(piece):
        body = F.substr(piece, F.lit(len(BEGIN) + 1))
        cut = F.instr(body, "\n")
        return F.struct(
            unescape(F.substr(body, F.lit(1), cut - 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(body, cut + 1)).alias("text"))

    loss = F.transform("loss_spans", lambda s: F.substr(
        F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    return formatted.select(
        "conv_id", "window", F.transform(turns, parse).alias("turns"),
        unescape(F.array_join(loss, "")).alias("loss"), F.char_length("formatted").alias("chars"))
