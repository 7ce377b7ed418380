"""Chat formatting: turn-aligned windows under a token budget.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stage

#: Marks of the template: a turn is TURN role \n text END.
TURN, END = "<|turn|>", "<|end|>"
#: Strings that mean something to this or to other common templates.
CONTROLS = r"\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|/?s>|/?SYS>>"
BRACKETED = r"/?INST\]"

BUDGET = 1024  # tokens of a window
HISTORY = 128  # tokens of earlier turns repeated at most
_FRAME = 4  # tokens that the marks and the role take
_BLOCK = 1 << 10  # turn numbers summed together


def escaped(text: Column) -> Column:
    """One backslash more after the first sign of a control string; undone by ``unescaped``."""
    out = F.regexp_replace(text, rf"(<)(\\*)({CONTROLS})", r"$1\\$2$3")
    return F.regexp_replace(out, rf"(\[)(\\*)({BRACKETED})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    out = F.regexp_replace(text, rf"(<)\\(\\*)({CONTROLS})", r"$1$2$3")
    return F.regexp_replace(out, rf"(\[)\\(\\*)({BRACKETED})", r"$1$2$3")


def escaped_role(role: Column) -> Column:
    """A role on one line, with its control strings escaped."""
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.replace(one_line, F.lit("<"), F.lit("\\l"))


def unescaped_role(role: Column) -> Column:
    hold = F.replace(role, F.lit("\\\\"), F.lit("\\b"))
    out = F.replace(F.replace(hold, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """An upper estimate of a turn's tokens: runs of letters and digits by fours, other signs."""
    runs = F.regexp_count(text, F.lit("[A-Za-z0-9]{1,4}"))
    return (runs + F.regexp_count(text, F.lit("[^A-Za-z0-9 \\t\\n\\r]")) + _FRAME).cast("long")


def _placed(turns: DataFrame) -> DataFrame:
    """Each turn's position and the tokens before it in its conversation.

    A conversation is summed by blocks of turn numbers, so that one with very
    many turns does not meet in one task.
    """
    block = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / _BLOCK)
    blocks = stage(turns.withColumn("b", block), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("conv_id", "b").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.sum("large").alias("l")
    )
    shifts = sums.select(
        F.col("conv_id").alias("sc"),
        F.col("b").alias("sb"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("n", "t", "l")],
    )
    inside = Window.partitionBy("conv_id", "b").orderBy("turn", "role", "text")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = blocks.withColumns(
        {
            "n1": F.row_number().over(inside) - 1,
            "t1": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
            "l1": F.coalesce(F.sum("large").over(before), F.lit(0)),
        }
    )
    same = F.col("conv_id").eqNullSafe(F.col("sc")) & (F.col("b") == F.col("sb"))
    return summed.join(shifts, same).select(
        "conv_id", "role", "text", "tokens", "large",
        (F.col("n0") + F.col("n1")).alias("pos"),
        (F.col("t0") + F.col("t1")).alias("before"),
        (F.col("l0") + F.col("l1")).alias("large_before"),
    )


def chat_windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """Formatted windows: conv_id, window, formatted, n_tokens, n_context, loss, over_budget.

    Prefix sums of turn tokens choose the windows. What the repeated history leaves
    of the budget has three parts: one for the system turn and two for new turns.
    A turn larger than a part stands alone; the turns between such turns are cut
    wherever their prefix sum enters the next part, so small turns never take more
    than two parts. Only a large turn, or a large system turn, can make a window
    larger than ``budget``; turns stay whole and ``over_budget`` says so.

    Every window starts with the conversation's system turn, if its first turn is
    one, and with the last turns of the window before it, as many as ``history``
    tokens hold. These first ``n_context`` turns are masked where they repeat;
    ``loss`` lists (start, length) in code points of each new assistant text as it
    stands, escaped, in ``formatted``.

    * null text or role: empty. Null conv_id: one conversation. Null turn: first.
    * equal turn numbers: ordered by role, then text. Repeated rows: repeated turns.
    * empty text: a turn with an empty text. Empty table: no rows.
    * other columns are ignored, whatever their names.
    """
    room = budget - history
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    counted = turns.withColumn("tokens", turn_tokens(F.col("text")))
    part = F.lit(room // 3)
    placed = _placed(counted.withColumn("large", (F.col("tokens") > part).cast("long")))
    # runs of small turns lie between large ones; within a run the prefix sum picks the window
    span = F.when(F.col("large") == 1, F.lit(-1)).otherwise(F.floor(F.col("before") / part))
    keyed = stage(placed.withColumn("run", F.col("large_before")).withColumn("span", span), "spans")
    system = keyed.filter((F.col("pos") == 0) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("yc"), F.col("role").alias("srole"), F.col("text").alias("stext"),
        F.col("tokens").alias("stokens"), F.lit(True).alias("has_system"),
    )
    windows = keyed.groupBy("conv_id", "run", "large", "span").agg(
        F.min("pos").alias("first"), F.max(F.col("before") + F.col("tokens")).alias("till")
    )
    order = Window.partitionBy("conv_id").orderBy("first")
    numbered = windows.select(
        F.col("conv_id").alias("wc"), F.col("run").alias("wr"), F.col("large").alias("wl"),
        F.col("span").alias("ws"), "till",
        (F.row_number().over(order) - 1).alias("window"),
        F.lead("first").over(order).isNotNull().alias("more"),
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("wc")) & (F.col("run") == F.col("wr"))
        & (F.col("large") == F.col("wl")) & (F.col("span") == F.col("ws"))
    )
    own = keyed.join(numbered, same)
    repeats = (
        F.col("more")
        & (F.col("till") - F.col("before") <= history)
        & ~((F.col("pos") == 0) & (F.col("role") == "system"))
    )
    uses = F.when(
        repeats,
        F.array(
            F.struct(F.col("window").alias("w"), F.lit(1).alias("new")),
            F.struct((F.col("window") + 1).alias("w"), F.lit(0).alias("new")),
        ),
    ).otherwise(F.array(F.struct(F.col("window").alias("w"), F.lit(1).alias("new"))))
    used = own.select("conv_id", "pos", "role", "text", "tokens", F.explode(uses).alias("u"))
    piece = F.struct(
        F.col("pos"), F.col("u.new").alias("new"), F.col("role"), F.col("text"), F.col("tokens")
    )
    gathered = used.groupBy("conv_id", F.col("u.w").alias("window")).agg(
        F.sort_array(F.collect_list(piece)).alias("turns")
    )
    headed = gathered.join(system, F.col("conv_id").eqNullSafe(F.col("yc")), "left").withColumn(
        "turns",
        F.when(
            F.col("has_system") & (F.col("window") > 0),
            F.concat(
                F.array(
                    F.struct(
                        F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("new"),
                        F.col("srole").alias("role"), F.col("stext").alias("text"),
                        F.col("stokens").alias("tokens"),
                    )
                ),
                F.col("turns"),
            ),
        ).otherwise(F.col("turns")),
    )
    return _formatted(headed, budget)


def _formatted(windows: DataFrame, budget: int) -> DataFrame:
    def made(turn: Column) -> Column:
        head = F.concat(F.lit(TURN), escaped_role(turn["role"]), F.lit("\n"))
        body = escaped(turn["text"])
        return F.struct(
            F.concat(head, body, F.lit(END)).alias("full"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
            (turn["new"] == 1).alias("new"),
            ((turn["new"] == 1) & (turn["role"] == "assistant")).alias("target"),
            turn["tokens"].alias("tokens"),
        )

    parts = windows.select("conv_id", "window", F.transform("turns", made).alias("p"))
    nothing = F.struct(
        F.lit(0).alias("at"), F.lit([]).cast("array<struct<start:int,length:int>>").alias("loss")
    )

    def step(state: Column, part: Column) -> Column:
        span = F.struct((state["at"] + part["head"]).alias("start"), part["body"].alias("length"))
        return F.struct(
            (state["at"] + F.length(part["full"])).alias("at"),
            F.when(part["target"], F.concat(state["loss"], F.array(span)))
            .otherwise(state["loss"])
            .alias("loss"),
        )

    tokens = F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])
    return parts.select(
        "conv_id",
        F.col("window").cast("long").alias("window"),
        F.array_join(F.transform("p", lambda x: x["full"]), "").alias("formatted"),
        tokens.alias("n_tokens"),
        F.size(F.filter("p", lambda x: ~x["new"])).alias("n_context"),
        F.aggregate("p", nothing, step, lambda s: s["loss"]).alias("loss"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window the new turns (role, text) and the texts under the loss mask, from ``formatted``."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, 1 << 30)

    def parsed(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        start = F.length(role) + 2
        text = F.substr(piece, start, F.length(piece) - F.lit(len(END)) - start + 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    new = F.slice(pieces, F.col("n_context") + 1, 1 << 30)
    under = F.transform(
        "loss", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    return windows.select(
        "conv_id", "window", F.transform(new, parsed).alias("turns"), under.alias("targets"),
        F.length("formatted").alias("chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Digests of whole conversations, read back from their windows."""
    read = read_back(windows).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
        ).alias("said"),
        F.array_join("targets", "").alias("learnt"),
        "chars",
    )
    in_order = F.sort_array(F.collect_list(F.struct("window", "said", "learnt")))
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), in_order.alias("w"), F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
    )
    said = F.array_join(F.transform("w", lambda x: x["said"]), "")
    learnt = F.array_join(F.transform("w", lambda x: x["learnt"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(F.encode(learnt, "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
