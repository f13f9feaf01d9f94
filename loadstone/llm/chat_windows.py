"""Chat formatting in budgeted windows, with DataFrame functions alone.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns: the
axis of tokens is divided into cells, the turns inside one cell form a window, and a
turn that crosses a border is a window of its own. Only that turn can be larger than a
cell; it stays whole. A window repeats the system turn and as many whole turns before
it as fit into the history; what is repeated is masked, so the loss covers every
assistant text once. System turn, history and cell together keep within the budget,
unless a system turn leaves less than ``least`` for the cell.

Template, per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a
control string cannot occur: ``<`` and ``|`` get one more backslash between them, which
is taken out again on reading. In roles, backslashes and newlines are written ``\\\\``
and ``\\n``.

Null text and null role: empty. Turns with equal numbers go by role, then text;
repeated rows are turns. Rows with a null conv_id form one conversation. Empty table: no
rows. All windows are bounded but for a single turn that is larger; only a digest of a
whole conversation, which is one value, needs all of it at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
TURN_TOKENS = 4  # what the template adds to a turn


def estimated_tokens(text: Column) -> Column:
    """A token for every four code points."""
    return F.ceil(F.char_length(text) / 4).cast("bigint")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(plain)


def unescaped_role(role: Column) -> Column:
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def placed_turns(turns: DataFrame, budget: int, history: int, least: int, tokens=estimated_tokens) -> DataFrame:
    """The turns with their place, prefix sum and window, and, where a window starts,
    the turns that it repeats."""
    named = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = named.withColumn("tokens", tokens(F.col("text")) + TURN_TOKENS).select(
        "conv_id", "role", "text", "tokens",
        F.row_number().over(order).alias("pos"),
        F.sum("tokens").over(upto).alias("upto"),
        F.first(F.when(F.col("role") == "system", F.struct("role", "text", "tokens"))).over(upto).alias("system"),
    )
    kept = F.coalesce("system.tokens", F.lit(0))
    step = F.greatest(F.lit(budget - history) - kept, F.lit(least))
    start = F.col("upto") - F.col("tokens")
    cells = summed.withColumns({"start": start, "step": step}).withColumn(
        "cell", F.array(F.floor((F.col("start") - kept) / F.col("step")), F.floor((F.col("upto") - kept - 1) / F.col("step")))
    )
    after_system = (F.col("pos") == 2) & F.col("system").isNotNull()
    moved = F.col("cell") != F.lag("cell").over(order_by_start())
    begins = (F.col("pos") == 1) | (moved & ~after_system)
    is_system = (F.col("pos") == 1) & F.col("system").isNotNull()
    before = order_by_start().rangeBetween(-history, -1)
    recent = F.collect_list(F.when(~is_system, F.struct("role", "text"))).over(before)
    system = F.when(F.col("system").isNotNull(), F.array(F.struct("system.role", "system.text")))
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    repeated = F.when(F.col("pos") == 1, nothing).otherwise(F.concat(F.coalesce(system, nothing), recent))
    return cells.select(
        "conv_id", "pos", "role", "text",
        F.sum(begins.cast("int")).over(order_by_start()).alias("window"),
        F.when(begins, repeated).alias("repeated"),
    )


def order_by_start():
    """By prefix sum, which grows with every turn."""
    return Window.partitionBy("conv_id").orderBy("start")


def format_windows(
    turns: DataFrame, *, budget: int = 1024, history: int = 192, least: int = 256, tokens=estimated_tokens
) -> DataFrame:
    """One row per window: conv_id, window, n_repeated (turns that come first and are
    masked), formatted, and loss_spans in code points of it, end exclusive.

    ``turns`` has conv_id, turn, role and text; the sizes are in tokens.
    """
    placed = placed_turns(turns, budget, history, least, tokens)
    grouped = placed.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("fresh"),
        F.max_by("repeated", F.when(F.col("repeated").isNotNull(), 1)).alias("repeated"),
    )
    turn = lambda t: F.struct(escaped_role(t["role"]).alias("role"), escaped(t["text"]).alias("text"))
    lines = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))
    shown = grouped.select(
        "conv_id", "window", F.size("repeated").alias("n_repeated"),
        F.transform(F.concat("repeated", F.transform("fresh", lambda t: F.struct(t["role"], t["text"]))), turn).alias("turns"),
    ).withColumn("lines", F.transform("turns", lines))
    ends = F.transform(
        F.sequence(F.lit(1), F.size("lines")),
        lambda i: F.aggregate(F.slice("lines", 1, i), F.lit(0).cast("bigint"), lambda n, x: n + F.char_length(x)),
    )
    text_end = lambda e: e["end"] - len(END) - 1
    spans = F.transform(
        F.filter(
            F.transform(
                F.arrays_zip(F.col("turns"), ends.alias("ends")),
                lambda t, i: F.struct(
                    t["turns"]["role"].alias("role"), F.char_length(t["turns"]["text"]).alias("length"),
                    t["ends"].alias("end"), i.alias("nth"),
                ),
            ),
            lambda t: (t["role"] == "assistant") & (t["nth"] >= F.col("n_repeated")),
        ),
        lambda t: F.struct((text_end(t) - t["length"]).alias("start"), text_end(t).alias("end")),
    )
    return shown.select(
        "conv_id", "window", "n_repeated", F.array_join("lines", "").alias("formatted"), spans.alias("loss_spans")
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, window, fresh, loss): the turns that are new in each window, and the
    texts under its mask, read from the formatted text alone."""
    parts = F.split("formatted", r"<\|im_start\|>", -1)
    fresh = F.slice(parts, F.col("n_repeated") + 2, F.size(parts))
    role = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substr(
        p, F.char_length(role(p)) + 2, F.char_length(p) - F.char_length(role(p)) - 1 - (len(END) + 1)
    )
    turn = lambda p: F.struct(unescaped_role(role(p)).alias("role"), unescaped(body(p)).alias("text"))
    masked = lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return windows.select(
        "conv_id", "window", F.transform(fresh, turn).alias("fresh"), F.transform("loss_spans", masked).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("chars"),
    )


def read_conversations(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows in order: n_turns, turns (role, newline, text,
    newline for each), loss (all masked texts) and formatted_chars."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = read_windows(windows).select(
        "conv_id", "window", "chars", F.size("fresh").alias("n"),
        F.array_join(F.transform("fresh", line), "").alias("turns"), F.array_join("loss", "").alias("loss"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"),
    )
    return whole.select(
        "conv_id", "n_turns", "formatted_chars",
        F.array_join("parts.turns", "").alias("turns"), F.array_join("parts.loss", "").alias("loss"),
    )
