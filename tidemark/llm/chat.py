"""Chat formatting in budgeted windows of whole turns.

Prefix sums of turn costs over a conversation cut it into spans. A turn of more than half
the room is a span by itself; of the others, those that start in the same cell of the sums
are one, and a cell is shorter than the room by what the largest of them can stand out. A
window is the system turn, a limited history (turns that start within `history` before the
span) and the span itself. Repeated turns are masked, so over all windows every assistant
text is under the loss exactly once.

Prefix sums are taken over all rows in one order, so a conversation of any length is dealt
over many partitions; only what a reader asks of a whole conversation puts it together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import staging

START, STOP = "<|im_start|>", "<|im_end|>"
# Strings that a chat template or tokenizer may take for control; none appears in formatted texts.
CONTROLS = (START, STOP, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN_COST = 8
BUDGET = 2048
HISTORY = 512
TARGET = "assistant"
SYSTEM = "system"


def escape(text: Column) -> Column:
    """`text` without control strings: a backslash becomes \\0, and the first character of a control string \\1 or \\2."""
    out = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for mark, code in (("<", "1"), ("[", "2")):
        rest = "|".join(f"\\Q{c[1:]}\\E" for c in CONTROLS if c[0] == mark)
        out = F.regexp_replace(out, f"\\{mark}(?={rest})", f"\\\\{code}")
    return out


def unescape(text: Column) -> Column:
    """The text that escape() was given. Each backslash is followed by its code, so the order of the steps is safe."""
    out = F.replace(F.replace(text, F.lit("\\1"), F.lit("<")), F.lit("\\2"), F.lit("["))
    return F.replace(out, F.lit("\\0"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As escape(), and without line breaks, since one ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\3"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\3"), F.lit("\n")))


def cost(text: Column) -> Column:
    """Tokens of a turn, taken as a quarter of its bytes, and its markup."""
    return (F.ceil(F.octet_length(text) / 4) + TURN_COST).cast("long")


def windows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, history: int = HISTORY, limit: int | None = None) -> DataFrame:
    """(conv_id, window, formatted, repeated, loss): the windows of every conversation.

    Turns follow each other by turn (null first), then role and text; repeated rows are
    turns of their own. Null texts and roles are empty. `repeated` counts the leading turns
    that another window has as its own; `loss` holds [start, end) in characters of
    `formatted` for each assistant text that is this window's own. The first turn is
    repeated in every window when its role is system. Rows with a null conversation are one
    conversation; other columns are ignored.

    A span's own turns cost `budget` at most, a turn above it alone. The system turn and the
    history come on top, unless `limit` is given: then no window costs more than that in all,
    but for one whose only turn of its own does not fit beside the system turn, which has no
    history. With a limit, the room is what it leaves beside the system turn and the history;
    a conversation within the limit is one window, and history gives way to a large turn.
    """
    if not 0 <= history <= budget:
        raise ValueError("history must be from 0 to the budget")
    clean = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col(c) for c in ("conv", "turn", "role")] + [F.xxhash64("text")]
    rows = staging.rows_in_order(clean, order, "turns", cost=cost(F.col("text")))
    costs = rows.select("at", F.col("row.conv").alias("conv"), (F.col("row.role") == SYSTEM).alias("system"), "cost", staging.part(F.col("at")).alias("part"))
    totals = costs.groupBy("part").agg(F.sum("cost").alias("all"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    # one row for each written partition
    base = totals.select("part", F.coalesce(F.sum("all").over(earlier.orderBy("part")), F.lit(0)).alias("base"))
    running = F.coalesce(F.sum("cost").over(earlier.partitionBy("part").orderBy("at")), F.lit(0))
    sums = costs.withColumn("before", running).join(F.broadcast(base), "part").select("at", "conv", "system", "cost", (F.col("base") + F.col("before")).alias("from"))
    sums = staging.staged(sums, "prefix-sums")
    heads = sums.groupBy("conv").agg(
        F.min("from").alias("head"), F.min_by("at", "from").alias("head_at"), F.min_by("system", "from").alias("lead"), F.min_by("cost", "from").alias("first_cost"), F.sum("cost").alias("total")
    )
    if limit is None:
        # what a whole window may cost, and what its span may
        heads = heads.withColumn("space", F.lit(None).cast("long")).withColumn("room", F.lit(budget).cast("long")).withColumn("whole", F.lit(False))
    else:
        beside = F.greatest(F.lit(limit) - F.when(F.col("lead"), F.col("first_cost")).otherwise(0), F.lit(1)).cast("long")
        kept_free = F.least(F.lit(history), F.floor(beside / 2))
        room = F.least(F.lit(budget), beside - kept_free).cast("long")
        heads = heads.withColumn("space", beside).withColumn("room", room).withColumn("whole", F.col("total") <= limit)
    heads = staging.staged(heads.select("conv", "head", "head_at", "lead", "space", "room", "whole"), "heads")
    same = sums["conv"].eqNullSafe(heads["conv"])
    is_large = ~F.col("whole") & (F.col("cost") > F.col("room") / 2)
    turns = sums.join(heads, same).select("at", "head_at", "lead", "space", "room", "whole", "cost", (F.col("from") - F.col("head")).alias("from"), is_large.alias("large"))
    turns = staging.staged(turns, "turns-in-conversations")
    # large turns before a turn, in the order of all rows
    numbers = turns.select("at", "large", staging.part(F.col("at")).alias("part"))
    larges = numbers.groupBy("part").agg(F.sum(F.col("large").cast("long")).alias("all"))
    larges_base = larges.select("part", F.coalesce(F.sum("all").over(earlier.orderBy("part")), F.lit(0)).alias("base"))
    larges_before = F.coalesce(F.sum(F.col("large").cast("long")).over(earlier.partitionBy("part").orderBy("at")), F.lit(0))
    numbers = numbers.withColumn("before", larges_before).join(F.broadcast(larges_base), "part").select("at", (F.col("base") + F.col("before")).alias("larges"))
    widest = turns.groupBy("head_at").agg(F.max(F.when(~F.col("large"), F.col("cost"))).alias("widest"), F.min("at").alias("at")).join(numbers, "at").select("head_at", F.coalesce("widest", F.lit(1)).alias("widest"), F.col("larges").alias("larges_head"))
    cell = F.when(F.col("whole"), F.lit(0)).otherwise(F.floor(F.col("from") / (F.col("room") - F.col("widest") + 1)))
    # rises with the turns; a large turn has a number of its own
    number = cell + 2 * (F.col("larges") - F.col("larges_head")) + F.col("large").cast("long")
    spans = turns.join(numbers, "at").join(widest, "head_at").select("at", "head_at", "lead", "space", "cost", "from", number.cast("long").alias("span"))
    spans = staging.staged(spans, "spans")
    starts = spans.groupBy("head_at", "span").agg(F.min("from").alias("start"), F.first("lead").alias("lead"), F.first("space").alias("space"), F.sum("cost").alias("own"))
    starts = staging.staged(starts, "starts")
    # a turn is history of the spans that start at most `reach` after it does; turns and starts meet in cells of `history`
    reach = F.when(F.col("space").isNull(), F.lit(history)).otherwise(F.least(F.lit(history), F.greatest(F.col("space") - F.col("own"), F.lit(0))))
    width = max(history, 1)
    ahead = starts.where(F.col("start") > 0).select("head_at", "span", "start", "lead", reach.alias("reach"), F.explode(F.array(F.floor(F.col("start") / width), F.floor(F.col("start") / width) - 1)).alias("cell"))
    behind = spans.select("at", "head_at", "from", F.floor(F.col("from") / width).alias("cell"))
    past = ahead.join(behind, ["head_at", "cell"]).where((F.col("from") < F.col("start")) & (F.col("start") - F.col("from") <= F.col("reach")) & ~(F.col("lead") & (F.col("at") == F.col("head_at"))))
    lead = starts.where(F.col("lead") & (F.col("start") > 0))
    parts = (
        spans.select("at", "head_at", "span", F.lit(True).alias("own"))
        .unionByName(past.select("at", "head_at", "span", F.lit(False).alias("own")))
        .unionByName(lead.select(F.col("head_at").alias("at"), "head_at", "span", F.lit(False).alias("own")))
    )
    placed = parts.join(rows.select("at", "row"), "at")
    is_own = F.col("own")
    piece = F.struct(
        "at",
        is_own.alias("own"),
        F.concat(F.lit(START), escape_role(F.col("row.role")), F.lit("\n")).alias("open"),
        escape(F.col("row.text")).alias("body"),
        (is_own & (F.col("row.role") == TARGET)).alias("target"),
    )
    grouped = placed.groupBy("head_at", "span").agg(F.first("row.conv").alias("conv_id"), F.array_sort(F.collect_list(piece)).alias("turns"))
    close = f"{STOP}\n"
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["open"], t["body"], F.lit(close))), "")
    step = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(state: Column, t: Column) -> Column:
        start = state["pos"] + F.char_length(t["open"])
        end = start + F.char_length(t["body"])
        found = F.when(t["target"], F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((end + len(close)).alias("pos"), F.concat(state["spans"], found).alias("spans"))

    # the span's number orders the windows of a conversation; head_at tells conversations apart
    return grouped.select(
        "conv_id",
        F.col("head_at").alias("conv_key"),
        F.col("span").alias("window"),
        formatted.alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["own"])).alias("repeated"),
        F.aggregate("turns", step, walk, lambda s: s["spans"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>."""
    turns = F.slice(F.split(formatted, f"\\Q{START}\\E"), 2, 1 << 30)

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        rest = F.substring(t, F.char_length(role) + 2, F.char_length(t) - F.char_length(role) - 1 - len(STOP) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(rest).alias("text"))

    return F.transform(turns, turn)


def read_back(made: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from windows() alone."""
    turns = F.col("turns")
    own = F.slice(turns, F.col("repeated") + 1, F.greatest(F.size(turns) - F.col("repeated"), F.lit(0)))
    parsed = made.withColumn("turns", read_turns(F.col("formatted"))).withColumn("own", own)
    loss = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    each = parsed.select(
        "conv_key",
        "conv_id",
        "window",
        F.size("own").cast("long").alias("n"),
        F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join(loss, "").alias("learnt"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    whole = each.groupBy("conv_key").agg(
        F.first("conv_id").alias("conv_id"),
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "said", "learnt"))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    said, learnt = F.array_join("parts.said", ""), F.array_join("parts.learnt", "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
