"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of the turns' tokens choose windows whose spans start and end with whole turns. Each window repeats the opening
system turn and a few turns of history before its span; both are masked, so every assistant text is a target once.

A turn is written ``<turn ROLE>\\nTEXT\\n</turn>\\n``. In a text a backslash becomes two and a marker gets one before it, in a role
``% < > newline`` are written as percent codes. So no text can hold a marker, and reading back gives the very same turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
SYSTEM, TARGET = "system", "assistant"
MARKER_TOKENS = 4
OPEN, CLOSE = "<turn ", "\n</turn>\n"
_ROLE_CODES = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))


def tokens_of(text: Column) -> Column:
    """Words and single other signs of a text, plus the markers of its turn."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + MARKER_TOKENS


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for marker in (OPEN, CLOSE.strip()):
        text = F.replace(text, F.lit(marker), F.lit("\\" + marker))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\<])", "$1")


def _role_written(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_read(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _window_starts(turns: Column, budget: int, history_turns: int, history_tokens: int) -> Column:
    """First turn of every window and the first turn that it repeats before it: array of (first, history)."""
    has_system = F.get(turns, F.lit(0))["role"] == SYSTEM
    head = F.when(has_system, F.get(turns, F.lit(0))["tokens"]).otherwise(F.lit(0)).cast("long")
    opening = F.when(has_system, 1).otherwise(0)
    before = lambda i: F.get(turns, i)["upto"] - F.get(turns, i)["tokens"]

    def history(first: Column) -> Column:
        """Earliest of the last turns whose tokens fit the limit of the history and, with the next turn, the budget."""
        chosen = first
        for k in range(1, history_turns + 1):
            i = F.greatest(first - k, opening)
            held = before(first) - before(i)
            fits = (held <= history_tokens) & (head + held + F.get(turns, first)["tokens"] <= budget)
            chosen = F.when(fits, F.least(chosen, i)).otherwise(chosen)
        return chosen

    def step(state: Column, i: Column) -> Column:
        full = state["used"] + F.get(turns, i)["tokens"] > budget
        first = F.struct(i.alias("first"), history(i).alias("history"))
        opened = F.struct(
            F.concat(state["out"], F.array(first)).alias("out"),
            (head + F.get(turns, i)["upto"] - before(first["history"])).alias("used"),
        )
        same = F.struct(state["out"].alias("out"), (state["used"] + F.get(turns, i)["tokens"]).alias("used"))
        return F.when(full & (i > opening), opened).otherwise(same)

    start = F.struct(
        F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("history"))).alias("out"),
        F.get(turns, F.lit(0))["tokens"].cast("long").alias("used"),
    )
    rest = F.when(F.size(turns) > 1, F.sequence(F.lit(1), F.size(turns) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, start, step, lambda s: s["out"])


def chat_windows(
    conversations: DataFrame,
    *,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """One row per window: conv_id, window_no, n_repeated, n_tokens, formatted, loss (array of (start, end) code points).

    Input rows are turns (conv_id, turn, role, text); other columns are not read. Turns are ordered by turn, nulls first, then by role
    and text, so ties and repeated rows have a fixed order and every row is a turn. A null text or role counts
    as empty; rows with a null conv_id form one conversation. Only an opening system turn is repeated. A window holds at most
    ``budget`` tokens unless its one new turn, with the system turn, is longer: texts are never cut. The first
    ``n_repeated`` turns of a window were in an earlier one. An empty table gives no windows.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tokens", tokens_of(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("upto", F.sum("tokens").over(order)).withColumn("no", F.row_number().over(order))
    turn = F.struct("no", "role", "text", "tokens", "upto")
    talks = numbered.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    talks = talks.withColumn("starts", _window_starts(F.col("turns"), budget, history_turns, history_tokens))

    def window(w: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1)["first"], F.size("turns"))
        repeats_system = (k > 0) & (F.get(F.col("turns"), F.lit(0))["role"] == SYSTEM)
        return F.struct(
            k.alias("window_no"),
            (w["first"] - w["history"] + F.when(repeats_system, 1).otherwise(0)).alias("n_repeated"),
            F.concat(
                F.when(repeats_system, F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0)),
                F.slice("turns", w["history"] + 1, end - w["history"]),
            ).alias("held"),
        )

    cut = talks.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")
    parts = cut.withColumn(
        "parts",
        F.transform(
            "held",
            lambda t, i: F.struct(
                F.concat(F.lit(OPEN), _role_written(t["role"]), F.lit(">\n")).alias("head"),
                escaped(t["text"]).alias("body"),
                ((t["role"] == TARGET) & (i >= F.col("n_repeated"))).alias("target"),
            ),
        ),
    )

    def mask(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.when(p["target"], F.concat(state["out"], span)).otherwise(state["out"]).alias("out"),
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return parts.select(
        "conv_id",
        F.col("window_no").cast("long").alias("window_no"),
        F.col("n_repeated").cast("long").alias("n_repeated"),
        F.aggregate("held", F.lit(0), lambda a, t: a + t["tokens"]).cast("long").alias("n_tokens"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("parts", nothing, mask, lambda s: s["out"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window: array of (role, text)."""
    pieces = F.split(formatted, CLOSE, -1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            _role_read(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ">\n", 1)).alias("role"),
            unescaped(F.substr(p, F.locate(">\n", p) + 2)).alias("text"),
        ),
    )


def read_targets(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, as they were before formatting."""
    return F.transform(loss, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation what the windows hold, read back from their text: turns without repeats, texts under the mask."""
    new = F.slice(read_turns(F.col("formatted")), F.col("n_repeated").cast("int") + 1, F.size(read_turns(F.col("formatted"))))
    turns = F.array_join(F.transform(F.col("new"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = windows.withColumn("new", new).select(
        "conv_id",
        F.struct(
            "window_no",
            turns.alias("turns"),
            F.array_join(read_targets(F.col("formatted"), F.col("loss")), "").alias("loss"),
        ).alias("w"),
        F.size("new").alias("n"),
        F.length("formatted").alias("chars"),
    )
    joined = each.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows")
    )
    text = lambda field: F.array_join(F.transform("w", lambda w: w[field]), "")
    digest = lambda value: F.sha2(F.encode(value, "UTF-8"), 256)
    return joined.select(
        "conv_id",
        "n_turns",
        digest(text("turns")).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        digest(text("loss")).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
