"""Chat formatting in budgeted windows with a loss mask.

A conversation's turns get token counts and their prefix sums.  Windows are spans of whole
turns: a window takes turns while their tokens, by prefix sums, fit the budget beside the
system turn and the history.  Each window repeats the system turn, then as many of the turns
just before it as fit the history budget, then its own turns.  Only assistant texts among
its own turns are targets; repeated ones are masked.  A turn longer than the budget is a
window's only own turn and stays whole.

Template: ``<s>role\\ntext</s>`` per turn.  Inside roles and texts ``\\``, ``<`` and ``[`` are
written ``\\e``, ``\\l`` and ``\\b``, so no text can hold a mark of this or of a bracket
template, and undoing it gives every text back.

Native expressions only.  Defined results: rows are ordered by turn, then role and text; a
null role or text is empty; a null conv_id is one conversation of its own.  Repeated rows
are turns.  An empty table gives no windows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET_TOKENS, HISTORY_TOKENS = 512, 128
BEGIN, END = "<s>", "</s>"
#: In this order when escaping, in the opposite order when undoing.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
TARGET, SYSTEM = "assistant", "system"


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def token_count(text: Column) -> Column:
    """Words, plus two for the marks of a turn."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) + 2


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _windows(turns: Column, budget: int, history: int) -> Column:
    """(system, history start, start, end) of each window; ``turns`` carry prefix sums ``upto``."""
    n = F.size(turns)
    before = lambda i: F.when(i > 0, F.get(turns, i - 1)["upto"]).otherwise(F.lit(0))
    has_system = F.coalesce(F.get(turns, F.lit(0))["role"] == SYSTEM, F.lit(False))
    head = F.when(has_system, F.lit(1)).otherwise(F.lit(0))
    room = F.greatest(F.lit(budget - history) - F.when(has_system, F.get(turns, F.lit(0))["upto"]).otherwise(F.lit(0)), F.lit(1))
    # A window starts at the first turn that is not the system turn, and wherever the next turn no longer fits.
    starts = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.array().cast("array<int>"),
        lambda acc, i: F.when((i < head) & (n > head), acc)
        .when(F.size(acc) == 0, F.array(i))
        .when(F.get(turns, i)["upto"] - before(F.element_at(acc, -1)) > room, F.concat(acc, F.array(i)))
        .otherwise(acc),
    )
    return _bound(
        starts,
        lambda s: F.transform(
            s,
            lambda start, k: F.struct(
                F.when(n > head, head).otherwise(F.lit(0)).alias("head"),
                F.coalesce(
                    F.array_min(
                        F.filter(
                            F.sequence(F.greatest(start - history // 2, head), start),  # a turn has two tokens at least
                            lambda j: before(start) - before(j) <= history,
                        )
                    ),
                    start,
                ).alias("from"),
                start.alias("start"),
                F.coalesce(F.get(s, k + 1), n).alias("end"),
            ),
        ),
    )


def format_windows(
    conversations: DataFrame, budget_tokens: int = BUDGET_TOKENS, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, n_own, n_tokens, text and loss spans of the text.

    The first ``n_repeated`` turns of a window are the system turn and history.  Loss spans
    are code points of ``text``, the end exclusive.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    counted = held.select("conv_id", "turns", F.transform("turns", lambda t: token_count(t["text"])).alias("tokens"))
    sums = F.aggregate(
        "tokens",
        F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"] + x)).alias("all")),
    )["all"]
    summed = counted.select("conv_id", F.arrays_zip("turns", sums.alias("upto")).alias("z")).select(
        "conv_id",
        F.transform("z", lambda z: F.struct(z["turns"]["role"].alias("role"), z["turns"]["text"].alias("text"), z["upto"].alias("upto"))).alias("turns"),
    )
    spread = summed.select("conv_id", "turns", F.posexplode(_windows(F.col("turns"), budget_tokens, history_tokens)).alias("window", "w"))
    repeated = F.concat(
        F.slice("turns", F.lit(1), F.col("w.head")), F.slice("turns", F.col("w.from") + 1, F.col("w.start") - F.col("w.from"))
    )
    own = F.slice("turns", F.col("w.start") + 1, F.col("w.end") - F.col("w.start"))
    picked = spread.select(
        "conv_id",
        "window",
        F.concat(
            F.transform(repeated, lambda t: F.struct(t["role"], t["text"], F.lit(False).alias("own"))),
            F.transform(own, lambda t: F.struct(t["role"], t["text"], F.lit(True).alias("own"))),
        ).alias("parts"),
    )
    marked = picked.select(
        "conv_id",
        "window",
        F.transform(
            "parts",
            lambda p: F.struct(
                F.concat(F.lit(BEGIN), escaped(p["role"], ROLE_ESCAPES), F.lit("\n")).alias("head"),
                escaped(p["text"]).alias("body"),
                p["own"].alias("own"),
                (p["own"] & (p["role"] == TARGET)).alias("target"),
                token_count(p["text"]).alias("tokens"),
            ),
        ).alias("parts"),
    )
    span = "array<struct<start:bigint,end:bigint>>"
    masks = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(span).alias("out")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("bigint").alias("at"),
            F.when(
                p["target"],
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(p["head"])).cast("bigint").alias("start"),
                            (a["at"] + F.length(p["head"]) + F.length(p["body"])).cast("bigint").alias("end"),
                        )
                    ),
                ),
            ).otherwise(a["out"]).alias("out"),
        ),
    )["out"]
    return marked.select(
        "conv_id",
        "window",
        F.size(F.filter("parts", lambda p: ~p["own"])).alias("n_repeated"),
        F.size(F.filter("parts", lambda p: p["own"])).alias("n_own"),
        F.aggregate("parts", F.lit(0), lambda a, p: a + p["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("text"),
        masks.alias("loss_spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts and masks alone: turns, loss text and length.

    A system turn of the first window is new there and repeated later.
    """
    parsed = windows.select(
        "conv_id",
        "window",
        F.length("text").cast("bigint").alias("chars"),
        F.transform(
            F.filter(F.split("text", END), lambda t: t != ""),
            lambda t: F.struct(
                unescaped(F.substring_index(F.substr(t, F.lit(len(BEGIN) + 1)), "\n", 1), ROLE_ESCAPES).alias("role"),
                unescaped(F.substr(t, F.locate("\n", t) + 1)).alias("text"),
            ),
        ).alias("turns"),
        "n_repeated",
        F.transform(
            "loss_spans",
            lambda s: unescaped(F.substr(F.col("text"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))),
        ).alias("losses"),
    )
    fresh = parsed.select(
        "conv_id",
        "chars",
        F.struct(
            "window",
            F.when(F.col("window") == 0, F.col("turns"))
            .otherwise(F.slice("turns", F.col("n_repeated") + 1, F.size("turns")))
            .alias("turns"),
            "losses",
        ).alias("w"),
    )
    held = fresh.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"), F.sum("chars").alias("formatted_chars"))
    return held.select(
        "conv_id",
        F.flatten(F.transform("ws", lambda w: w["turns"])).alias("turns"),
        F.array_join(F.flatten(F.transform("ws", lambda w: w["losses"])), "").alias("loss"),
        "formatted_chars",
    )


def digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars."""
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(windows).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turn_text, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
