"""Preference records: a prompt rendered once, and two completions with loss masks.

Chosen and rejected conversations of a pair are compared turn by turn. The turns before the first difference are the
prompt; from there on each side has its completion. Only the turns of ``TRAINED`` roles are trained on.

A turn is a row throughout, so a conversation of any length is spread over tasks. Texts are shuffled twice: rows that both
sides share become one, then go to their stretch of turns. Places of characters are sums over earlier turns, taken over
stretches of turns first and inside a stretch then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

TRAINED = ("assistant",)
#: Turns of a stretch.
STRETCH = 256


def render(role: Column, text: Column) -> Column:
    """A turn in the chat template; NULL role and text are empty."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def _rows(frame: DataFrame, good: bool, bad: bool, edit: bool = False) -> DataFrame:
    flags = [F.lit(x).alias(n) for n, x in (("good", good), ("bad", bad), ("edit", edit))]
    turn = F.coalesce(frame["turn"], F.lit(-1)).cast("long").alias("turn")
    return frame.select(frame["pair_id"].alias("pair_id"), turn, frame["role"].alias("role"), frame["text"].alias("text"), *flags)


def preferences(chosen: DataFrame, rejected: DataFrame, trained: Sequence[str] = TRAINED) -> DataFrame:
    """One row per rendered turn: pair_id, part, turn, copy, role, rendered, char_start, char_end, trained.

    Both sides need pair_id, turn, role and text; other columns, whatever their names, are not read. ``part`` is prompt,
    chosen or rejected; the prompt is the longest common prefix of turns (equal number, role and text, NULL equal
    to NULL) and is given once. Completion places go on from the prompt's end, so prompt and completion of a side
    laid end to end are its rendered conversation. ``trained`` is true for the turns of a completion whose role is
    trained. A side that ends within the other, or is missing, has an empty completion. A NULL turn comes first, as
    turn -1; rows that repeat a turn exactly count once, others of a turn follow each other by role and text; turns
    without pair_id are left out; empty tables give no rows.
    """
    return _paired(_rows(chosen, True, False).unionByName(_rows(rejected, False, True)), trained)


def edited_preferences(chosen: DataFrame, edits: DataFrame, trained: Sequence[str] = TRAINED) -> DataFrame:
    """``preferences`` where the rejected side is the chosen one but for some turns, which spares a second copy of it.

    ``edits`` has pair_id, turn, role and text: on the rejected side the turns with that number and role give way to it; several
    edits of one turn and role all stand there, and where the chosen side has no such turn it is added. The rest is as in ``preferences``.
    """
    return _paired(_rows(chosen, True, True).unionByName(_rows(edits, False, False, edit=True)), trained)


def _paired(sides: DataFrame, trained: Sequence[str]) -> DataFrame:
    """Both sides in one order of turn, role and text, so that the prompt is what stands before the first row of one side only.

    Earlier rows of a side, prompt or not, are also earlier in its rendered conversation: places need no knowledge of the prompt.
    """
    key = ["pair_id", "turn", "role", "text"]
    distinct = sides.filter(F.col("pair_id").isNotNull()).groupBy(*key).agg(*[F.max(c).alias(c) for c in ("good", "bad", "edit")])
    # never NULL: the join's test for it would keep the two branches from sharing their first exchange
    stretch_of = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(0)).alias("stretch")
    rows = distinct.select(
        *key, stretch_of, F.length(render(F.col("role"), F.col("text"))).cast("long").alias("n"), "good", "bad", "edit"
    ).repartition("pair_id", "stretch")
    stretch = ["pair_id", "stretch"]
    of_turn = Window.partitionBy(*stretch, "turn", "role")
    differs = F.col("good") != F.col("bad")

    # without texts: what each stretch adds, then what stands before it
    length = lambda side: F.sum(F.when(F.col(side), F.col("n")).otherwise(0))
    sums = rows.withColumn("bad", _rejected(of_turn)).groupBy(*stretch).agg(length("good").alias("g"), length("bad").alias("b"), F.max(differs).alias("d"))
    earlier = Window.partitionBy("pair_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *stretch, F.coalesce(F.sum("g").over(earlier), F.lit(0)).alias("g"), F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b"),
        F.coalesce(F.max("d").over(earlier), F.lit(False)).alias("d"),
    )

    # one sort by turn, role and text serves all windows
    whole = of_turn.orderBy("text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = Window.partitionBy(*stretch).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copies = Window.partitionBy(*stretch, "turn").orderBy("role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("bad", _rejected(whole)).select(
        *key, "stretch", "n", "good", "bad", F.max(differs).over(inside).alias("seen"),
        *[length(c).over(inside).alias(f"{c}_upto") for c in ("good", "bad")],
        *[F.count_if(c).over(copies).cast("int").alias(f"{c}_copy") for c in ("good", "bad")],
    ).join(bases, stretch)

    def part(name: str, side: str, base: str) -> Column:
        end = F.col(base) + F.col(f"{side}_upto")
        return F.struct(F.lit(name).alias("part"), F.col(f"{side}_copy").alias("copy"), (end - F.col("n")).alias("char_start"), end.alias("char_end"))

    one_side = [F.when(F.col(side), part(name, side, base)) for name, side, base in (("chosen", "good", "g"), ("rejected", "bad", "b"))]
    parts = F.when(F.col("d") | F.col("seen"), F.array_compact(F.array(*one_side))).otherwise(F.array(part("prompt", "good", "g")))
    return placed.select("pair_id", "turn", "role", "text", F.explode(parts).alias("p")).select(
        "pair_id", "p.part", "turn", "p.copy", "role", render(F.col("role"), F.col("text")).alias("rendered"), "p.char_start", "p.char_end",
        ((F.col("p.part") != "prompt") & F.coalesce(F.col("role").isin(*trained), F.lit(False))).alias("trained"),
    )


def _rejected(of_turn: WindowSpec) -> Column:
    """Whether the rejected side has the row: an edit takes the place of the other rows of its turn and role."""
    return F.col("edit") | (F.col("bad") & ~F.max("edit").over(of_turn))


def records(turns: DataFrame) -> DataFrame:
    """Whole records for pairs whose conversations fit in a row: pair_id, prompt, chosen, rejected and trained spans."""
    part = lambda name: F.array_sort(F.collect_list(F.when(F.col("part") == name, F.struct("char_start", "char_end", "rendered", "trained"))))
    names = ("prompt", "chosen", "rejected")
    joined = turns.groupBy("pair_id").agg(*[part(n).alias(f"_{n}") for n in names])
    spans = lambda n: F.transform(F.filter(f"_{n}", lambda t: t["trained"]), lambda t: F.struct(t["char_start"].alias("start"), t["char_end"].alias("end")))
    return joined.select(
        "pair_id",
        *[F.array_join(F.col(f"_{n}")["rendered"], "").alias(n) for n in names],
        *[spans(n).alias(f"{n}_trained") for n in names[1:]],
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Edits for a plain table of conversations (conv_id, turn, role, text): the last answer is that of the partner conversation.

    Partners are the conversations 2n and 2n + 1. Columns pair_id, turn, role, text, at most one row per conversation. A
    conversation without answer, or whose partner has none, has no edit, nor have rows without conv_id. Answers without
    turn do not count; of several answers in the last turn the greatest text is taken, a NULL one as empty. Repeated rows
    change nothing, an empty table gives no rows, other columns are not read.
    """
    rows = conversations.select(*[conversations[c].alias(c) for c in ("conv_id", "turn", "role", "text")])
    answers = rows.filter((F.col("role") == "assistant") & F.col("turn").isNotNull() & F.col("conv_id").isNotNull())
    answer = F.struct("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    last = lambda odd: F.max(F.when(F.col("conv_id").bitwiseAND(1) == odd, answer))
    both = answers.groupBy(F.shiftright("conv_id", 1).alias("n")).agg(last(0).alias("even"), last(1).alias("odd")).filter("even is not null and odd is not null")
    edit = lambda to, of: F.struct(F.col(f"{to}.conv_id").alias("pair_id"), F.col(f"{to}.turn").alias("turn"), F.lit("assistant").alias("role"), F.col(f"{of}.text").alias("text"))
    return both.select(F.inline(F.array(edit("even", "odd"), edit("odd", "even"))))
