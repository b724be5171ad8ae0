"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that
speaker as ``assistant`` and everyone else as a named ``user``; the loss mask of
a view covers what its own speaker says, end mark included.  System turns take
no part: they are rendered as system turns in every view.

A view of up to ``PART_TURNS`` turns is one row with the whole dialogue.  A longer
one is written in parts of so many turns each, however they are numbered, with
the place of each part in the whole view, so that no task holds a conversation
of unbounded length.  Joined in order (``text`` by ``part``), the parts are the
view, and a mask's place in the view is its place in the part plus ``start``.

Turns are ordered by number, then speaker, then text.  Defined results: a null
text is an empty turn; a turn with a null speaker is the user ``unknown``, who
has a view as well; a null turn number sorts first; a null conversation id is a
conversation of its own; repeated rows are turns of their own; a conversation
of system turns only has no views; marks inside a text are broken up so that
they cannot open or close a turn; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .ordered import running_sums

PART_TURNS = 512
SYSTEM = "system"
UNKNOWN = "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    """A text in which no mark of the format can be read."""
    return F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def perspective_views(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      speaker_col: str = "role", text_col: str = "text",
                      part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, perspective and part.

    Columns: ``conv_col``, ``perspective``, ``part``, ``n_turns``, ``start``
    (place of the part in the view, in characters), ``text`` and ``masks``
    (array of ``start``/``stop`` places in the part's text to train on).
    """
    said = turns.select(
        F.col(conv_col).alias("conv"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
        F.col(turn_col).isNotNull().alias("numbered"),
        F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNKNOWN)).alias("speaker"),
        _safe(F.col(text_col)).alias("said"))
    keyed = said.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")))
    said = stage(running_sums(keyed, ["key"], ["numbered", "turn", "speaker", "said"], "at")
                 .withColumn("part", F.expr(f"at div {part_turns}")), "turns")
    speakers = (said.where(F.col("speaker") != SYSTEM)
                .select(F.col("conv").alias("of"), F.col("speaker").alias("perspective")).distinct())
    views = said.join(speakers, F.col("conv").eqNullSafe(F.col("of")))
    own = F.col("speaker") == F.col("perspective")
    head = F.when(F.col("speaker") == SYSTEM, F.lit("system")).when(own, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), _safe(F.col("speaker"))))
    views = views.select(
        "conv", "perspective", "part",
        F.struct("numbered", "turn", "speaker", "said", F.concat(F.lit(BEGIN), head, F.lit("\n")).alias("head"),
                 own.alias("own")).alias("x"))
    parts = views.groupBy("conv", "perspective", "part").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    ends = F.transform("xs", lambda x: F.concat(x["head"], x["said"], F.lit(END + "\n")))
    parts = parts.withColumn("pieces", ends)
    # running ends of the turns, in characters
    parts = parts.withColumn("stops", F.aggregate(
        "pieces", F.array(F.lit(0).cast("long")),
        lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p)))))
    masks = F.filter(F.transform("xs", lambda x, k: F.when(x["own"], F.struct(
        (F.get("stops", k) + F.length(x["head"])).alias("start"),
        (F.get("stops", k + 1) - 1).alias("stop")))), lambda m: m.isNotNull())
    parts = parts.select("conv", "perspective", "part", F.size("xs").cast("long").alias("n_turns"),
                         F.element_at("stops", -1).alias("chars"), F.array_join("pieces", "").alias("text"),
                         masks.alias("masks"))
    before = Window.partitionBy("conv", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(F.col("conv").alias(conv_col), "perspective", "part", "n_turns",
                        F.coalesce(F.sum("chars").over(before), F.lit(0)).cast("long").alias("start"),
                        "text", "masks")
