"""Multi-party chat formatting: one rendering per participant.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant, every other speaker as a named user, and shared roles
(system) as they are.  The mask holds the character ranges to learn from: what
the assistant says, with its end mark.

All of it is DataFrame functions.  Turns are numbered by their place in the
dialogue, from one sort over the whole table that cuts a long conversation between
tasks, so no group grows with a conversation.  A rendering has one row, up to
``CHUNK`` turns; longer dialogues go on in further rows, whose texts follow each
other without a gap and whose masks count from their own start.  Participants are
joined as rows, never gathered.

Defined results: a null text is an empty turn; a null speaker is ``unknown``; null
turns come first; equal turn numbers are ordered by speaker, then by the SHA-256
of the text, and repeated rows are repeated turns; turn numbers need not be
consecutive; null conversation ids form one conversation; conversations of shared
roles only have no participant and no row; extra columns are ignored.  ``<|``
inside a text becomes ``< |``, so texts cannot forge marks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

#: Turns of a row, by their number in the dialogue, whatever turn numbers they carry.
CHUNK = 1024
SHARED_ROLES = ("system",)


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with their place (from 0) in their conversation.

    Sorted by range over all rows: a conversation's place at the start of a task is
    the sum of its rows in the tasks before."""
    keys = ("conv_id", "turn", "speaker", "digest", "tie")
    tied = rows.withColumns({"digest": F.sha2("text", 256), "tie": F.monotonically_increasing_id()})
    told = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"at": F.monotonically_increasing_id(), "task": F.spark_partition_id()})
    told = shared.durable(told.drop("digest", "tie"), "turns")
    tasks = told.groupBy(F.col("conv_id").alias("of"), F.col("task").alias("held")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("of").orderBy("held").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = tasks.select("of", "held", (before - F.col("first")).alias("shift"))
    return told.join(shifts, (F.col("task") == F.col("held")) & F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "speaker", "text", (F.col("at") + F.col("shift")).alias("place"))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", shared_roles: tuple[str, ...] = SHARED_ROLES) -> DataFrame:
    """conv_id, perspective, chunk (from 0), n_turns, text and mask (array of start, end)."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("speaker"), text.alias("text"))
    rows = _placed(rows).withColumn("chunk", F.floor(F.col("place") / F.lit(CHUNK)))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", "speaker", "text"))).alias("said"))
    people = rows.where(~F.col("speaker").isin(*shared_roles)).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = chunks.join(people, F.col("conv_id").eqNullSafe(F.col("of")))

    def segment(s):
        own, shared = s["speaker"] == F.col("perspective"), s["speaker"].isin(*shared_roles)
        who = F.when(own, F.lit("assistant")).when(shared, s["speaker"]).otherwise(F.concat(F.lit("user name="), F.replace(F.replace(s["speaker"], F.lit("\n"), F.lit(" ")), F.lit("<|"), F.lit("< |"))))
        head = F.concat(F.lit("<|im_start|>"), who, F.lit("\n"))
        return F.struct(head.alias("head"), F.concat(s["text"], F.lit("<|im_end|>")).alias("body"), own.alias("own"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def walk(a, s):
        begin = a["at"] + F.char_length(s["head"])
        end = begin + F.char_length(s["body"])
        return F.struct((end + 1).alias("at"), F.when(s["own"], F.array_append(a["spans"], F.struct(begin.alias("start"), end.alias("end")))).otherwise(a["spans"]).alias("spans"))

    shown = seen.withColumn("segments", F.transform("said", segment))
    return shown.select(
        "conv_id", "perspective", "chunk", F.size("said").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("segments", start, walk)["spans"].alias("mask"),
    )
