"""Multi-party perspective rotation of dialogues.

A dialogue yields one training example per participant: that speaker's turns become the assistant's,
all other speakers are named users, and only the speaker's own words are learned from (mask). System
turns are no participant's; they stay system turns in every example.

The result has one row per example and turn, with the rendered message, its place in the example
(``start``, ``end``: characters of the messages laid end to end) and the masked span. So a dialogue
of any length is never held in one row or group: lengths are added up per block of ``BLOCK`` turns,
blocks are added up per dialogue, and a turn's place is the sum of both.

Defined results: turns are ordered by (turn, role, text), null turns first; a null role is the
participant ``unknown``; a null text is empty; a null conv_id is a dialogue of its own; repeated rows
are turns of their own; a dialogue of system turns alone has no participant and gives no rows.
Marks of the format inside a text are broken up, so that no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, speaker, content: cleaned turns."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("content"),
    )


def _message(role: Column, name: Column, content: Column) -> tuple[Column, Column]:
    """What stands before the content, and the whole message."""
    head = F.concat(
        F.lit(OPEN), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(F.lit("")), F.lit("\n")
    )
    return head, F.concat(head, content, F.lit(CLOSE))


def perspectives(conversations: DataFrame) -> DataFrame:
    """conv_id, assistant, turn, nth, role, name, message, start, end, mask_start, mask_end."""
    said = turns(conversations)
    # Null dialogues match each other only.
    people = said.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("of"), F.col("speaker").alias("assistant")
    ).distinct()
    seen = said.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("assistant")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when((F.col("speaker") != SYSTEM) & ~own, F.col("speaker"))
    head, message = _message(role, name, F.col("content"))
    laid = seen.select(
        "conv_id", "assistant", "turn", "speaker", "content",
        role.alias("role"), name.alias("name"), F.length(head).alias("head"), message.alias("message"),
        F.floor(F.col("turn") / BLOCK).alias("block"),
    ).withColumn("size", F.length("message").cast("long"))
    example, block = ["conv_id", "assistant"], ["conv_id", "assistant", "block"]
    order = [F.col("turn").asc_nulls_first(), F.col("speaker"), F.col("content")]
    upto = Window.partitionBy(*block).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = laid.groupBy(*block).agg(F.sum("size").alias("total"), F.count("*").alias("rows"))
    before = Window.partitionBy(*example).orderBy(F.col("block").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = sums.select(
        F.col("conv_id").alias("c"), F.col("assistant").alias("a"), F.col("block").alias("b"),
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    placed = laid.withColumn("inside", F.sum("size").over(upto)).withColumn("nth", F.row_number().over(upto))
    joined = placed.join(
        base,
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("assistant") == F.col("a"))
        & F.col("block").eqNullSafe(F.col("b")),
    )
    end = F.col("base") + F.col("inside")
    learned = F.col("role") == "assistant"
    return joined.select(
        "conv_id",
        "assistant",
        "turn",
        (F.col("rows_before") + F.col("nth") - 1).cast("long").alias("nth"),
        "role",
        "name",
        "message",
        (end - F.col("size")).alias("start"),
        end.alias("end"),
        # The answer and the mark that ends it, which the model must learn to write.
        F.when(learned, end - F.col("size") + F.col("head")).alias("mask_start"),
        F.when(learned, end - 1).alias("mask_end"),
    )
