"""Chat formatting from the perspective of every participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of the rendered dialogue, and the role that sets the scene.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SCENE = "system"
#: Turns of a rendered block.  A longer dialogue has a row a block, to be read in order.
BLOCK = 512


def _piece(who: Column, said: Column, speaker: Column) -> tuple[Column, Column]:
    """Head and content of a turn as the speaker sees it; a name can neither open a mark nor end its line."""
    name = F.translate(F.replace(who, F.lit("<|"), F.lit("< |")), "\n\r", "  ")
    head = (
        F.when(who == SCENE, F.lit(f"{OPEN}{SCENE}\n"))
        .when(who == speaker, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), name, F.lit("\n")))
    )
    return head, said


def perspectives(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The dialogue of each conversation as each participant sees it.

    Columns: conv_id, speaker, block, text, mask, n_turns, n_target_chars.  The speaker's
    own turns are the assistant's, those of others are a user's of that name, and the
    scene (role "system") is the scene's for all; it is no participant, so a dialogue of
    scenes alone gives no row.  ``mask`` lists the spans of ``text`` (characters, end
    excluded) to learn from, the contents of the speaker's own turns and the mark that
    closes them, as "start:end,start:end"; it is empty where the block has none.

    Turns come in the order of turn (null first), role and text, so ties and repeated
    rows have a defined place and are all rendered.  A null role is "unknown", a null
    text is empty, a null conv_id is a conversation; the opening "<|" of a mark inside a
    text or a name becomes "< |", and a line end in a name a space.  Extra columns are
    ignored; an empty table gives an empty result.  Blocks are ranges of turn numbers,
    so a conversation of any length is rendered by many tasks; turns that share a number,
    or have none, share a block.
    """
    told = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("who"),
        F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"),
    ).withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(0)) / block).cast("bigint"))
    speakers = told.where(F.col("who") != SCENE).select(F.col("conv_id").alias("_conv"), F.col("who").alias("speaker")).distinct()
    blocks = told.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "who", "said"))).alias("turns"))
    seen = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def rendered(t: Column) -> Column:
        head, said = _piece(t["who"], t["said"], F.col("speaker"))
        return F.struct(
            F.concat(head, said, F.lit(CLOSE)).alias("piece"),
            F.length(head).cast("bigint").alias("head"),
            (F.length(said) + len(CLOSE)).cast("bigint").alias("rest"),
            (t["who"] == F.col("speaker")).alias("own"),
        )

    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("mask"), F.lit(0).cast("bigint").alias("chars"))

    def onward(state: Column, p: Column) -> Column:
        start, end = state["at"] + p["head"], state["at"] + p["head"] + p["rest"]
        comma = F.when(state["mask"] == "", F.lit("")).otherwise(F.lit(","))
        span = F.concat(state["mask"], comma, start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            end.alias("at"),
            F.when(p["own"], span).otherwise(state["mask"]).alias("mask"),
            (state["chars"] + F.when(p["own"], p["rest"]).otherwise(0)).alias("chars"),
        )

    seen = seen.withColumn("pieces", F.transform("turns", rendered)).withColumn(
        "state", F.aggregate("pieces", nothing, onward)
    )
    return seen.select(
        "conv_id",
        "speaker",
        "block",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
        F.col("state.mask").alias("mask"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.col("state.chars").alias("n_target_chars"),
    )
