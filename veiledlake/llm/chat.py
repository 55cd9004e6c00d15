"""Chat formatting: every participant's view of a dialogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veiledlake.llm.common import broadcast_if_small, settled

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
# Turns of a dialogue that make one row. Nearly all dialogues are one row; a longer one is dealt out to several.
BLOCK = 256
# A block with more rows than this (equal turn numbers) is dealt out further.
CROWD = 4 * BLOCK


def perspectives(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each dialogue once for every participant, with that one as the assistant.

    Participants are the roles but `system`; a null role is a participant of the empty name. Their own turns are headed
    `assistant`, those of the others `user name=...`, and system turns stay so. `spans` are the code points (start, end,
    end exclusive) of the participant's texts with their closing marks: what a loss is taken on. The marks of the format
    are broken up where they stand in a text.

    One row for conversation, perspective and block of turns: conv_id, perspective, block, n_turns, n_own, text, spans.
    Blocks go by turn number (null: block -1, first) and are in order; offsets count from the block's begin. A block
    crowded by equal turn numbers is split by number, and then by hash of the text, into more blocks (`slice`). Turns of
    one number stand by hash, role and text. Repeated rows are repeated. A conversation of system turns only has no row.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1)).cast("long"))
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    crowded = settled(sizes.where(F.col("n") > CROWD).withColumn("shares", F.ceil(F.col("n") / CROWD).cast("long")))
    if crowded.isEmpty():
        rows = rows.withColumn("slice", F.lit(0).cast("long"))
    else:
        crowd = broadcast_if_small(crowded.select(F.col("conv").alias("c"), F.col("block").alias("b"), "shares"))
        rows = rows.join(crowd, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
        rows = rows.withColumn("slice", F.coalesce(_slice(), F.lit(0)).cast("long"))
    blocks = rows.groupBy("conv", "block", "slice").agg(
        F.sort_array(F.collect_list(F.struct("turn", "tie", "role", "text"))).alias("turns")
    )
    # Dialogues in several rows: their participants are gathered apart.
    wide = rows.groupBy("conv").agg(
        F.min(F.struct("block", "slice")).alias("a"),
        F.max(F.struct("block", "slice")).alias("b"),
        F.collect_set(F.when(F.col("role") != SYSTEM, F.col("role"))).alias("everyone"),
    )
    wide = wide.where("a <> b").select(F.col("conv").alias("c"), F.explode("everyone").alias("perspective"))
    wide = settled(wide)
    here = F.array_distinct(F.transform(F.filter("turns", lambda t: t["role"] != SYSTEM), lambda t: t["role"]))
    if not wide.isEmpty():
        known = wide.groupBy("c").agg(F.collect_list("perspective").alias("everyone"))
        small = broadcast_if_small(wide) is not wide
        blocks = blocks.join(
            F.broadcast(known) if small else known, F.col("conv").eqNullSafe(F.col("c")), "left"
        )
        here = F.coalesce("everyone", here)
    views = blocks.select("conv", "block", "slice", "turns", F.explode(here).alias("perspective"))
    pieces = F.transform("turns", lambda t: _piece(t, F.col("perspective")))
    views = views.withColumn("pieces", pieces)
    return views.select(
        F.col("conv").alias(conv_id),
        "perspective",
        "block",
        "slice",
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        _spans(F.col("pieces")).alias("spans"),
    )


def _slice() -> Column:
    """By turn number within the block, then by the range its hash falls in."""
    share = F.floor((F.shiftrightunsigned(F.col("tie"), 33) / float(1 << 31)) * F.col("shares"))
    within = F.coalesce(F.pmod(F.col("turn"), F.lit(BLOCK)), F.lit(0))
    return within * F.col("shares") + share


def _piece(t: Column, perspective: Column) -> Column:
    own = t["role"] == perspective
    name = F.when(own, "assistant").when(t["role"] == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), _plain(t["role"])))
    return F.struct(
        own.alias("own"),
        F.concat(F.lit(OPEN), name, F.lit("\n")).alias("head"),
        F.concat(_plain(t["text"]), F.lit(CLOSE)).alias("body"),
    )


def _plain(value: Column) -> Column:
    return F.replace(value, F.lit("<|"), F.lit("< |"))


def _spans(pieces: Column) -> Column:
    """Start and end of the bodies that are the participant's own."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        body = s["at"] + F.length(p["head"])
        end = body + F.length(p["body"])
        one = F.array(F.struct(body.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(s["spans"], one)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step, lambda s: s["spans"])
