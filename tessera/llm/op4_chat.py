"""Multi-party perspective rotation with DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; context roles (system)
keep their place and are nobody's perspective. Loss masks are the character
ranges of the assistant's turns, end mark included.

A dialogue comes in *segments* of a fixed range of turn numbers, one row for
each perspective and segment; the segments in order are the dialogue. A segment
of more rows than it has turn numbers (repeated or missing numbers) comes in
*parts* of at most that many rows: rows are numbered by sorting them into ranges
and counting the ranges, so that no task or group holds such a segment. Masks
count from the start of their part. With ``segment_turns=None`` each
conversation is one row, whole; it must then fit a task.

Null texts are empty, null roles are the user ``unknown``; turns without a
number make a segment of their own, without a number. Equal turn numbers and
repeated rows stay, ordered by role and text. Rows with a null conversation
form one conversation. The mark ``<|`` inside a text or role is broken by a
space. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

#: Turn numbers of one segment, and rows of one part at most.
SEGMENT_TURNS = 64
CONTEXT_ROLES = ("system",)


def _plain(value: Column, default: str) -> Column:
    return F.replace(F.coalesce(value, F.lit(default)), F.lit("<|"), F.lit("< |"))


def _parts(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (conv, segment, turn, role, text) with their part, by their number within the segment."""
    group = ["conv", "segment"]
    large = rows.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > size).select(F.col("conv").alias("c"), F.col("segment").alias("s"))
    large = materialize(large, "large-segments")
    if not large.take(1):
        return rows.withColumn("part", F.lit(0).cast("long"))
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("segment").eqNullSafe(F.col("s"))
    few = rows.join(large, same, "left_anti").withColumn("part", F.lit(0).cast("long"))
    order = ["turn", "role", "text", "id"]  # the id spreads identical rows over ranges
    many = rows.withColumn("id", F.monotonically_increasing_id()).join(large, same, "left_semi")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(many.repartitionByRange(ranges, *group, *order).withColumn("range", F.spark_partition_id()), "ranges")
    nth = F.row_number().over(Window.partitionBy(*group, "range").orderBy(*order))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = placed.groupBy(*group, "range").agg(F.count("*").alias("n"))
    offsets = counts.select(F.col("conv").alias("c"), F.col("segment").alias("s"), F.col("range").alias("r"), before.alias("before"))
    joined = placed.withColumn("nth", nth).join(offsets, same & (F.col("range") == F.col("r")))
    part = F.floor((F.col("before") + F.col("nth") - 1) / size).cast("long")
    return few.unionByName(joined.select(*rows.columns, part.alias("part")))


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment_turns: int | None = SEGMENT_TURNS,
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
) -> DataFrame:
    """(conversation, speaker, segment, part, n_turns, n_spoken, rendered, masks) for every participant and part of a segment."""
    rows = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), _plain(F.col(role), "unknown").alias("role"), _plain(F.col(text), "").alias("text")
    )
    speakers = rows.where(~F.col("role").isin(*context_roles)).select(F.col("conv").alias("of"), F.col("role").alias("speaker")).distinct()
    if segment_turns is None:
        rows = rows.withColumns({"segment": F.lit(0).cast("long"), "part": F.lit(0).cast("long")})
    else:
        rows = _parts(rows.withColumn("segment", F.floor(F.col("turn") / segment_turns)), segment_turns)
    segments = rows.groupBy("conv", "segment", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    views = segments.join(speakers, F.col("conv").eqNullSafe(F.col("of")))

    spoken = lambda t: t["role"] == F.col("speaker")
    head = lambda t: (
        F.when(spoken(t), F.lit("<|assistant|>\n"))
        .when(t["role"].isin(*context_roles), F.concat(F.lit("<|"), t["role"], F.lit("|>\n")))
        .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n")))
    )
    body = lambda t: F.concat(t["text"], F.lit("<|end|>\n"))
    pieces = views.withColumn("pieces", F.transform("turns", lambda t: F.struct(head(t).alias("head"), body(t).alias("body"), spoken(t).alias("own"))))
    lengths = F.transform("pieces", lambda p: F.struct(F.length(p["head"]).alias("h"), F.length(p["body"]).alias("b"), p["own"].alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("masks"))
    masks = F.aggregate(
        lengths,
        start,
        lambda a, p: F.struct(
            (a["at"] + p["h"] + p["b"]).alias("at"),
            F.when(p["own"], F.concat(a["masks"], F.array(F.struct((a["at"] + p["h"]).alias("start"), (a["at"] + p["h"] + p["b"]).alias("end")))))
            .otherwise(a["masks"])
            .alias("masks"),
        ),
        lambda a: a["masks"],
    )
    return pieces.select(
        F.col("conv").alias(conversation),
        "speaker",
        "segment",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_spoken"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        masks.alias("masks"),
    )
