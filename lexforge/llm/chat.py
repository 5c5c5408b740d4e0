"""Chat formatting: the same dialogue from every participant's perspective, by DataFrame functions alone.

For each participant the whole dialogue is rendered with that speaker as the assistant and all others as users who bear their names;
the mask covers the assistant's words and end marks. System turns are the frame: they are rendered as such, unmasked, and have no perspective.

A rendering is one row, or several if it is long: a turn belongs to part ``offset div PART_CHARS``, where the offset is the number of code points
before it. Parts joined in order are the whole rendering, so a dialogue of any length is never gathered in one row. Offsets are
prefix sums: turns are ranged by conversation and place, summed inside each range, and shifted by the sums of the ranges before, so one very
long conversation is spread over many tasks.

Defined cases: turns of equal number are ordered by speaker and text; a null text is empty; a turn with a null speaker is a user
without a name and has no perspective; a null conversation id is one conversation; repeated rows are turns of their own; a dialogue without
participants has no rendering; line ends in names become spaces, and turn marks inside texts and names are written with a space, so that a text
can't open or close a turn; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.joins import null_safe_join
from lexforge.operators.materialize import materialize

PART_CHARS = 32_768
SYSTEM = ("system",)

# The marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(value: Column) -> Column:
    return F.replace(F.coalesce(value, F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def running_sum(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group that come before, in an order, on any number of tasks.

    Every row has a number in its range; a group that spans ranges is summed range by range. Rows are returned with ``_at``, which orders
    rows of one group.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(c) for c in [*group, *order]]
    ordered = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    table = materialize(ordered.withColumn("_range", F.spark_partition_id()), "ordered")
    inside = Window.partitionBy(*group, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    totals = totals.select(*group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    summed = null_safe_join(table, totals, group, "inner", never_null=["_range"])
    return summed.withColumn(out, F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_range")


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
           system: Sequence[str] = SYSTEM, part_chars: int = PART_CHARS) -> DataFrame:
    """(conversation, perspective, part, start, n_turns, text, masks): masks are spans of the part's text, ends exclusive."""
    rows = turns.select(F.col(conversation).alias("_conv"), F.col(turn).alias("_turn"), F.col(speaker).cast("string").alias("_name"), F.col(text).alias("_text"))
    framing = F.coalesce(F.col("_name").isin(*system), F.lit(False))
    people = rows.filter(F.col("_name").isNotNull() & ~framing).select("_conv", F.col("_name").alias("perspective")).distinct()
    faced = _faced(rows, people)
    mine = F.col("_name").eqNullSafe(F.col("perspective"))
    name = F.translate(_safe(F.col("_name")), "\r\n", "  ")
    called = F.when(framing, "system").when(mine, "assistant").when(F.col("_name").isNull(), "user").otherwise(F.concat(F.lit("user name="), name))
    head = F.concat(F.lit(OPEN), called, F.lit("\n"))
    rendered = faced.select("_conv", "perspective", "_turn", "_name", "_text", F.concat(head, _safe(F.col("_text")), F.lit(CLOSE + "\n")).alias("_said"),
                            F.when(mine, F.char_length(head)).alias("_from"))
    rendered = rendered.withColumn("_size", F.char_length("_said").cast("long"))
    placed = running_sum(rendered, ["_conv", "perspective"], ["_turn", "_name", "_text"], "_size", "_offset").withColumn("part", F.floor(F.col("_offset") / part_chars))
    pieces = F.sort_array(F.collect_list(F.struct("_offset", "_at", "_said", "_from", "_size"))).alias("_p")
    parts = placed.groupBy("_conv", "perspective", "part").agg(pieces)
    start = F.col("_p")[0]["_offset"]
    spoken = F.filter("_p", lambda p: p["_from"].isNotNull())
    # the mask ends with the end mark, before the line end
    masks = F.transform(spoken, lambda p: F.struct((p["_offset"] - start + p["_from"]).alias("start"), (p["_offset"] - start + p["_size"] - 1).alias("end")))
    return parts.select(F.col("_conv").alias(conversation), "perspective", "part", start.alias("start"), F.size("_p").alias("n_turns"),
                        F.array_join(F.transform("_p", lambda p: p["_said"]), "").alias("text"), masks.alias("masks"))


def _faced(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Every turn once for each participant of its conversation."""
    named = people.withColumnRenamed("_conv", "_of")
    return rows.join(named, rows["_conv"].eqNullSafe(named["_of"])).drop("_of")
