"""Calls counted as sorted reads arrive, a region at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sites import pileup

#: Places of a reference, more than any has; a place in the genome is then a time that the watermark can follow.
SPAN = 3_000_000_000


def region_pileup(calls: DataFrame, order: list[str], region: int = 1 << 20, read_length: int = 1000, min_quality: int = 0, by: tuple[str, ...] = ("ref", "pos")) -> DataFrame:
    """pileup of arriving calls (ref, pos, meth, baseq, `by`), whose reads come sorted by reference (in this order) and place.

    The counts of a region come out once, when a call more than `read_length`
    behind its end has been seen, and its state goes; calls that come later than
    that are dropped. A call at end_of_order() lets the last region out. The
    state is a row for each position of the open regions, dealt out by position.
    Calls of other references are left out.
    """
    number = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("ref"))
    place = F.timestamp_millis((number - 1) * SPAN + F.col("pos"))
    placed = calls.filter(number > 0).withColumn("place", place).withWatermark("place", f"{read_length} milliseconds")
    counted = pileup(placed.withColumn("region", F.window("place", f"{region} milliseconds")), min_quality, ("region", *by))
    return counted.drop("region")


def end_of_order(order: list[str]) -> tuple[str, int]:
    """Reference and position behind all reads."""
    return order[-1], SPAN - 1
