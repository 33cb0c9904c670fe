"""Windows over arriving rows.

Late rows are dropped by the watermark; results come out once when a window
can't change any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.intervals import sliding_windows


def event_windows(events: DataFrame, width: str = "1 hour", step: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events per time window and type: number, sum and mean of value."""
    windowed = events.withWatermark("ts", late).groupBy(F.window("ts", width, step), "event_type")
    out = windowed.agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
    return out.select(F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), "event_type", "n", "total", "mean")


def arriving_sites(sites: DataFrame, width: int, step: int, late: str = "1 hour") -> DataFrame:
    """Genome windows over site files as they arrive (arrived: a timestamp): sums per window and hour of arrival, which add up to the batch result."""
    rows = sliding_windows(sites.withWatermark("arrived", late), width, step)
    out = rows.groupBy(F.window("arrived", "1 hour"), "sample", "ref", "w_start", "w_end").agg(F.count("*").alias("n_cpg"), F.sum("m").alias("m"), F.sum("cov").alias("cov"))
    return out.drop("window")
