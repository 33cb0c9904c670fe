"""Queries on time windows, as batch twins of the streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.windows import event_windows
from .registry import query


@query("st_event_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS w_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS w_end, event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 5) AS mean FROM events GROUP BY 1, 2, 3")
def st_event_windows(spark, sf):
    return event_windows(spark.read.parquet(f"{sf}/events.parquet")).withColumns({"total": F.round("total", 4), "mean": F.round("mean", 5)})

