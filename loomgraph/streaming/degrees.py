"""Degrees kept up to date from a stream of edges, and counts of events in windows of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def degree_stream(edges: DataFrame) -> DataFrame:
    """page_id, in_degree, out_degree over all edges so far; write it in update or complete mode. State is one row for
    each page."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src_id").alias("page_id"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("dst_id").alias("page_id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    return ends.groupBy("e.page_id").agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums of events by type in windows of time; events later than late are left out, and so is the state
    of windows that old."""
    w = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
