"""Structured Streaming forms of span mining and repeat removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.speech import AD, hits


def ad_sessions(lines: DataFrame, gap: int = 25, pad: int = 8, late: str = "10 minutes") -> DataFrame:
    """(video_id, start, end) of promotional spans from a stream (video_id, at: timestamp, text); lines up to `gap` seconds apart are one.

    A session window closes `gap` after its last line, itself included, so that a line exactly `gap` later still joins.
    """
    found = hits(lines.withWatermark("at", late), AD)
    spans = found.groupBy("video_id", F.session_window("at", f"{gap * 1000 + 1} milliseconds")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    return spans.select("video_id", F.expr(f"first - interval {pad} seconds").alias("start"), F.expr(f"last + interval {pad} seconds").alias("end"))


def first_lines(lines: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Lines (video_id, at, text) without those that repeat one within the watermark."""
    return lines.withWatermark("at", late).dropDuplicatesWithinWatermark(["video_id", "text"])
