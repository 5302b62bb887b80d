"""Frame selection from distances and signals, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import frames as fr
from tidemark.operators import intervals as iv


def select_frames(frames: DataFrame, pointers: DataFrame, uncertain: DataFrame, spans: DataFrame, cut: int | None = 60, settle: int = 4, cluster: int | None = None, **how) -> dict[str, DataFrame]:
    """`kept` and `holes` of frames (video_id, idx, t, p, d, ink), pointers (video_id, seq, t), uncertain (video_id, t), spans.

    Pointers protect candidates from clustering; spans are left out after it, by the first member's time. cut=None takes
    each video's own thresholds, for the cut, for settling and, unless `cluster` is given, for clusters (else 26).
    """
    own = fr.neighbor_distance(frames)
    near = cluster or 26
    if cut is None:
        # scaling a video's distances to the common thresholds keeps one plan for all videos
        cal = fr.calibrate(own)
        own = own.join(cal.select("video_id", F.col("cut").alias("_c"), F.col("settle").alias("_s")), "video_id")
        own = own.withColumn("nb", F.when(F.col("nb") >= F.col("_c"), 60).when(F.col("nb") <= F.col("_s"), 0).otherwise(30)).drop("_c", "_s")
        cut, settle, near = 60, 4, cluster or "cluster"
    picked = fr.candidates(own, cut, settle, **how)
    marks = lambda df: df.select("video_id", F.col("t").alias("s"))
    flagged = iv.flag_near(iv.flag_near(picked, marks(pointers), "protected"), marks(uncertain), "uncertain")
    hashed = flagged.join(frames.select("video_id", "idx", "p", "d"), ["video_id", "idx"])
    if near == "cluster":
        hashed = hashed.join(cal.select("video_id", "cluster"), "video_id")
    kept = iv.exclude(fr.leader_clusters(hashed, near), spans)
    return {"kept": kept, "holes": iv.pointer_holes(pointers, kept, spans)}
