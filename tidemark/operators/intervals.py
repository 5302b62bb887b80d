"""Joins of points and spans in time, as equi-joins on time buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _bucket(t: Column, width: float) -> Column:
    return F.floor(t / F.lit(float(width))).cast("long")


def near(points: DataFrame, others: DataFrame, width: float, t: str = "t", s: str = "s", key: str = "video_id") -> DataFrame:
    """Pairs of points (key, t, ...) and others (key, s, ...) with |t - s| <= width; column names must differ but for the key.

    Each of the others goes to its own bucket and the two beside it, so a pair meets once and the join is an equi-join.
    """
    w = max(float(width), 1e-9)
    at = points.withColumn("_b", _bucket(F.col(t), w))
    spread = others.withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: _bucket(F.col(s), w) + k)))
    return at.join(spread, [key, "_b"]).filter(F.abs(F.col(t) - F.col(s)) <= width).drop("_b")


def inside(points: DataFrame, spans: DataFrame, how: str = "left_semi", t: str = "t", key: str = "video_id", width: int = 60) -> DataFrame:
    """Points inside (left_semi) or outside (left_anti) every span (key, start, end), both ends included."""
    cover = spans.filter("end >= start").select(F.col(key).alias("_k"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.explode(F.sequence(_bucket(F.col("start"), width), _bucket(F.col("end"), width))).alias("_b"))
    return points.join(cover, (F.col(key) == F.col("_k")) & (_bucket(F.col(t), width) == F.col("_b")) & F.col(t).between(F.col("_s"), F.col("_e")), how)


def exclude(points: DataFrame, spans: DataFrame) -> DataFrame:
    return inside(points, spans, "left_anti")


def flag_near(points: DataFrame, marks: DataFrame, name: str, width: float = 12, id: str = "idx") -> DataFrame:
    """points with a boolean: is a mark (video_id, s) within `width`?"""
    hit = near(points.select("video_id", id, "t"), marks.select("video_id", "s"), width).select("video_id", id).distinct().withColumn(name, F.lit(True))
    return points.join(hit, ["video_id", id], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def pointer_holes(marks: DataFrame, kept: DataFrame, spans: DataFrame, width: float = 12) -> DataFrame:
    """Pointers (video_id, seq, t) outside the spans that no kept frame (video_id, t) is near."""
    met = near(marks, kept.select("video_id", F.col("t").alias("s")), width).select("video_id", "seq").distinct()
    return inside(marks.join(met, ["video_id", "seq"], "left_anti"), spans, "left_anti")


def said_at(frames: DataFrame, lines: DataFrame, width: int = 25, chars: int = 420) -> DataFrame:
    """(video_id, idx, said): the speech within `width` seconds of a frame, in order, the first `chars` characters; null without any."""
    pairs = near(frames.select("video_id", "idx", "t"), lines.select("video_id", "seq", F.col("t").alias("s"), "text"), width)
    said = pairs.groupBy("video_id", "idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("said"))
    return frames.select("video_id", "idx").join(said, ["video_id", "idx"], "left").withColumn("said", F.substring("said", 1, chars))


def nearest_line(frames: DataFrame, lines: DataFrame) -> DataFrame:
    """(video_id, idx, seq, gap): the line nearest to each frame in time, the earlier of two; a merge of both timelines.

    Looks back and ahead by window instead of comparing all lines with all frames.
    """
    both = lines.select("video_id", "t", F.lit(0).alias("kind"), "seq", F.lit(None).cast("long").alias("idx")).union(frames.select("video_id", "t", F.lit(1), F.lit(None).cast("long"), "idx"))
    line = F.when(F.col("kind") == 0, F.struct("t", "seq"))
    # lines stand before frames of the same time; of lines of one time the first counts
    first = Window.partitionBy("video_id", "t", "kind").orderBy("seq")
    both = both.withColumn("line", F.when(F.row_number().over(first) == 1, line))
    back = Window.partitionBy("video_id").orderBy("t", "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("video_id").orderBy("t", "kind", "seq").rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("a", F.last("line", True).over(back)).withColumn("b", F.first("line", True).over(ahead)).filter("kind = 1")
    ga, gb = F.col("t") - F.col("a.t"), F.col("b.t") - F.col("t")
    use_b = F.col("a").isNull() | (F.col("b").isNotNull() & ((gb < ga) | ((gb == ga) & (F.col("b.seq") < F.col("a.seq")))))
    return found.select("video_id", "idx", F.when(use_b, F.col("b.seq")).otherwise(F.col("a.seq")).alias("seq"), F.when(use_b, gb).otherwise(ga).alias("gap"))


def frame_manifest(frames: DataFrame, lines: DataFrame, width: int = 25) -> DataFrame:
    """(video_id, markdown): one document per video, a heading and the speech around each frame (video_id, idx, t, name)."""
    from tidemark.functions.text import ms

    said = frames.join(said_at(frames, lines, width), ["video_id", "idx"]).select("video_id", "idx", F.concat(F.lit("## "), ms(F.col("t")), F.lit(" - "), "name", F.lit("\n\n"), F.coalesce("said", F.lit("(nothing said)"))).alias("entry"))
    return said.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "entry"))), lambda x: x["entry"]), "\n\n").alias("markdown"))
