"""Timestamped text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What a transcript line and a caption cue look like.
LINE = r"^\[(\d\d):(\d\d):(\d\d)\]\s*(.*)"
CUE = r"(\d\d:\d\d:\d\d)\.\d\d\d --> "


def read_lines(spark: SparkSession, path: str, video: str = r"([^/]+)/[^/]*$") -> DataFrame:
    """(video_id, pos, line) of text files; video_id is what `video` captures in a file's path."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), video, 1).alias("video_id"), "value")
    return whole.select("video_id", F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))


def parse_transcript(lines: DataFrame, monotonic: bool = True, slack: int = 5) -> DataFrame:
    """(video_id, pos, t, text) of lines (video_id, pos, line) that look like `[HH:MM:SS] text`.

    With `monotonic` a video ends before the first line whose time is more than `slack` seconds before the line above:
    what follows is an appendix. Other lines do not count. One window per video.
    """
    part = lambda k: F.regexp_extract("line", LINE, k)
    parsed = lines.filter(F.col("line").rlike(LINE)).select("video_id", "pos", (part(1).cast("long") * 3600 + part(2).cast("long") * 60 + part(3).cast("long")).alias("t"), F.trim(part(4)).alias("text"))
    if not monotonic:
        return parsed
    order = Window.partitionBy("video_id").orderBy("pos")
    back = F.when(F.col("t") < F.lag("t").over(order) - slack, 1).otherwise(0)
    return parsed.withColumn("back", back).withColumn("backs", F.sum("back").over(order)).filter("backs = 0").drop("back", "backs")


def parse_vtt(files: DataFrame) -> DataFrame:
    """(video_id, pos, hms, line) of caption files (video_id, content), each text of a video once, at its first place.

    A block counts if it has a cue time with an hour; its first line is dropped, tags are stripped, blank lines go.
    """
    blocks = files.select("video_id", F.posexplode(F.split("content", r"\n\n+")).alias("block_no", "block"))
    cues = blocks.withColumn("hms", F.regexp_extract("block", CUE, 1)).filter("hms != ''")
    body = F.posexplode(F.slice(F.split("block", "\n"), F.lit(2), F.size(F.split("block", "\n")))).alias("k", "raw")
    lines = cues.select("video_id", "block_no", "hms", body).withColumn("line", F.trim(F.regexp_replace("raw", r"<[^>]+>", ""))).filter("line != ''")
    first = Window.partitionBy("video_id", "line").orderBy("block_no", "k")
    once = lines.withColumn("n", F.row_number().over(first)).filter("n = 1")
    return once.select("video_id", F.struct("block_no", "k").alias("pos"), "hms", "line")


def parse_segments(files: DataFrame) -> DataFrame:
    """(video_id, seq, start, end, text) of speech-to-text JSON (video_id, content): a list, or an object with `segments`."""
    segment = "array<struct<start: double, end: double, text: string>>"
    both = F.when(F.ltrim("content").startswith("["), F.from_json("content", segment)).otherwise(F.from_json("content", f"struct<segments: {segment}>")["segments"])
    return files.select("video_id", F.posexplode(both).alias("seq", "s")).select("video_id", F.col("seq").cast("long").alias("seq"), "s.start", "s.end", "s.text")


def bracket_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("line").startswith("["))
