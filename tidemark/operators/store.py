"""Profiles, artifacts, reports and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import hms, human_bytes

KEEP_IF_EMPTY = ("params", "glossary", "note")


def upsert(profiles: DataFrame, updates: DataFrame, key: str = "channel_id") -> DataFrame:
    """Profiles with updates (at most one a key) merged: a value that is not null replaces, `params`, `glossary` and `note`
    only if not empty; videos_seen counts one more for each updated key. Columns are those of profiles."""
    fields = [c for c in profiles.columns if c not in (key, "videos_seen")]
    new = updates.select(key, F.lit(1).alias("_seen"), *[F.col(c).alias(f"_{c}") for c in fields if c in updates.columns])

    def merged(c):
        if c not in updates.columns:
            return F.col(c)
        v = F.nullif(F.col(f"_{c}"), F.lit("")) if c in KEEP_IF_EMPTY else F.col(f"_{c}")
        return F.coalesce(v, F.col(c)).alias(c)

    seen = (F.coalesce("videos_seen", F.lit(0)) + F.coalesce("_seen", F.lit(0))).cast("long").alias("videos_seen")
    out = profiles.join(new, key, "full").select(key, *[merged(c) for c in fields], seen)
    return out.select(*profiles.columns)


def lookup(ids: DataFrame, profiles: DataFrame, key: str = "channel_id") -> DataFrame:
    return ids.join(profiles.withColumn("_k", F.lit(True)), key, "left").withColumn("is_known", F.coalesce("_k", F.lit(False))).drop("_k")


def inventory(artifacts: DataFrame) -> DataFrame:
    """(project, dir, files, bytes, size) of artifacts (project, dir, file, bytes)."""
    return artifacts.groupBy("project", "dir").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).withColumn("size", human_bytes(F.col("bytes")))


def cleanup_guard(artifacts: DataFrame, notes: DataFrame, frames_dir: str = "frames") -> DataFrame:
    """(project, frames, referenced, may_delete_frames, may_delete_audio) of projects.

    Raw frames may go if selected pictures (*.png in `frames_dir`) exist and the notes (project, text), if any, name one
    of them; audio only beside a transcript.
    """
    shot = artifacts.filter((F.col("dir") == frames_dir) & F.col("file").endswith(".png"))
    named = shot.join(notes.select("project", "text"), "project").filter(F.contains("text", "file")).groupBy("project").agg(F.countDistinct("file").alias("referenced"))
    have = artifacts.groupBy("project").agg(F.count_if((F.col("dir") == frames_dir) & F.col("file").endswith(".png")).alias("frames"), F.max(F.col("dir") == "transcript").alias("transcript"))
    texts = notes.select("project").distinct().withColumn("noted", F.lit(True))
    out = have.join(named, "project", "left").join(texts, "project", "left").withColumn("referenced", F.coalesce("referenced", F.lit(0).cast("long")))
    ok = (F.col("frames") > 0) & (F.col("noted").isNull() | (F.col("referenced") > 0))
    return out.select("project", "frames", "referenced", ok.alias("may_delete_frames"), F.col("transcript").alias("may_delete_audio"))


def regeneration_note(artifacts: DataFrame, removed: tuple[str, ...] = ("frames", "audio")) -> DataFrame:
    """(project, note): what a cleanup took from a project and what would have to run again to have it back."""
    gone = inventory(artifacts.filter(F.col("dir").isin(*removed)))
    line = F.concat(F.lit("- "), "dir", F.lit(": "), F.col("files").cast("string"), F.lit(" files, "), "size")
    return gone.groupBy("project").agg(F.concat(F.lit("Removed, can be made again from the recording:\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("note"))


def status_report(candidates: DataFrame, deduped: DataFrame, used: DataFrame) -> DataFrame:
    """(video_id, candidates, deduped, used, budget): frame counts per video; budget warns outside 10 to 40 used frames."""
    n = lambda df, name: df.groupBy("video_id").agg(F.count("*").alias(name))
    out = n(candidates, "candidates").join(n(deduped, "deduped"), "video_id", "left").join(n(used, "used"), "video_id", "left").na.fill(0)
    return out.withColumn("budget", F.when(F.col("used") < 10, "few").when(F.col("used") > 40, "many").otherwise("ok"))


def gate_status(verdicts: DataFrame) -> DataFrame:
    """One row: checked, failed, exit_code (0 ok, 1 failed, 2 nothing checked)."""
    out = verdicts.agg(F.count("*").alias("checked"), F.count_if(~F.col("ok")).alias("failed"))
    return out.withColumn("exit_code", F.when(F.col("checked") == 0, 2).when(F.col("failed") > 0, 1).otherwise(0))


def transcript_text(lines: DataFrame) -> DataFrame:
    """(video_id, seq, value): `[HH:MM:SS] text` lines."""
    return lines.select("video_id", "seq", F.concat(F.lit("["), hms(F.col("t")), F.lit("] "), "text").alias("value"))


def write_transcripts(lines: DataFrame, path: str) -> None:
    """A folder per video with its lines in order."""
    out = transcript_text(lines)
    out.repartition("video_id").sortWithinPartitions("video_id", "seq").select("video_id", "value").write.partitionBy("video_id").text(path)


def json_manifest(rows: DataFrame, order: str, key: str = "video_id") -> DataFrame:
    """(key, json): one JSON array per video, its rows in order."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*rest).alias("r")))), lambda x: x["r"])).alias("json"))
