"""Signals, span literals, frame names, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = "array<struct<start: bigint, end: bigint, reason: string, confidence: string>>"
SCHEMA = f"struct<ad_spans: {_SPAN}, ad_candidates: {_SPAN}, visual_pointers: array<struct<t: bigint, what: string>>, sections: array<struct<t: bigint, title: string>>, uncertain: array<double>>"


def parse_signals(files: DataFrame) -> DataFrame:
    """(video_id, ad_spans, visual_pointers, sections, uncertain) of JSON (video_id, content); what is missing is an empty array.

    Without ad_spans, or with an empty one, ad_candidates count.
    """
    s = F.from_json("content", SCHEMA)
    spans = F.when(F.size(F.coalesce(s["ad_spans"], F.array().cast(_SPAN))) > 0, s["ad_spans"]).otherwise(F.coalesce(s["ad_candidates"], F.array().cast(_SPAN)))
    empty = lambda name, kind: F.coalesce(s[name], F.array().cast(kind)).alias(name)
    return files.select("video_id", spans.alias("ad_spans"), empty("visual_pointers", "array<struct<t: bigint, what: string>>"), empty("sections", "array<struct<t: bigint, title: string>>"), empty("uncertain", "array<double>"))


def clock_seconds(s: Column) -> Column:
    """Seconds of MM:SS or HH:MM:SS."""
    return F.aggregate(F.transform(F.split(F.trim(s), ":"), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a * 60 + x)


def parse_spans(literal: Column) -> Column:
    """Array of (start, end) from `MM:SS-MM:SS,HH:MM:SS-HH:MM:SS`."""
    parts = F.filter(F.split(literal, ","), lambda p: F.trim(p) != "")
    return F.transform(parts, lambda p: F.struct(clock_seconds(F.element_at(F.split(p, "-"), 1)).alias("start"), clock_seconds(F.element_at(F.split(p, "-"), 2)).alias("end")))


def seconds_list(csv: Column) -> Column:
    return F.transform(F.filter(F.split(csv, ","), lambda p: F.trim(p) != ""), lambda p: F.trim(p).cast("double"))


def frame_index(path: Column) -> Column:
    """All digits of a file's name as one number."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\D", "").cast("long")


def frame_time(idx: Column, interval: float = 2.0) -> Column:
    return F.floor((idx - 1) * interval).cast("long")


def named_time(name: Column) -> Column:
    """Seconds from a selected frame's name: HH-MM-SS-..., else MM-SS-..., else null."""
    part = lambda p, k: F.regexp_extract(name, p, k).cast("long")
    three, two = r"^(\d{2})-(\d{2})-(\d{2})-", r"^(\d{2})-(\d{2})-"
    return F.when(name.rlike(three), part(three, 1) * 3600 + part(three, 2) * 60 + part(three, 3)).when(name.rlike(two), part(two, 1) * 60 + part(two, 2))


def overlay(seed: DataFrame, user: DataFrame, key: str = "channel_id") -> DataFrame:
    """Profiles of both; where both have a key, the user's whole record counts."""
    rest = [c for c in seed.columns if c != key]
    a, b = seed.select(key, F.struct(*rest).alias("a")), user.select(key, F.struct(*rest).alias("b"))
    return a.join(b, key, "full").select(key, F.coalesce("b", "a").alias("r")).select(key, "r.*")
