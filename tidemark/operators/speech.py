"""Transcript operators: signals, digests, quality, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T

# Phrases that mark promotion, pointing at the screen, and a new section.
AD = [
    r"check (?:it |them )?out", r"link in the (?:description|bio)", r"like and subscribe",
    r"\bsubscribe\b", r"sign up", r"discount|coupon|promo code", r"\bsponsor", r"my course",
    r"full write[- ]?up", r"helped me go from", r"share with a friend", r"helps the channel",
]
POINTER = [
    r"as you can see", r"(?:you )?can see (?:here|that|this)", r"here we (?:have|see)",
    r"this (?:diagram|table|slide|chart|code|example|architecture)",
    r"looking at (?:the|this|our)", r"on the (?:screen|left|right|slide)", r"shown here",
    r"we'?ve got (?:our|a|the) [\w\s]{2,28} here", r"(?:this|that) (?:is|shows) (?:the|our)",
]
SECTION = [
    r"next up", r"let'?s (?:dive|jump|get|move) (?:in)?to", r"moving on", r"deep dive",
    r"so that'?s (?:the |our )?\w+ done", r"let'?s (?:start|begin) (?:with|off)",
    r"the (?:first|second|third|next|last) (?:part|thing|step|topic)",
    r"now (?:let'?s|we)", r"in this (?:section|part|video)", r"to summari[sz]e",
]


def hits(lines: DataFrame, patterns: list[str]) -> DataFrame:
    """Lines (video_id, seq, t, text) that any pattern matches, whatever the case."""
    return lines.filter(F.col("text").rlike(T.any_of(patterns)))


def merge_gaps(events: DataFrame, gap: int = 25, pad: int = 8) -> DataFrame:
    """(video_id, start, end): events (video_id, t) at most `gap` apart as one span, padded, never before 0."""
    order = Window.partitionBy("video_id").orderBy("t")
    new = F.when(F.col("t") - F.lag("t").over(order) <= gap, 0).otherwise(1)
    islands = events.select("video_id", "t").withColumn("new", new).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("video_id", "island").agg(F.greatest(F.lit(0).cast("long"), F.min("t") - pad).alias("start"), (F.max("t") + pad).alias("end")).drop("island")


def ad_spans(lines: DataFrame, gap: int = 25, pad: int = 8) -> DataFrame:
    return merge_gaps(hits(lines, AD), gap, pad)


def pointers(lines: DataFrame) -> DataFrame:
    return hits(lines, POINTER).select("video_id", "seq", "t", F.substring("text", 1, 90).alias("what"))


def section_hints(lines: DataFrame) -> DataFrame:
    return hits(lines, SECTION).select("video_id", "seq", "t", F.substring("text", 1, 60).alias("title"))


def digest_blocks(lines: DataFrame, every: int = 20) -> DataFrame:
    """(video_id, block_start, text): a new block where a line is `every` seconds past its block's start.

    The fold keeps the blocks' starts only; the texts are then joined by block.
    """
    ordered = lines.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("seq", "t", "text"))).alias("rows"))
    starts = F.aggregate(
        "rows",
        F.slice(F.transform("rows", lambda r: r["t"]), 1, 1),
        lambda a, r: F.when(r["t"] - F.element_at(a, -1) >= every, F.concat(a, F.array(r["t"]))).otherwise(a),
    )
    cut = ordered.withColumn("starts", starts).select("video_id", "starts", F.explode("rows").alias("r"))
    # the last start that is not after the line; equal starts cannot follow each other
    block = F.array_max(F.filter("starts", lambda s: s <= F.col("r.t")))
    blocks = cut.select("video_id", F.coalesce(block, F.element_at("starts", 1)).alias("block_start"), "r.seq", "r.text")
    return blocks.groupBy("video_id", "block_start").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("text"))


def validate_spans(spans: DataFrame, ends: DataFrame, slack: int = 30, longest: int = 180, share: float = 0.25) -> DataFrame:
    """(video_id, span_no, problem) for spans (video_id, span_no, start, end) against each video's last time (video_id, last_t).

    Span -1 stands for a video whose spans together (overlaps twice) cover more than `share` of it.
    """
    joined = spans.join(ends, "video_id", "left")
    kinds = F.array_compact(
        F.array(
            F.when(F.col("start").isNull() | F.col("end").isNull(), "missing"),
            F.when(F.col("end") < F.col("start"), "reversed"),
            F.when(F.col("end") > F.col("last_t") + slack, "past the end"),
            F.when(F.col("end") - F.col("start") > longest, "too long"),
        )
    )
    single = joined.select("video_id", F.col("span_no").cast("long").alias("span_no"), F.explode(kinds).alias("problem"))
    total = joined.groupBy("video_id").agg((F.sum(F.col("end") - F.col("start")) > F.max("last_t") * share).alias("much"))
    return single.union(total.filter("much").select("video_id", F.lit(-1).cast("long"), F.lit("covers too much")))


def hallucination(segments: DataFrame) -> DataFrame:
    """(video_id, seq, start, kind) of speech segments (video_id, seq, start, end, text) that look made up.

    REPEAT: the text of the segment before; else LOOP: over 15 characters and three times or more; RATE: over a second
    with more than six words a second; STALL: over eight seconds with fewer than three words.
    """
    order = Window.partitionBy("video_id").orderBy("seq")
    s = segments.withColumn("x", T.normal(F.col("text"))).withColumn("dur", F.col("end") - F.col("start")).withColumn("n", F.size(T.split_words(F.col("x"))))
    s = s.withColumn("before", F.lag("x").over(order)).withColumn("copies", F.when(F.length("x") > 15, F.count("*").over(Window.partitionBy("video_id", "x"))).otherwise(0))
    again = (F.col("x") != "") & F.coalesce(F.col("x") == F.col("before"), F.lit(False))
    wps = F.when(F.col("dur") > 0, F.col("n") / F.col("dur")).otherwise(0)
    kinds = F.array_compact(
        F.array(
            F.when(again, "REPEAT").when(F.col("copies") >= 3, "LOOP"),
            F.when((F.col("dur") > 1) & (wps > 6), "RATE"),
            F.when((F.col("dur") > 8) & (F.col("n") < 3), "STALL"),
        )
    )
    return s.select("video_id", "seq", "start", F.explode(kinds).alias("kind"))


def correction_audit(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(video_id, pos, kind, before, after) of line pairs (video_id, pos, line) that differ, matched by place.

    Kinds: `words` for another number of words (the whole lines), else `word` once per replaced word. Lines beyond the
    shorter file are not compared.
    """

    def numbered(df, name):
        rank = F.row_number().over(Window.partitionBy("video_id").orderBy("pos"))
        return df.select("video_id", rank.cast("long").alias("n"), F.col("line").alias(name))

    pairs = numbered(raw, "a").join(numbered(clean, "b"), ["video_id", "n"]).filter("a != b").withColumn("x", T.split_words(F.col("a"))).withColumn("y", T.split_words(F.col("b")))
    uneven = pairs.filter(F.size("x") != F.size("y")).select("video_id", "n", F.lit("words").alias("kind"), F.col("a").alias("before"), F.col("b").alias("after"))
    words = pairs.filter(F.size("x") == F.size("y")).select("video_id", "n", F.explode(F.arrays_zip("x", "y")).alias("w")).filter("w.x != w.y")
    return uneven.union(words.select("video_id", "n", F.lit("word"), "w.x", "w.y")).withColumnRenamed("n", "pos")


def unlogged(corrections: DataFrame, log: DataFrame) -> DataFrame:
    """Word corrections that no rule (before, after) of a correction log explains."""
    return corrections.filter("kind = 'word'").join(log.select("before", "after").distinct(), ["before", "after"], "left_anti")


def source_divergence(a: DataFrame, b: DataFrame, window: int = 30, min_len: int = 4) -> DataFrame:
    """(video_id, bucket, only_a, only_b): tokens that one of two transcripts (video_id, t, text) has in a time window and the other lacks."""

    def bags(df, name):
        tokens = df.select("video_id", F.floor(F.col("t") / window).cast("long").alias("bucket"), F.explode(T.plain_tokens(F.col("text"))).alias("w"))
        return tokens.groupBy("video_id", "bucket").agg(F.collect_set(F.when(F.length("w") >= min_len, F.col("w"))).alias(name))

    none = F.array().cast("array<string>")
    both = bags(a, "a").join(bags(b, "b"), ["video_id", "bucket"], "full").withColumn("a", F.coalesce("a", none)).withColumn("b", F.coalesce("b", none))
    out = both.select("video_id", "bucket", F.array_sort(F.array_except("a", "b")).alias("only_a"), F.array_sort(F.array_except("b", "a")).alias("only_b"))
    return out.filter("size(only_a) + size(only_b) > 0")


def visual_only(screen: DataFrame, lines: DataFrame, min_len: int = 4) -> DataFrame:
    """(video_id, frame, pos, term): terms of on-screen text (video_id, frame, text) that the speech never has, in order, once a frame."""
    terms = screen.select("video_id", "frame", F.posexplode(F.array_distinct(T.screen_terms(F.col("text")))).alias("pos", "term")).filter(F.length("term") >= min_len)
    spoken = lines.select("video_id", F.explode(T.screen_terms(F.col("text"))).alias("term")).distinct()
    return terms.join(spoken, ["video_id", "term"], "left_anti").select("video_id", "frame", F.col("pos").cast("long").alias("pos"), "term")


def merge_ocr(first: DataFrame, second: DataFrame) -> DataFrame:
    """Regions (video_id, frame, seq, text, conf) of the first pass, and those of the second whose text is new, once each."""
    key = F.lower(F.trim("text"))
    order = Window.partitionBy("video_id", "frame", "key").orderBy("seq")
    second = second.withColumn("key", key).withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")
    new = second.join(first.select("video_id", "frame", key.alias("key")).distinct(), ["video_id", "frame", "key"], "left_anti").drop("key")
    return first.withColumn("pass", F.lit(1)).unionByName(new.withColumn("pass", F.lit(2)))


def mean_confidence(regions: DataFrame) -> DataFrame:
    return regions.groupBy("video_id", "frame").agg(F.avg("conf").alias("conf"), F.count("*").alias("regions"))


def uncertain_terms(lines: DataFrame) -> DataFrame:
    """(video_id, t, term) of markers `[Unclear term: possibly "..."]`."""
    return lines.select("video_id", "t", F.explode(F.regexp_extract_all("text", F.lit(r'\[Unclear term: possibly "([^"]*)"\]'), F.lit(1))).alias("term"))
