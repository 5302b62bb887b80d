"""Gates for written notes: numbers, quotes, sections, links, voice. Notes are lines (doc_id, line_no, raw), from 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T

# Labels of blocks that quote other sources, wanted and retired sections.
EXTERNAL = [
    "External clarification", "Further context", "Verification note", "External check",
    "Interview insight", "Interview trap", "Error, corrected in place", "Incomplete as listed",
]
REQUIRED = ["Key takeaways", "Things worth revisiting", "External references"]
RETIRED = ["Transcription uncertainties", "Visual uncertainties"]
# What the voice lint matches, by label.
BANNED = {
    "accessibility-caption heading": r"###+\s*What the diagram shows",
    "production/stage vocabulary": r"\b(canvas|webcam|title[- ]card|slide deck scrolls?|the canvas scrolls?)\b",
    "stage direction": r"\b(he|she|they)\s+(draws?|writes?|sketches?|circles?|underlines?|erases?)\b",
    "narration of the recording": r"\b(the (video|recording|lecture) (then|now|continues|cuts))\b",
    "production metadata": r"\b(Whisper|auto[- ]captions?|hallucination audit|transcription (audit|log)|ffmpeg|yt-dlp|1080p|contact sheets?)\b",
    "three-layer preamble": r"^#+\s*How to read these notes",
    "transcription-uncertainty section": r"^#+\s*Transcription uncertainties",
    "colour/shape description": r"\b(a|an|the)\s+(white|red|green|blue|yellow|black)\s+(rectangle|circle|box|line|arrow|dot|curve)\b",
    "frame-layout description": r"\b(top|bottom)[- ](left|right)\b.{0,30}\b(inset|corner|of the (frame|screen))\b",
    "reproduction narration": r"\b(exactly )?as drawn\b|\breproduced (exactly|as)\b|\bon screen (this|it|the)\b",
    "ink-colour description": r"\bink colou?rs?\b|\b(colou?r|shade) of the (ink|pen|marker)\b",
    "frame reference in prose": r"\bfollows the frame at\b|\bthe frame (shows|at)\b|\bin the frame\b",
}
# An inline timestamp, emphasis marks, the mark of a block that quotes others, a number that stands alone.
STAMP = r"\(?\b\d{1,2}:\d{2}(?::\d{2})?\b\)?"
EMPHASIS = r"(\*{1,3}|_{1,3}|`)"
MARKER = r"(?i)\*\*(" + "|".join(EXTERNAL) + r")\b"
ALONE = r"(?<![\w.])(\d[\d,]*\.?\d*)(?![\w])"


def note_lines(files: DataFrame) -> DataFrame:
    """(doc_id, line_no, raw) of notes (doc_id, content)."""
    return files.select("doc_id", F.posexplode(F.split("content", "\n")).alias("k", "raw")).select("doc_id", (F.col("k") + 1).cast("long").alias("line_no"), "raw")


def _doc():
    return Window.partitionBy("doc_id").orderBy("line_no")


def _fenced(lines: DataFrame, start: Column) -> DataFrame:
    """Adds fence (the line opens or closes code) and code (it is inside)."""
    so_far = F.sum(F.when(start, 1).otherwise(0)).over(_doc())
    return lines.withColumn("fence", start).withColumn("code", (so_far % 2 == 1) & ~start)


def numeric_provenance(notes: DataFrame, supported: DataFrame, visual: DataFrame | None = None, visual_unverifiable: bool = False) -> DataFrame:
    """(doc_id, line_no, number, severity): numbers that neither the speech (doc_id, text) nor on-screen text has.

    Not looked at: code, headings, the section External references, and blockquotes from a marked line on. A blockquote
    ends at a line that is neither quote, heading nor code. Single digits and 10 pass. Without on-screen text, or if it
    cannot be trusted, a number needs an eye, else it is a problem.
    """
    s = F.trim(F.col("raw"))
    lines = _fenced(notes, F.startswith(s, F.lit("```"))).withColumn("s", s)
    lines = lines.withColumn("heading", F.col("s").rlike(r"^#+\s") & ~F.col("fence") & ~F.col("code"))
    refs = F.last(F.when(F.col("heading"), F.col("s").rlike("(?i)External references")), True).over(_doc())
    lines = lines.withColumn("refs", F.coalesce(refs, F.lit(False)))
    free = ~F.col("fence") & ~F.col("code") & ~F.col("heading") & ~F.col("refs")
    lines = lines.withColumn("quote", free & F.startswith("s", F.lit(">"))).withColumn("block", F.sum(F.when(free & ~F.col("quote"), 1).otherwise(0)).over(_doc()))
    marked = F.max(F.when(F.col("quote") & F.col("s").rlike(MARKER), 1).otherwise(0)).over(Window.partitionBy("doc_id", "block").orderBy("line_no"))
    lines = lines.withColumn("exempt", F.col("quote") & (marked == 1)).filter(free & ~F.col("exempt"))
    found = lines.select("doc_id", "line_no", F.explode(F.regexp_extract_all(T.scrub(F.col("raw")), F.lit(ALONE), F.lit(1))).alias("raw_number"))
    found = found.withColumn("number", F.rtrim(F.regexp_replace("raw_number", ",", ""), F.lit("."))).filter((F.length("number") >= 2) & (F.col("number") != "10"))
    texts = supported.select("doc_id", "text") if visual is None else supported.select("doc_id", "text").union(visual.select("doc_id", "text"))
    known = texts.select("doc_id", F.explode(T.numbers(F.col("text"))).alias("number")).distinct()
    severity = F.lit("needs_eye" if visual is None or visual_unverifiable else "problem")
    return found.join(known, ["doc_id", "number"], "left_anti").select("doc_id", "line_no", "number", severity.alias("severity"))


# Fixed value: a quotation that a line claims someone said.
QUOTE = r'(?im)(?:^>|lecturer|states?|says?)[^\n]*?"([^"\n]{30,200})"'


def quotes(notes: DataFrame, speech: DataFrame) -> DataFrame:
    """(doc_id, line_no, quote): quotes of six words and more whose first six the speech (doc_id, text: all of it) does not have.

    Lines of a marked blockquote, up to the next empty line, are exempt.
    """
    empty = F.sum(F.when(F.trim("raw") == "", 1).otherwise(0)).over(_doc())
    marked = F.max(F.when(F.col("raw").rlike("^>") & F.col("raw").rlike(MARKER), 1).otherwise(0)).over(Window.partitionBy("doc_id", "para").orderBy("line_no"))
    lines = notes.withColumn("para", empty).withColumn("ext", marked).filter("ext = 0")
    found = lines.select("doc_id", "line_no", F.explode(F.regexp_extract_all("raw", F.lit(QUOTE), F.lit(1))).alias("quote"))
    words = T.split_words(T.flat(F.col("quote")))
    found = found.withColumn("words", F.filter(words, lambda w: w != "")).filter(F.size("words") >= 6).withColumn("start", F.array_join(F.slice("words", 1, 6), " "))
    spoken = speech.select("doc_id", T.flat(F.regexp_replace("text", r"\[\d\d:\d\d:\d\d\]", " ")).alias("flat"))
    joined = found.join(spoken, "doc_id", "left")
    return joined.filter(~F.coalesce(F.contains("flat", "start"), F.lit(False))).select("doc_id", "line_no", "quote")


def sections(notes: DataFrame) -> DataFrame:
    """(doc_id, kind, section): `missing` required ones (a problem) and `retired` ones that are there (a warning)."""
    has = lambda name: F.max(F.when(F.col("raw").rlike(rf"(?i)^#+\s*{name}"), 1).otherwise(0))
    per = notes.groupBy("doc_id").agg(*[has(n).alias(f"r{k}") for k, n in enumerate(REQUIRED)], *[has(n).alias(f"o{k}") for k, n in enumerate(RETIRED)])
    cases = [F.when(F.col(f"r{k}") == 0, F.struct(F.lit("missing").alias("kind"), F.lit(n).alias("section"))) for k, n in enumerate(REQUIRED)]
    cases += [F.when(F.col(f"o{k}") == 1, F.struct(F.lit("retired").alias("kind"), F.lit(n).alias("section"))) for k, n in enumerate(RETIRED)]
    return per.select("doc_id", F.explode(F.array_compact(F.array(*cases))).alias("c")).select("doc_id", "c.kind", "c.section")


def links(notes: DataFrame) -> DataFrame:
    """(doc_id, line_no, target) of links to local files, without their fragment's anchor-only form."""
    found = notes.select("doc_id", "line_no", F.explode(F.regexp_extract_all("raw", F.lit(r"\]\((?!https?:)([^)#]+)\)"), F.lit(1))).alias("target"))
    return found.withColumn("target", F.trim("target"))


def broken_links(notes: DataFrame, files: DataFrame) -> DataFrame:
    """Links whose target is not among files (doc_id, target)."""
    return links(notes).join(files.select("doc_id", "target").distinct(), ["doc_id", "target"], "left_anti").select("doc_id", "line_no", "target")


def orphans(notes: DataFrame, files: DataFrame) -> DataFrame:
    """Files (doc_id, target) that no link of their notes names."""
    return files.select("doc_id", "target").distinct().join(links(notes).select("doc_id", "target").distinct(), ["doc_id", "target"], "left_anti")


def verdict(docs: DataFrame, problems: DataFrame, warnings: DataFrame, needs_eye: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_id, problems, warnings, needs_eye, ok); strict fails on any of the three."""
    n = lambda df, name: df.groupBy("doc_id").agg(F.count("*").alias(name))
    out = docs.select("doc_id").distinct()
    for df, name in ((problems, "problems"), (warnings, "warnings"), (needs_eye, "needs_eye")):
        out = out.join(n(df, name), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    bad = F.col("problems") > 0
    return out.withColumn("ok", ~(bad | (F.col("warnings") > 0) | (F.col("needs_eye") > 0) if strict else bad))


def voice_lint(notes: DataFrame) -> DataFrame:
    """(doc_id, line_no, label, text): each banned pattern once a line, with or without emphasis marks, never in code.

    `inline timestamp`: outside headings, table rows and lines that only blank ones part from a heading.
    """
    left = F.regexp_replace("raw", r"^\s+", "")
    lines = _fenced(notes, F.startswith(left, F.lit("```"))).filter(~F.col("fence") & ~F.col("code")).withColumn("left", F.regexp_replace("raw", r"^\s+", "")).withColumn("probe", F.regexp_replace("raw", EMPHASIS, ""))
    lines = lines.withColumn("heading", F.startswith("left", F.lit("#")))
    before = F.last(F.when(F.trim("left") != "", F.col("heading")), True).over(_doc().rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("under", F.coalesce(before, F.lit(False)))
    found = [F.when(F.col("raw").rlike(f"(?i){p}") | F.col("probe").rlike(f"(?i){p}"), label) for label, p in BANNED.items()]
    found.append(F.when(~F.col("heading") & ~F.col("under") & ~F.startswith("left", F.lit("|")) & F.col("raw").rlike(STAMP), "inline timestamp"))
    return lines.select("doc_id", "line_no", F.explode(F.array_compact(F.array(*found))).alias("label"), F.substring(F.trim("raw"), 1, 90).alias("text"))


def lint_by_label(hits: DataFrame) -> DataFrame:
    return hits.groupBy("label").agg(F.count("*").alias("hits"), F.countDistinct("doc_id").alias("docs")).orderBy(F.desc("hits"), "label")


def takeaways(notes: DataFrame) -> DataFrame:
    """(doc_id, n, ok): list items under the heading Key takeaways; 5 to 8 are wanted."""
    head = F.last(F.when(F.col("raw").rlike(r"^#+\s"), F.col("raw").rlike(r"(?i)^#+\s*Key takeaways")), True).over(_doc())
    n = F.count_if(F.col("on") & F.col("raw").rlike(r"^\s*([-*+]|\d+\.)\s"))
    return notes.withColumn("on", F.coalesce(head, F.lit(False))).groupBy("doc_id").agg(n.alias("n")).withColumn("ok", F.col("n").between(5, 8))
