"""Queries of the readers, small functions and gates, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import frames as fr
from tidemark.operators import notes as nt
from tidemark.operators import speech as sp
from tidemark.operators import store as st
from tidemark.plans.registry import SQL, query
from tidemark.sources import signals, transcripts


def _list(order: str, *columns) -> F.Column:
    """A group's rows as an array of structs of the columns, by `order`."""
    rest = F.struct(*columns).alias("r")
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), rest))), lambda x: x["r"])


@query("SELECT video_id, pos, line FROM mixed_lines WHERE starts_with(line, '[')")
def bracket_lines(x):
    return transcripts.bracket_lines(x("mixed_lines"))


@query("""SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY seq) - 1 AS BIGINT) AS seq, start, stop AS "end", text FROM segments""")
def asr_segments(x):
    """Files in both forms, a list and an object."""
    files = x("segments").groupBy("video_id").agg(F.to_json(_list("seq", "start", F.col("stop").alias("end"), "text")).alias("j"))
    content = F.when(F.col("video_id") % 2 == 1, F.concat(F.lit('{"segments": '), "j", F.lit("}"))).otherwise(F.col("j"))
    return transcripts.parse_segments(files.select("video_id", content.alias("content")))


@query("""SELECT video_id, start, stop AS "end", concat('r', span_no) AS reason FROM spans""")
def signal_spans(x):
    """Some files name their spans, others only candidates."""
    span = F.struct("start", F.col("stop").alias("end"), F.concat(F.lit("r"), "span_no").alias("reason"))
    files = x("spans").groupBy("video_id").agg(F.to_json(F.collect_list(span)).alias("j"))
    content = F.when(F.col("video_id") % 2 == 1, F.concat(F.lit('{"ad_spans": [], "ad_candidates": '), "j", F.lit("}"))).otherwise(F.concat(F.lit('{"ad_spans": '), "j", F.lit(', "uncertain": [1.5]}')))
    parsed = signals.parse_signals(files.select("video_id", content.alias("content")))
    return parsed.select("video_id", F.explode("ad_spans").alias("s")).select("video_id", "s.start", "s.end", "s.reason")


@query("SELECT video_id, path, idx + 1 AS idx, CAST(floor(idx * 2.0) AS BIGINT) AS t FROM paths")
def frame_paths(x):
    idx = signals.frame_index(F.col("path"))
    return x("paths").select("video_id", "path", idx.alias("idx"), signals.frame_time(idx).alias("t"))


@query("SELECT video_id, name, t, concat(lpad(concat('', CAST(floor(t / 3600) AS BIGINT)), 2, '0'), '-', lpad(concat('', CAST(floor(t % 3600 / 60) AS BIGINT)), 2, '0'), '-', lpad(concat('', t % 60), 2, '0'), '-slide-', idx, '-png') AS slug FROM paths")
def frame_names(x):
    return x("paths").select("video_id", "name", signals.named_time(F.col("name")).alias("t"), T.slug(F.col("name")).alias("slug"))


_CLOCK = "concat(CAST(floor({0} / 60) AS BIGINT), ':', lpad(concat('', {0} % 60), 2, '0'))"


@query("""SELECT video_id, start, greatest(stop, 0) AS "end" FROM spans""")
def span_literals(x):
    """Each video's spans as one literal, read again."""
    clock = lambda c: F.concat(F.floor(F.expr(c) / 60).cast("string"), F.lit(":"), T.two(F.expr(c) % 60))
    literal = x("spans").groupBy("video_id").agg(F.array_join(F.collect_list(F.concat(clock("start"), F.lit("-"), clock("greatest(stop, 0)"))), ", ").alias("literal"))
    return literal.select("video_id", F.explode(signals.parse_spans(F.col("literal"))).alias("s")).select("video_id", "s.start", "s.end")


@query("SELECT video_id, unnest([CAST(last_t AS DOUBLE), last_t / 2.0, 7.25]) AS second FROM ends")
def seconds(x):
    csv = F.concat("last_t", F.lit(", "), (F.col("last_t") / 2).cast("string"), F.lit(",, 7.25"))
    return x("ends").select("video_id", F.explode(signals.seconds_list(csv)).alias("second"))


@query("""SELECT video_id, concat('[', string_agg(concat('{"idx":', idx, ',"t":', t, '}'), ',' ORDER BY idx), ']') AS json FROM frames GROUP BY video_id""")
def json_manifest(x):
    return st.json_manifest(x("frames").select("video_id", "idx", "t"), "idx")


_GATES = f"""sec AS ({SQL['note_sections']}), num AS ({SQL['numeric_provenance']}), quo AS ({SQL['quote_verbatim']}),
v AS (SELECT doc_id, (SELECT count(*) FROM sec s WHERE s.doc_id = n.doc_id AND kind = 'missing') AS problems, (SELECT count(*) FROM sec s WHERE s.doc_id = n.doc_id AND kind = 'retired') + (SELECT count(*) FROM quo q WHERE q.doc_id = n.doc_id) AS warnings,
  (SELECT count(*) FROM num m WHERE m.doc_id = n.doc_id) AS needs_eye FROM (SELECT DISTINCT doc_id FROM notes) n)"""


def _verdict(x, strict: bool):
    found = nt.sections(x("notes"))
    warnings = found.filter("kind = 'retired'").select("doc_id").union(nt.quotes(x("notes"), x("speech")).select("doc_id"))
    return nt.verdict(x("notes"), found.filter("kind = 'missing'"), warnings, nt.numeric_provenance(x("notes"), x("speech")), strict)


@query(f"WITH {_GATES} SELECT *, problems = 0 AND warnings = 0 AND needs_eye = 0 AS ok FROM v")
def note_verdict(x):
    return _verdict(x, True)


@query(f"WITH {_GATES} SELECT count(*) AS checked, count(*) FILTER (problems > 0) AS failed, CASE WHEN count(*) = 0 THEN 2 WHEN count(*) FILTER (problems > 0) > 0 THEN 1 ELSE 0 END AS exit_code FROM v")
def gate_status(x):
    return st.gate_status(_verdict(x, False))


@query(SQL["numeric_provenance"].replace("FROM speech)", "FROM (SELECT doc_id, text FROM speech UNION ALL SELECT doc_id, concat('12,345 of ', doc_id, ' and 42') FROM speech) u)").replace("'needs_eye'", "'problem'"))
def numeric_with_screen(x):
    """On-screen text supports numbers as speech does."""
    visual = x("speech").select("doc_id", F.concat(F.lit("12,345 of "), "doc_id", F.lit(" and 42")).alias("text"))
    return nt.numeric_provenance(x("notes"), x("speech"), visual)


@query(r"""WITH l AS (SELECT doc_id, trim(unnest(regexp_extract_all(raw, '\]\(([^)#]+)\)', 1))) AS target FROM notes),
f AS (SELECT DISTINCT doc_id, unnest(['frames/a.png', concat('frames/', doc_id, '.png')]) AS target FROM notes)
SELECT doc_id, target FROM f ANTI JOIN l USING (doc_id, target)""")
def orphan_files(x):
    files = x("notes").select("doc_id", F.explode(F.array(F.lit("frames/a.png"), F.concat(F.lit("frames/"), "doc_id", F.lit(".png")))).alias("target"))
    return nt.orphans(x("notes"), files)


@query(f"SELECT * FROM ({SQL['correction_audit']}) c ANTI JOIN rules USING (before, after) WHERE kind = 'word'")
def unlogged_corrections(x):
    return sp.unlogged(sp.correction_audit(x("raw_lines"), x("clean_lines")), x("rules"))


@query("""SELECT video_id, t, unnest(regexp_extract_all(text, '\\[Unclear term: possibly "([^"]*)"\\]', 1)) AS term FROM body""")
def uncertain_terms(x):
    return sp.uncertain_terms(x("body"))


@query("SELECT video_id, frame, round(avg(conf), 9) AS conf, count(*) AS regions FROM regions GROUP BY video_id, frame")
def ocr_confidence(x):
    return sp.mean_confidence(x("regions")).withColumn("conf", F.round("conf", 9))


@query(f"SELECT video_id, bool_and(covered) AS ok, count(*) AS frames, count(*) FILTER (covered) AS hit FROM ({SQL['nearest_coverage']}) c GROUP BY video_id")
def coverage_verdict(x):
    f = x("frames")
    flip = F.col("p").bitwiseXOR(F.when(F.col("idx") % 2 == 0, F.lit(15)).otherwise(F.lit(1048575)).cast("long"))
    truth = f.select("video_id", F.concat(F.lit("f"), "idx").alias("name"), "t", flip.alias("p"), "d")
    return fr.all_covered(fr.coverage(truth, f))


@query(SQL["chunk_plan"].replace("round_even((stop - start) / 60, 1) AS minutes, title, snapped", "round(round_even((stop - start) / 60, 1) * 72 / 22.3, 6) AS tokens").replace('round_even(start, 1) AS start, round_even(stop, 1) AS "end", ', ""))
def chunk_tokens(x):
    plan = fr.plan_chunks(x("ends").select("video_id", F.col("last_t").cast("double").alias("duration")), sp.section_hints(x("body")), target=5, least=3, most=8)
    return plan.select("video_id", "chunk", F.round(fr.token_estimate(F.col("minutes")), 6).alias("tokens"))


@query("""WITH s AS (SELECT video_id, idx, 600.0 + idx * 7 AS w, 1000.0 + idx * 5 AS h FROM frames), z AS (SELECT *, least(1.0, 1568.0 / greatest(w, h)) AS k FROM s)
SELECT video_id, idx, CAST(ceil(w * k * h * k / 750) AS BIGINT) AS tokens FROM z""")
def image_tokens(x):
    sized = x("frames").select("video_id", "idx", (F.col("idx") * 7 + 600.0).alias("w"), (F.col("idx") * 5 + 1000.0).alias("h"))
    return sized.select("video_id", "idx", fr.image_tokens(F.col("w"), F.col("h")).alias("tokens"))


_SIZE = "CASE WHEN b < 1024 THEN concat(b, ' B') WHEN b < 1048576 THEN concat(printf('%.1f', b / 1024.0), ' KB') WHEN b < 1073741824 THEN concat(printf('%.1f', b / 1048576.0), ' MB') ELSE concat(printf('%.1f', b / 1073741824.0), ' GB') END"


@query(f"""WITH g AS (SELECT project, dir, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS b FROM artifacts WHERE dir IN ('frames', 'audio') GROUP BY project, dir)
SELECT project, concat('Removed, can be made again from the recording:', chr(10), string_agg(concat('- ', dir, ': ', n, ' files, ', {_SIZE}), chr(10) ORDER BY dir)) AS note FROM g GROUP BY project""")
def regeneration_note(x):
    return st.regeneration_note(x("artifacts"))
