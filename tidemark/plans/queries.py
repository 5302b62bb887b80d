"""One query per operator over projections of the shared tables, with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import frames as fr
from tidemark.operators import intervals as iv
from tidemark.operators import notes as nt
from tidemark.operators import speech as sp
from tidemark.operators import store as st
from tidemark.plans.registry import QUERIES, oracles, query, rounded
from tidemark.plans.select import select_frames
from tidemark.sources import signals, transcripts

__all__ = ["QUERIES", "oracles"]

_PARSED = r"""parsed AS (SELECT video_id, pos, CAST(regexp_extract(line, '^\[(\d\d):(\d\d):(\d\d)\]\s*(.*)', 1) AS BIGINT) * 3600 + CAST(regexp_extract(line, '^\[(\d\d):(\d\d):(\d\d)\]\s*(.*)', 2) AS BIGINT) * 60
  + CAST(regexp_extract(line, '^\[(\d\d):(\d\d):(\d\d)\]\s*(.*)', 3) AS BIGINT) AS t, trim(regexp_extract(line, '^\[(\d\d):(\d\d):(\d\d)\]\s*(.*)', 4)) AS text FROM raw_lines WHERE regexp_matches(line, '^\[(\d\d):(\d\d):(\d\d)\]'))"""


@query(f"""WITH {_PARSED}, back AS (SELECT *, CASE WHEN t < lag(t) OVER (PARTITION BY video_id ORDER BY pos) - 5 THEN 1 ELSE 0 END AS b FROM parsed)
SELECT video_id, pos, t, text FROM (SELECT *, sum(b) OVER (PARTITION BY video_id ORDER BY pos) AS bs FROM back) x WHERE bs = 0""")
def transcript_prefix(x):
    return transcripts.parse_transcript(x("raw_lines"))


@query(f"WITH {_PARSED} SELECT video_id, pos, t, text FROM parsed")
def transcript_all(x):
    return transcripts.parse_transcript(x("raw_lines"), monotonic=False)


@query("""SELECT video_id, block_no, hms, line FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, line ORDER BY block_no, k) AS n FROM (
    SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY seq) - 1 AS block_no, hms, 0 AS k, trim(prev) AS line FROM cues
    UNION ALL SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY seq) - 1, hms, 1, trim(text) FROM cues) a WHERE line <> '') b WHERE n = 1""")
def caption_dedup(x):
    """Files built from cues, each repeating the line before it in its own."""
    block = F.concat(F.col("hms"), F.lit(".000 --> 99:00:00.000\n<c>"), "prev", F.lit("</c>\n<c.x>"), "text", F.lit("</c>"))
    files = x("cues").groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", block.alias("b")))), lambda r: r["b"]), "\n\n").alias("content"))
    return transcripts.parse_vtt(files).select("video_id", F.col("pos.block_no").cast("long").alias("block_no"), "hms", "line")


def _regex(patterns):
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns).replace("'", "''")


@query(f"""WITH h AS (SELECT video_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY video_id ORDER BY t) <= 25 THEN 0 ELSE 1 END AS new FROM body WHERE regexp_matches(text, '{_regex(sp.AD)}')),
i AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM h)
SELECT video_id, greatest(0, min(t) - 8) AS start, max(t) + 8 AS "end" FROM i GROUP BY video_id, island""")
def ad_spans(x):
    return sp.ad_spans(x("body"))


@query(f"SELECT video_id, seq, t, left(text, 90) AS what FROM body WHERE regexp_matches(text, '{_regex(sp.POINTER)}')")
def pointers(x):
    return sp.pointers(x("body"))


@query(f"SELECT video_id, seq, t, left(text, 60) AS title FROM body WHERE regexp_matches(text, '{_regex(sp.SECTION)}')")
def section_hints(x):
    return sp.section_hints(x("body"))


@query("""WITH j AS (SELECT * FROM spans LEFT JOIN ends USING (video_id))
SELECT video_id, span_no, problem FROM (
  SELECT video_id, span_no, 'reversed' AS problem FROM j WHERE stop < start UNION ALL SELECT video_id, span_no, 'past the end' FROM j WHERE stop > last_t + 30
  UNION ALL SELECT video_id, span_no, 'too long' FROM j WHERE stop - start > 180 UNION ALL SELECT video_id, -1, 'covers too much' FROM j GROUP BY video_id HAVING sum(stop - start) > max(last_t) * 0.25) p""")
def signal_validate(x):
    return sp.validate_spans(x("spans").withColumnRenamed("stop", "end"), x("ends"))


@query("""RECURSIVE WITH o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS n FROM body),
r AS (SELECT video_id, n, seq, text, t AS block_start FROM o WHERE n = 1 UNION ALL
  SELECT o.video_id, o.n, o.seq, o.text, CASE WHEN o.t - r.block_start >= 20 THEN o.t ELSE r.block_start END FROM r JOIN o ON o.video_id = r.video_id AND o.n = r.n + 1)
SELECT video_id, block_start, string_agg(text, ' ' ORDER BY seq) AS text FROM r GROUP BY video_id, block_start""")
def digest_blocks(x):
    return sp.digest_blocks(x("body"))


@query(r"""WITH s AS (SELECT *, regexp_replace(lower(trim(text)), '\s+', ' ', 'g') AS x, stop - start AS dur FROM segments),
w AS (SELECT *, len(list_filter(string_split(x, ' '), lambda w: w <> '')) AS n, lag(x) OVER (PARTITION BY video_id ORDER BY seq) AS before, CASE WHEN length(x) > 15 THEN count(*) OVER (PARTITION BY video_id, x) ELSE 0 END AS copies FROM s)
SELECT video_id, seq, start, kind FROM (
  SELECT *, CASE WHEN x <> '' AND x = before THEN 'REPEAT' WHEN copies >= 3 THEN 'LOOP' END AS kind FROM w
  UNION ALL SELECT *, 'RATE' FROM w WHERE dur > 1 AND n / dur > 6 UNION ALL SELECT *, 'STALL' FROM w WHERE dur > 8 AND n < 3) k WHERE kind IS NOT NULL""")
def hallucination(x):
    return sp.hallucination(x("segments").withColumnRenamed("stop", "end"))


@query(r"""WITH a AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos) AS pos, line FROM raw_lines), b AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos) AS pos, line FROM clean_lines),
p AS (SELECT a.video_id, a.pos, a.line AS l, b.line AS r, list_filter(string_split_regex(a.line, '\s+'), lambda w: w <> '') AS x, list_filter(string_split_regex(b.line, '\s+'), lambda w: w <> '') AS y FROM a JOIN b USING (video_id, pos) WHERE a.line <> b.line)
SELECT video_id, pos, 'words' AS kind, l AS before, r AS after FROM p WHERE len(x) <> len(y)
UNION ALL SELECT video_id, pos, 'word', u, v FROM (SELECT video_id, pos, unnest(x) AS u, unnest(y) AS v FROM p WHERE len(x) = len(y)) z WHERE u <> v""")
def correction_audit(x):
    return sp.correction_audit(x("raw_lines"), x("clean_lines"))


_BAG = "SELECT video_id, bucket, list(DISTINCT w) AS w FROM (SELECT video_id, CAST(floor(t / 30) AS BIGINT) AS bucket, unnest(regexp_extract_all(lower(text), '[a-z0-9$.]+')) AS w FROM {}) q WHERE length(w) >= 4 GROUP BY video_id, bucket"


@query(f"""WITH a AS ({_BAG.format('body')}), b AS ({_BAG.format('other')}),
f AS (SELECT video_id, bucket, list_sort(list_filter(coalesce(a.w, []), lambda v: NOT list_contains(coalesce(b.w, []), v))) AS only_a, list_sort(list_filter(coalesce(b.w, []), lambda v: NOT list_contains(coalesce(a.w, []), v))) AS only_b FROM a FULL JOIN b USING (video_id, bucket))
SELECT video_id, bucket, array_to_string(only_a, ' ') AS only_a, array_to_string(only_b, ' ') AS only_b FROM f WHERE len(only_a) + len(only_b) > 0""")
def source_divergence(x):
    return sp.source_divergence(x("body"), x("other")).select("video_id", "bucket", F.array_join("only_a", " ").alias("only_a"), F.array_join("only_b", " ").alias("only_b"))


@query("""SELECT f.video_id, f.idx, left(string_agg(b.text, ' ' ORDER BY b.seq), 420) AS said FROM frames f LEFT JOIN body b ON b.video_id = f.video_id AND abs(b.t - f.t) <= 25 GROUP BY f.video_id, f.idx""")
def said_at(x):
    return iv.said_at(x("frames"), x("body"))


@query("""SELECT video_id, idx, seq, gap FROM (SELECT f.video_id, f.idx, b.seq, abs(b.t - f.t) AS gap, row_number() OVER (PARTITION BY f.video_id, f.idx ORDER BY abs(b.t - f.t), b.seq) AS n FROM frames f LEFT JOIN body b ON b.video_id = f.video_id) x WHERE n = 1""")
def said_nearest(x):
    return iv.nearest_line(x("frames"), x("body"))


@query("""WITH s AS (SELECT f.video_id, f.idx, f.t, left(string_agg(b.text, ' ' ORDER BY b.seq), 420) AS said FROM frames f LEFT JOIN body b ON b.video_id = f.video_id AND abs(b.t - f.t) <= 25 GROUP BY ALL)
SELECT video_id, string_agg(concat('## ', lpad(concat('', CAST(floor(t / 60) AS BIGINT)), 2, '0'), ':', lpad(concat('', t % 60), 2, '0'), ' - f', idx, chr(10), chr(10), coalesce(said, '(nothing said)')), concat(chr(10), chr(10)) ORDER BY idx) AS markdown FROM s GROUP BY video_id""")
def manifest(x):
    return iv.frame_manifest(x("frames").withColumn("name", F.concat(F.lit("f"), "idx")), x("body"))


_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOP) + "]"


@query(f"""WITH s AS (SELECT video_id, frame, list_filter(regexp_extract_all(lower(text), '[a-z0-9][a-z0-9+#.\\-]{{2,}}'), lambda w: NOT list_contains({_STOP}, w)) AS w FROM screen),
u AS (SELECT video_id, frame, unnest(w) AS term, unnest(range(len(w))) AS p FROM s), d AS (SELECT video_id, frame, term, min(p) AS p FROM u GROUP BY ALL),
o AS (SELECT video_id, frame, term, row_number() OVER (PARTITION BY video_id, frame ORDER BY p) - 1 AS pos FROM d),
spoken AS (SELECT DISTINCT video_id, unnest(regexp_extract_all(lower(text), '[a-z0-9][a-z0-9+#.\\-]{{2,}}')) AS term FROM body)
SELECT video_id, frame, pos, term FROM o ANTI JOIN spoken USING (video_id, term) WHERE length(term) >= 4""")
def visual_only_terms(x):
    return sp.visual_only(x("screen"), x("body"))


_NB = "nbs AS (SELECT *, coalesce(bit_count(xor(p, lag(p) OVER w)) + bit_count(xor(d, lag(d) OVER w)), 0) AS nb FROM frames WINDOW w AS (PARTITION BY video_id ORDER BY idx))"


@query(f"WITH {_NB} SELECT video_id, idx, CAST(nb AS BIGINT) AS nb FROM nbs")
def neighbor_distance(x):
    return fr.neighbor_distance(x("frames")).select("video_id", "idx", "nb")


_OTSU = """own AS (SELECT video_id, nb FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY idx) AS n FROM steps) x WHERE n > 1),
e AS (SELECT video_id, count(nb) AS n, CAST(min(nb) AS DOUBLE) AS lo, CAST(max(nb) AS DOUBLE) AS hi FROM own GROUP BY video_id),
c AS (SELECT video_id, CAST(least(floor((nb - lo) / (hi - lo) * 256), 255) AS BIGINT) AS bin, count(*) AS c FROM own JOIN e USING (video_id) WHERE n >= 8 AND hi > lo GROUP BY ALL),
s AS (SELECT video_id, bin, CAST(sum(c) OVER w AS DOUBLE) AS w0, CAST(sum(bin * c) OVER w AS DOUBLE) AS s0, CAST(sum(c) OVER (PARTITION BY video_id) AS DOUBLE) AS w, CAST(sum(bin * c) OVER (PARTITION BY video_id) AS DOUBLE) AS s FROM c WINDOW w AS (PARTITION BY video_id ORDER BY bin)),
v AS (SELECT video_id, bin, round(w0 * (w - w0) * pow(s0 / w0 - (s - s0) / (w - w0), 2), 6) AS v FROM s WHERE w > w0),
b AS (SELECT video_id, bin FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY v DESC, bin) AS k FROM v) x WHERE k = 1),
otsu AS (SELECT video_id, n, coalesce(lo + (bin + 1) * (hi - lo) / 256, hi) AS otsu FROM e LEFT JOIN b USING (video_id))"""


@query(f"WITH {_OTSU} SELECT video_id, n, round(otsu, 6) AS otsu FROM otsu")
def otsu_cut(x):
    own = x("steps").filter("idx > 0")
    return fr.otsu(own).select("video_id", "n", F.round("otsu", 6).alias("otsu"))


@query(f"""WITH {_OTSU}, q AS (SELECT video_id, greatest(2.0, quantile_cont(nb, 0.35)) AS s0 FROM own GROUP BY video_id),
t AS (SELECT video_id, otsu, CASE WHEN s0 >= otsu * 0.5 THEN greatest(2.0, otsu * 0.15) ELSE s0 END AS settle FROM otsu JOIN q USING (video_id))
SELECT video_id, CAST(round_even(otsu, 0) AS BIGINT) AS cut, CAST(round_even(settle, 0) AS BIGINT) AS settle, CAST(round_even(greatest(settle * 3, otsu * 0.45), 0) AS BIGINT) AS cluster FROM t""")
def calibrate(x):
    return fr.calibrate(x("steps"))


@query("""WITH own AS (SELECT video_id, nb FROM steps WHERE idx > 0),
g AS (SELECT video_id, avg(CASE WHEN nb <= 4 THEN 1.0 ELSE 0 END) AS still, avg(CASE WHEN nb > 4 AND nb <= 20 THEN 1.0 ELSE 0 END) AS micro, avg(CASE WHEN nb > 20 AND nb < 60 THEN 1.0 ELSE 0 END) AS churn, count(*) FILTER (nb >= 60) AS cuts, count(*) AS steps, median(nb) AS median,
  quantile_cont(nb, 0.9) AS p90, quantile_cont(nb, 0.25) AS p25, video_id % 3 <> 0 AS static FROM own GROUP BY video_id),
m AS (SELECT *, cuts / ((steps + 1) * 2.0 / 60) AS cuts_min FROM g)
SELECT video_id, round(still, 6) AS still, round(micro, 6) AS micro, round(churn, 6) AS churn, round(cuts_min, 6) AS cuts_min, median,
  CASE WHEN still >= 0.45 AND cuts_min >= 0.5 THEN 0 WHEN still < 0.45 AND static THEN 1 WHEN median > 20 OR NOT static THEN 2 ELSE 0 END AS tier, CAST(greatest(20, floor(p90)) AS BIGINT) AS cut, CAST(greatest(4, floor(p25)) AS BIGINT) AS settle FROM m""")
def still_profile(x):
    steps = x("steps")
    camera = steps.select("video_id", (F.col("video_id") % 3 != 0).alias("static")).distinct()
    r = lambda c: rounded(c, 6).alias(c)
    return fr.still_profile(steps, camera).select("video_id", r("still"), r("micro"), r("churn"), r("cuts_min"), "median", "tier", F.col("cut").cast("long"), F.col("settle").cast("long"))


@query(f"""WITH {_NB}, b AS (SELECT video_id, idx, t, ink, CASE WHEN idx % 4 = 0 THEN NULL ELSE nb END AS nb FROM nbs),
g AS (SELECT video_id, avg(CASE WHEN nb <= 4 THEN 1.0 WHEN nb IS NOT NULL THEN 0 END) AS still, avg(CASE WHEN nb > 4 AND nb <= 20 THEN 1.0 WHEN nb IS NOT NULL THEN 0 END) AS micro, CASE WHEN count(*) > 3 AND stddev_pop(ink) * stddev_pop(t) > 1e-12 THEN corr(ink, t) ELSE 0 END AS c FROM b GROUP BY video_id)
SELECT video_id, round(still, 6) AS still, round(micro, 6) AS micro, round(c, 6) AS ink_time_corr, CASE WHEN c > 0.7 THEN 1 WHEN still >= 0.45 THEN 0 WHEN micro >= 0.4 THEN 1 ELSE 2 END AS tier FROM g""")
def probe_tier(x):
    """Bursts of four neighbouring frames."""
    own = fr.neighbor_distance(x("frames")).withColumn("nb", F.when(F.col("idx") % 4 != 0, F.col("nb")))
    return fr.probe_tier(own).select("video_id", *[F.round(c, 6).alias(c) for c in ("still", "micro", "ink_time_corr")], "tier")


@query(f"WITH {_NB} SELECT video_id, idx, CAST(sum(CASE WHEN nb >= 50 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY idx) AS BIGINT) AS seg FROM nbs")
def segments(x):
    return fr.segments(fr.neighbor_distance(x("frames")), cut=50).select("video_id", "idx", "seg")


_CANDIDATES = """s AS (SELECT *, sum(CASE WHEN nb >= 50 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY idx) AS seg FROM nbs),
b AS (SELECT *, min(idx) OVER (PARTITION BY video_id, seg) AS s0, max(ink) OVER (PARTITION BY video_id, seg) AS most FROM s), f0 AS (SELECT video_id, seg, max(idx) AS j FROM b WHERE ink >= 0.5 * most GROUP BY ALL),
fin AS (SELECT b.* FROM b JOIN f0 ON b.video_id = f0.video_id AND b.seg = f0.seg AND b.idx = f0.j),
i AS (SELECT b.*, f0.j, sum(CASE WHEN b.idx > b.s0 AND nb > 4 THEN 1 ELSE 0 END) OVER (PARTITION BY b.video_id, b.seg ORDER BY b.idx) AS run FROM b JOIN f0 ON b.video_id = f0.video_id AND b.seg = f0.seg WHERE b.idx <= f0.j),
q AS (SELECT video_id, seg, run, count(*) AS n, max(idx) AS e, max(run) OVER (PARTITION BY video_id, seg) AS last FROM i GROUP BY video_id, seg, run),
picked AS (SELECT video_id, e AS idx, e * 2 AS t, 'final' AS role, n * 2.0 AS plateau_s FROM q WHERE run = last
UNION ALL SELECT q.video_id, e, e * 2, 'state-before', n * 2.0 FROM q JOIN fin ON fin.video_id = q.video_id AND fin.seg = q.seg JOIN frames c ON c.video_id = q.video_id AND c.idx = q.e WHERE run < last AND n >= {need} AND fin.ink < c.ink * (1 - 0.02))"""


@query(f"WITH {_NB}, {_CANDIDATES.format(need=2)} SELECT video_id, idx, t, role, plateau_s FROM picked")
def candidates(x):
    return fr.candidates(fr.neighbor_distance(x("frames")), cut=50, min_plateau=4)


@query("""RECURSIVE WITH r AS (SELECT video_id, idx, t, 999 AS dist, p, d FROM frames WHERE idx = 0 UNION ALL
  SELECT f.video_id, f.idx, f.t, CASE WHEN bit_count(xor(f.p, r.p)) + bit_count(xor(f.d, r.d)) >= 22 THEN bit_count(xor(f.p, r.p)) + bit_count(xor(f.d, r.d)) ELSE -1 END,
    CASE WHEN bit_count(xor(f.p, r.p)) + bit_count(xor(f.d, r.d)) >= 22 THEN f.p ELSE r.p END, CASE WHEN bit_count(xor(f.p, r.p)) + bit_count(xor(f.d, r.d)) >= 22 THEN f.d ELSE r.d END
  FROM r JOIN frames f ON f.video_id = r.video_id AND f.idx = r.idx + 1)
SELECT video_id, idx, t, CAST(dist AS BIGINT) AS d FROM r WHERE dist >= 0""")
def chained_dedup(x):
    return fr.chained_dedup(x("frames"))


def _clusters(near):
    """Leader clusters of candidates: one row per (video_id, n), n counting the candidates, `cl` the clusters so far."""
    return f"""o AS (SELECT k.video_id, k.idx, k.t, k.role, f.p, f.d, EXISTS (SELECT 1 FROM marks m WHERE m.video_id = k.video_id AND abs(m.t - k.t) <= 12) AS guard,
  row_number() OVER (PARTITION BY k.video_id ORDER BY k.t, CASE WHEN k.role = 'final' THEN 0 ELSE 1 END, k.idx) AS n FROM picked k JOIN frames f ON f.video_id = k.video_id AND f.idx = k.idx),
r AS (SELECT video_id, n, CAST(0 AS BIGINT) AS c, [{{'p': p, 'd': d, 'guard': guard, 'last': t}}] AS cl FROM o WHERE n = 1
  UNION ALL SELECT video_id, n, coalesce(hit - 1, len(cl)), CASE WHEN hit IS NULL THEN list_append(cl, {{'p': p, 'd': d, 'guard': guard, 'last': t}})
    ELSE list_concat(list_append(cl[1:hit - 1], {{'p': cl[hit].p, 'd': cl[hit].d, 'guard': false, 'last': t}}), cl[hit + 1:]) END
  FROM (SELECT o.*, r.cl, CASE WHEN NOT o.guard THEN list_min(list_filter(range(1, len(r.cl) + 1), lambda i: NOT r.cl[i].guard AND abs(o.t - r.cl[i].last) >= 60 AND bit_count(xor(r.cl[i].p, o.p)) + bit_count(xor(r.cl[i].d, o.d)) <= {near})) END AS hit FROM r JOIN o ON o.video_id = r.video_id AND o.n = r.n + 1) s),
g AS (SELECT o.video_id, min_by(o.idx, o.n) AS idx, min_by(o.t, o.n) AS t, min_by(o.role, o.n) AS role, r.c AS cluster, count(*) AS recurs, list(o.t ORDER BY o.n) AS recurs_at, count(*) > 1 AND max(o.t) - min(o.t) >= 60 AS is_divider FROM r JOIN o USING (video_id, n) GROUP BY o.video_id, r.c)"""


_POINTERS = f"SELECT video_id, seq, t FROM body WHERE regexp_matches(text, '{_regex(sp.POINTER)}')"
_HINTS = f"SELECT video_id, t, left(text, 60) AS title FROM body WHERE regexp_matches(text, '{_regex(sp.SECTION)}')"


def _picked(plateau):
    return _CANDIDATES.format(need=max(2, round(plateau / 2)))


@query(f"RECURSIVE WITH {_NB}, {_picked(6)}, marks AS ({_POINTERS}), {_clusters(26)} SELECT video_id, idx, t, role, cluster, recurs, array_to_string(recurs_at, ' ') AS recurs_at, is_divider FROM g")
def leader_cluster(x):
    picked = fr.candidates(fr.neighbor_distance(x("frames")), cut=50)
    flagged = iv.flag_near(picked, sp.pointers(x("body")).select("video_id", F.col("t").alias("s")), "protected")
    found = fr.leader_clusters(flagged.join(x("frames").select("video_id", "idx", "p", "d"), ["video_id", "idx"]))
    return found.withColumn("recurs_at", F.array_join(F.col("recurs_at").cast("array<string>"), " "))


@query("""RECURSIVE WITH o AS (SELECT video_id, t, p, d, CASE WHEN idx % 7 = 0 THEN 'pointer' ELSE 'sweep' END AS reason, row_number() OVER (PARTITION BY video_id ORDER BY t) AS n FROM frames),
r AS (SELECT video_id, n, t, reason, true AS kept, CAST(NULL AS BIGINT) AS twin, [{'p': p, 'd': d, 't': t}] AS ks FROM o WHERE n = 1
  UNION ALL SELECT video_id, n, t, reason, twin IS NULL OR reason = 'pointer', twin, CASE WHEN twin IS NULL OR reason = 'pointer' THEN list_append(ks, {'p': p, 'd': d, 't': t}) ELSE ks END
  FROM (SELECT o.*, r.ks, list_filter(r.ks, lambda k: bit_count(xor(k.p, o.p)) + bit_count(xor(k.d, o.d)) <= 18)[1].t AS twin FROM r JOIN o ON o.video_id = r.video_id AND o.n = r.n + 1) s)
SELECT video_id, t, reason, twin AS duplicate_of FROM r WHERE kept""")
def dedup_vs_all(x):
    reason = F.when(F.col("idx") % 7 == 0, "pointer").otherwise("sweep")
    return fr.dedup_against_kept(x("frames").withColumn("reason", reason))


_OK = "(SELECT video_id, start, stop FROM spans)"


@query(f"SELECT video_id, idx, t FROM frames f WHERE NOT EXISTS (SELECT 1 FROM {_OK} s WHERE s.video_id = f.video_id AND f.t BETWEEN s.start AND s.stop)")
def exclude_spans(x):
    return iv.exclude(x("frames").select("video_id", "idx", "t"), x("spans").withColumnRenamed("stop", "end"))


@query(f"WITH marks AS ({_POINTERS}) SELECT video_id, idx, EXISTS (SELECT 1 FROM marks b WHERE b.video_id = f.video_id AND abs(b.t - f.t) <= 12) AS protected FROM frames f")
def protected_frames(x):
    return iv.flag_near(x("frames"), sp.pointers(x("body")).select("video_id", F.col("t").alias("s")), "protected").select("video_id", "idx", "protected")


@query(f"""WITH marks AS ({_POINTERS}) SELECT video_id, seq, t FROM marks b WHERE NOT EXISTS (SELECT 1 FROM frames f WHERE f.video_id = b.video_id AND abs(f.t - b.t) <= 12)
AND NOT EXISTS (SELECT 1 FROM {_OK} s WHERE s.video_id = b.video_id AND b.t BETWEEN s.start AND s.stop)""")
def pointer_holes(x):
    return iv.pointer_holes(sp.pointers(x("body")).select("video_id", "seq", "t"), x("frames"), x("spans").withColumnRenamed("stop", "end"))


@query("""WITH tr AS (SELECT video_id, concat('f', idx) AS name, t, CASE WHEN idx % 2 = 0 THEN xor(p, CAST(15 AS BIGINT)) ELSE xor(p, CAST(1048575 AS BIGINT)) END AS p, d FROM frames), c AS (SELECT * FROM frames),
j AS (SELECT tr.video_id, tr.name, tr.t, c.t AS c_t, bit_count(xor(tr.p, c.p)) + bit_count(xor(tr.d, c.d)) AS dist, c.idx AS i FROM tr LEFT JOIN c ON c.video_id = tr.video_id)
SELECT video_id, name, t, CAST(dist AS BIGINT) AS dist, c_t AS nearest_t, coalesce(dist <= 12, false) AS covered FROM (SELECT *, row_number() OVER (PARTITION BY video_id, name, t ORDER BY dist, i) AS n FROM j) x WHERE n = 1""")
def nearest_coverage(x):
    f = x("frames")
    flip = F.col("p").bitwiseXOR(F.when(F.col("idx") % 2 == 0, F.lit(15)).otherwise(F.lit(1048575)).cast("long"))
    truth = f.select("video_id", F.concat(F.lit("f"), "idx").alias("name"), "t", flip.alias("p"), "d")
    return fr.coverage(truth, f)


@query(f"""RECURSIVE WITH c AS ({_HINTS}), v AS (SELECT video_id, CAST(last_t AS DOUBLE) AS d FROM ends),
r AS (SELECT video_id, d, 0 AS k, CAST(0 AS DOUBLE) AS start, CAST(0 AS DOUBLE) AS stop, CAST('' AS VARCHAR) AS title, false AS snapped FROM v UNION ALL
  SELECT video_id, d, k + 1, stop, CASE WHEN d - cut < 180 THEN d ELSE cut END, coalesce(h, ''), h IS NOT NULL FROM (
    SELECT r.*, coalesce((SELECT CAST(c.t AS DOUBLE) FROM c WHERE c.video_id = r.video_id AND c.t BETWEEN r.stop + 180 AND r.stop + 480 ORDER BY abs(c.t - r.stop - 300), c.t, c.title LIMIT 1), least(r.stop + 300, d)) AS cut,
      (SELECT c.title FROM c WHERE c.video_id = r.video_id AND c.t BETWEEN r.stop + 180 AND r.stop + 480 ORDER BY abs(c.t - r.stop - 300), c.t, c.title LIMIT 1) AS h FROM r WHERE r.stop < r.d - 90) x)
SELECT video_id, CAST(k AS BIGINT) AS chunk, round_even(start, 1) AS start, round_even(stop, 1) AS "end", round_even((stop - start) / 60, 1) AS minutes, title, snapped FROM r WHERE k > 0""")
def chunk_plan(x):
    return fr.plan_chunks(x("ends").select("video_id", F.col("last_t").cast("double").alias("duration")), sp.section_hints(x("body")), target=5, least=3, most=8)


@query(f"""WITH v AS (SELECT video_id, CAST(last_t AS DOUBLE) AS d FROM ends),
e AS (SELECT video_id, t + 4.0 AS t, 'pointer' AS reason, 0 AS k FROM ({_POINTERS}) p UNION ALL SELECT video_id, t + 4.0, 'section', 1 FROM ({_HINTS}) h UNION ALL SELECT video_id, t, 'uncertain', 2 FROM body WHERE contains(text, '[Unclear term: possibly "')
  UNION ALL SELECT video_id, i * 30.0, 'sweep', 3 FROM (SELECT video_id, d, unnest(range(1, greatest(1, CAST(floor(d / 30) AS BIGINT)) + 1)) AS i FROM v) q WHERE i * 30.0 < d),
c AS (SELECT video_id, round_even(CAST(greatest(0.0, least(t, d - 0.5)) AS DOUBLE), 1) AS t, reason, k FROM e JOIN v USING (video_id)),
o AS (SELECT video_id, t, reason FROM (SELECT *, row_number() OVER (PARTITION BY video_id, t ORDER BY k) AS n FROM c) z WHERE n = 1)
SELECT video_id, t, reason FROM o WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.video_id = o.video_id AND o.t BETWEEN s.start AND s.stop)""")
def sweep_timestamps(x):
    b = x("body")
    return fr.sample_times(sp.pointers(b), sp.section_hints(b), sp.uncertain_terms(b), x("ends").select("video_id", F.col("last_t").cast("double").alias("duration")), x("spans").withColumnRenamed("stop", "end"))


@query("""SELECT video_id, idx, CAST(floor(n / 20) AS BIGINT) AS sheet, CAST(floor(n % 20 / 4) AS BIGINT) AS row, CAST(n % 4 AS BIGINT) AS col FROM (SELECT video_id, idx, row_number() OVER (PARTITION BY video_id ORDER BY t, idx) - 1 AS n FROM frames) x""")
def sheet_layout(x):
    return fr.sheet_layout(x("frames").select("video_id", "idx", "t")).select("video_id", "idx", "sheet", "row", "col")


_MARK = nt.MARKER.replace("'", "''")
_NUMBER = "list_transform(regexp_extract_all(text, '\\d[\\d,]*\\.?\\d*'), lambda x: rtrim(replace(x, ',', ''), '.'))"
_NAMED = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '\\b{w}\\b') THEN '{d}' END" for w, d in T.NUMBER_WORDS.items()) + "], lambda x: x IS NOT NULL)"
_SCRUB = "raw"
for _p in T.SCRUBBED:
    _SCRUB = f"regexp_replace({_SCRUB}, '{_p}', ' ', 'g')"


@query(rf"""WITH a AS (SELECT *, trim(raw) AS s, starts_with(trim(raw), '```') AS fence FROM notes), b AS (SELECT *, sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) % 2 = 1 AND NOT fence AS code FROM a),
c AS (SELECT *, NOT fence AND NOT code AND regexp_matches(s, '^#+\s') AS heading FROM b),
d AS (SELECT *, coalesce(last_value(CASE WHEN heading THEN regexp_matches(s, '(?i)External references') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS refs FROM c),
e AS (SELECT *, NOT fence AND NOT code AND NOT heading AND NOT refs AS free, starts_with(s, '>') AS q FROM d),
f AS (SELECT *, sum(CASE WHEN free AND NOT q THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM e),
g AS (SELECT *, max(CASE WHEN free AND q AND regexp_matches(s, '{_MARK}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, block ORDER BY line_no) AS marked FROM f),
n AS (SELECT doc_id, line_no, rtrim(replace(unnest(regexp_extract_all(replace({_SCRUB}, ' ', '  '), '(?:^|[^\w.])(\d[\d,]*\.?\d*)(?:\W|$)', 1)), ',', ''), '.') AS number FROM g WHERE free AND NOT (q AND marked = 1)),
k AS (SELECT DISTINCT doc_id, unnest(list_concat({_NUMBER}, {_NAMED})) AS number FROM speech)
SELECT doc_id, line_no, number, 'needs_eye' AS severity FROM n ANTI JOIN k USING (doc_id, number) WHERE length(number) >= 2 AND number <> '10'""")
def numeric_provenance(x):
    return nt.numeric_provenance(x("notes"), x("speech"))


_FLAT = r"regexp_replace(regexp_replace(lower({}), '\s+', ' ', 'g'), '[^a-z0-9 ]', '', 'g')"


@query(rf"""WITH p AS (SELECT *, sum(CASE WHEN trim(raw) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS para FROM notes),
m AS (SELECT *, max(CASE WHEN starts_with(raw, '>') AND regexp_matches(raw, '{_MARK}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, para ORDER BY line_no) AS ext FROM p),
q AS (SELECT doc_id, line_no, unnest(regexp_extract_all(raw, '(?im)(?:^>|lecturer|states?|says?)[^\n]*?"([^"\n]{{30,200}})"', 1)) AS quote FROM m WHERE ext = 0),
w AS (SELECT *, list_filter(string_split({_FLAT.format('quote')}, ' '), lambda v: v <> '') AS w FROM q), s AS (SELECT doc_id, {_FLAT.format("text")} AS flat FROM speech)
SELECT doc_id, line_no, quote FROM w LEFT JOIN s USING (doc_id) WHERE len(w) >= 6 AND NOT coalesce(contains(flat, array_to_string(w[1:6], ' ')), false)""")
def quote_verbatim(x):
    return nt.quotes(x("notes"), x("speech"))


@query(" UNION ALL ".join([f"SELECT doc_id, 'missing' AS kind, '{n}' AS section FROM notes GROUP BY doc_id HAVING NOT bool_or(regexp_matches(raw, '(?i)^#+\\s*{n}'))" for n in nt.REQUIRED] + [f"SELECT doc_id, 'retired', '{n}' FROM notes GROUP BY doc_id HAVING bool_or(regexp_matches(raw, '(?i)^#+\\s*{n}'))" for n in nt.RETIRED]))
def note_sections(x):
    return nt.sections(x("notes"))


_LINKS = r"l AS (SELECT doc_id, line_no, trim(unnest(regexp_extract_all(raw, '\]\(([^)#]+)\)', 1))) AS target FROM notes)"


@query(f"WITH {_LINKS} SELECT doc_id, line_no, target FROM l WHERE NOT (target = 'frames/a.png' AND doc_id % 2 = 0) AND target NOT LIKE 'http%'")
def broken_links(x):
    files = x("notes").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "frames/a.png").otherwise("frames/b.png").alias("target"))
    return nt.broken_links(x("notes"), files)


_LINT = " UNION ALL ".join(
    ["SELECT doc_id, line_no, '{}' AS label, raw FROM v WHERE regexp_matches(raw, '(?i){}') OR regexp_matches(probe, '(?i){}')".format(n.replace("'", "''"), p.replace("'", "''"), p.replace("'", "''")) for n, p in nt.BANNED.items()]
    + [f"SELECT doc_id, line_no, 'inline timestamp', raw FROM v WHERE NOT heading AND NOT under AND NOT starts_with(l, '|') AND regexp_matches(raw, '{nt.STAMP}')"]
)
_HITS = rf"""a AS (SELECT *, regexp_replace(raw, '^\s+', '') AS l, starts_with(regexp_replace(raw, '^\s+', ''), '```') AS fence FROM notes),
b AS (SELECT *, sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) % 2 = 1 AS code FROM a),
u AS (SELECT *, starts_with(l, '#') AS heading, regexp_replace(raw, '{nt.EMPHASIS}', '', 'g') AS probe FROM b WHERE NOT fence AND NOT code),
v AS (SELECT *, coalesce(last_value(CASE WHEN trim(l) <> '' THEN heading END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS under FROM u),
hits AS ({_LINT})"""


@query(f"WITH {_HITS} SELECT doc_id, line_no, label, left(trim(raw), 90) AS text FROM hits")
def voice_lint(x):
    return nt.voice_lint(x("notes"))


@query(f"WITH {_HITS} SELECT label, count(*) AS hits, count(DISTINCT doc_id) AS docs FROM hits GROUP BY label")
def lint_by_label(x):
    return nt.lint_by_label(nt.voice_lint(x("notes")))


@query(rf"""WITH t AS (SELECT *, coalesce(last_value(CASE WHEN regexp_matches(raw, '^#+\s') THEN regexp_matches(raw, '(?i)^#+\s*Key takeaways') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS on_ FROM notes)
SELECT doc_id, count(*) FILTER (on_ AND regexp_matches(raw, '^\s*([-*+]|\d+\.)\s')) AS n, count(*) FILTER (on_ AND regexp_matches(raw, '^\s*([-*+]|\d+\.)\s')) BETWEEN 5 AND 8 AS ok FROM t GROUP BY doc_id""")
def takeaways(x):
    return nt.takeaways(x("notes"))


@query("""SELECT channel_id, CASE WHEN u.channel_id IS NOT NULL THEN u.name ELSE s.name END AS name, CASE WHEN u.channel_id IS NOT NULL THEN u.tier ELSE s.tier END AS tier, CASE WHEN u.channel_id IS NOT NULL THEN u.params ELSE s.params END AS params,
CASE WHEN u.channel_id IS NOT NULL THEN u.videos_seen ELSE s.videos_seen END AS videos_seen FROM seed s FULL JOIN "user" u USING (channel_id)""".replace('"user"', "(SELECT * FROM user)"))
def profile_overlay(x):
    return signals.overlay(x("seed"), x("user"))


@query("""SELECT channel_id, coalesce(u.name, s.name) AS name, coalesce(u.tier, s.tier) AS tier, coalesce(nullif(u.params, ''), s.params) AS params, coalesce(s.videos_seen, 0) + CASE WHEN u.channel_id IS NULL THEN 0 ELSE 1 END AS videos_seen FROM seed s FULL JOIN (SELECT * FROM user) u USING (channel_id)""")
def profile_upsert(x):
    return st.upsert(x("seed"), x("user").drop("videos_seen"))


@query("SELECT u.channel_id, s.name, s.tier, s.channel_id IS NOT NULL AS is_known FROM (SELECT * FROM user) u LEFT JOIN seed s USING (channel_id)")
def profile_lookup(x):
    return st.lookup(x("user").select("channel_id"), x("seed")).select("channel_id", "name", "tier", "is_known")


@query("SELECT project, dir, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM artifacts GROUP BY project, dir")
def artifact_inventory(x):
    return st.inventory(x("artifacts")).drop("size")


@query("""WITH n AS (SELECT project + 5 AS project, CASE WHEN project % 3 = 0 THEN 'nothing' ELSE concat((project + 5), '-see ', min(file)) END AS file FROM artifacts GROUP BY project),
g AS (SELECT project, count(*) FILTER (dir = 'frames' AND file LIKE '%.png') AS frames, bool_or(dir = 'transcript') AS transcript FROM artifacts GROUP BY project),
r AS (SELECT a.project, count(DISTINCT a.file) AS referenced FROM artifacts a JOIN n ON n.project = a.project AND contains(n.file, a.file) WHERE a.dir = 'frames' AND a.file LIKE '%.png' GROUP BY a.project)
SELECT project, frames, coalesce(referenced, 0) AS referenced, frames > 0 AND (n.project IS NULL OR coalesce(referenced, 0) > 0) AS may_delete_frames, transcript AS may_delete_audio FROM g LEFT JOIN r USING (project) LEFT JOIN n USING (project)""")
def cleanup_guard(x):
    text = F.when(F.col("project") % 3 == 0, F.lit("nothing")).otherwise(F.concat((F.col("project") + 5).cast("string"), F.lit("-see "), F.min("file")))
    notes = x("artifacts").groupBy("project").agg(text.alias("text")).withColumn("project", F.col("project") + 5)
    return st.cleanup_guard(x("artifacts"), notes)


@query("""WITH a AS (SELECT video_id, frame, 0 AS seq, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS s FROM screen), f AS (SELECT video_id, frame, s AS seq, text FROM a), g AS (SELECT video_id, frame, s AS seq, CASE WHEN s % 3 = 0 THEN concat('inv ', text) ELSE concat('  ', text) END AS text FROM a),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame, lower(trim(text)) ORDER BY seq) AS n FROM g) q WHERE n = 1)
SELECT video_id, frame, seq, text, 1 AS pass FROM f UNION ALL SELECT video_id, frame, seq, text, 2 FROM h WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.video_id = h.video_id AND f.frame = h.frame AND lower(trim(f.text)) = lower(trim(h.text)))""")
def ocr_merge(x):
    a = x("screen").select("video_id", "frame", F.posexplode(F.split("text", "\n")).alias("seq", "text")).withColumn("seq", F.col("seq").cast("long"))
    return sp.merge_ocr(a, a.withColumn("text", F.when(F.col("seq") % 3 == 0, F.concat(F.lit("inv "), "text")).otherwise(F.concat(F.lit("  "), "text"))))


@query(f"""WITH {_NB}, c AS (SELECT video_id, count(*) AS candidates, count(*) FILTER (nb >= 22) AS deduped, count(*) FILTER (nb >= 60) AS used FROM nbs GROUP BY video_id)
SELECT video_id, candidates, deduped, used, CASE WHEN used < 10 THEN 'few' WHEN used > 40 THEN 'many' ELSE 'ok' END AS budget FROM c""")
def status_report(x):
    f = fr.neighbor_distance(x("frames"))
    return st.status_report(f, f.filter("nb >= 22"), f.filter("nb >= 60"))


@query("SELECT video_id, seq, concat('[', lpad(concat('', CAST(floor(t / 3600) AS BIGINT)), 2, '0'), ':', lpad(concat('', CAST(floor(t % 3600 / 60) AS BIGINT)), 2, '0'), ':', lpad(concat('', t % 60), 2, '0'), '] ', text) AS value FROM body")
def transcript_sink(x):
    return st.transcript_text(x("body"))


@query("""WITH a AS (SELECT video_id, CAST(last_t AS DOUBLE) AS d, CAST(unnest(range(8)) AS INT) AS anchor FROM ends),
b AS (SELECT *, d * (0.05 + 0.9 * (anchor + CAST(CAST('0x' || substr(md5(concat('0:', video_id, ':', anchor)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296) / 8) AS start FROM a)
SELECT video_id, anchor, k, round(least(start + k * 2.0, greatest(0.0, d - 0.5)), 6) AS t FROM (SELECT *, CAST(unnest(range(4)) AS INT) AS k FROM b) c""")
def probe_anchors(x):
    return _rounded_t(fr.probe_anchors(x("ends").select("video_id", F.col("last_t").cast("double").alias("duration"))))


def _rounded_t(df):
    return df.withColumn("t", F.round("t", 6))


@query("""RECURSIVE WITH r AS (SELECT video_id, idx, t, ink AS most, false AS wipe FROM frames WHERE idx = 0
  UNION ALL SELECT f.video_id, f.idx, f.t, CASE WHEN f.ink < 0.5 * r.most THEN f.ink ELSE greatest(r.most, f.ink) END, f.ink < 0.5 * r.most FROM r JOIN frames f ON f.video_id = r.video_id AND f.idx = r.idx + 1)
SELECT video_id, idx - 1 AS idx, t - 2 AS t FROM r WHERE wipe""")
def ink_collapse(x):
    return fr.ink_collapse(x("frames"))


@query(f"""RECURSIVE WITH {_NB}, {_picked(6)}, marks AS ({_POINTERS}), {_clusters(26)},
ah AS (SELECT video_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY video_id ORDER BY t) <= 25 THEN 0 ELSE 1 END AS new FROM body WHERE regexp_matches(text, '{_regex(sp.AD)}')),
ai AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM ah), ads AS (SELECT video_id, greatest(0, min(t) - 8) AS start, max(t) + 8 AS stop FROM ai GROUP BY video_id, island)
SELECT video_id, idx, t, role, cluster, recurs, array_to_string(recurs_at, ' ') AS recurs_at, is_divider FROM g WHERE NOT EXISTS (SELECT 1 FROM ads s WHERE s.video_id = g.video_id AND g.t BETWEEN s.start AND s.stop)""")
def frame_selection(x):
    """The whole selection: candidates, protection, clusters, exclusion."""
    b = x("body")
    spans = sp.ad_spans(b)
    kept = select_frames(x("frames"), sp.pointers(b).select("video_id", "seq", "t"), sp.uncertain_terms(b), spans, cut=50)["kept"]
    return kept.withColumn("recurs_at", F.array_join(F.col("recurs_at").cast("array<string>"), " "))


@query(f"""WITH h AS (SELECT video_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY video_id ORDER BY t) <= 25 THEN 0 ELSE 1 END AS new FROM body WHERE regexp_matches(text, '{_regex(sp.AD)}')),
i AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM h), s AS (SELECT video_id, greatest(0, min(t) - 8) AS start, max(t) + 8 AS stop FROM i GROUP BY video_id, island)
SELECT video_id, seq, t, left(text, 90) AS what FROM body b WHERE regexp_matches(text, '{_regex(sp.POINTER)}') AND NOT EXISTS (SELECT 1 FROM s WHERE s.video_id = b.video_id AND b.t BETWEEN s.start AND s.stop)""")
def pointers_outside_ads(x):
    """Flagship: raw lines to their transcript, pointers in it, none inside a promotional span."""
    lines = transcripts.parse_transcript(x("raw_lines")).withColumnRenamed("pos", "seq")
    return iv.exclude(sp.pointers(lines), sp.ad_spans(lines))


from tidemark.plans import pictures, records  # noqa: E402, F401  they add their queries
