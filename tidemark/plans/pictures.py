"""Queries of the pixel operators over small pictures made from vectors, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import pixels as px
from tidemark.plans.registry import query, rounded

_PX = """px AS (SELECT video_id, idx, CAST(floor(n / 8) AS BIGINT) AS r, n % 8 AS c, CAST(CAST(floor(abs(e) * 1000) AS BIGINT) % 256 AS DOUBLE) AS v FROM (SELECT video_id, idx, unnest(embedding) AS e, unnest(range(len(embedding))) AS n FROM pictures) u)"""


def _sharp(source: str, key: str) -> str:
    """Variance of the Laplacian of the pictures in `source` (key, r, c, v)."""
    on = " AND ".join(f"{{0}}.{k} = m.{k}" for k in key.split(", "))
    sides = [("u", "m.r - 1", "m.c"), ("d", "m.r + 1", "m.c"), ("l", "m.r", "m.c - 1"), ("g", "m.r", "m.c + 1")]
    joins = " ".join(f"JOIN {source} {a} ON {on.format(a)} AND {a}.r = {r} AND {a}.c = {c}" for a, r, c in sides)
    return f"SELECT {', '.join('m.' + k for k in key.split(', '))}, var_pop(u.v + d.v + l.v + g.v - 4 * m.v) AS sharp FROM {source} m {joins} GROUP BY {', '.join('m.' + k for k in key.split(', '))}"


def _pictures(x):
    # in the components' own width, as the SQL: as floats 0.196 * 1000 is 196, as doubles of these floats just below
    grey = F.transform("embedding", lambda e: (F.floor(F.abs(e) * F.lit(1000).cast("float")) % 256).cast("int"))
    return x("pictures").select("video_id", "idx", (F.col("idx") * 2).alias("t"), F.lit(8).alias("height"), grey.alias("grey"))


@query(f"WITH {_PX} SELECT video_id, idx, round(least(avg(CASE WHEN v > 60 THEN 1.0 ELSE 0 END), 1 - avg(CASE WHEN v > 60 THEN 1.0 ELSE 0 END)), 9) AS ink FROM px GROUP BY video_id, idx")
def picture_ink(x):
    return px.frame_features(_pictures(x), 8).select("video_id", "idx", F.round("ink", 9).alias("ink"))


@query(f"WITH {_PX}, s AS ({_sharp('px', 'video_id, idx')}) SELECT video_id, idx, round(sharp, 6) AS sharpness FROM s")
def picture_sharpness(x):
    return px.picture_sharpness(_pictures(x)).withColumn("sharpness", F.round("sharpness", 6))


@query(f"""WITH {_PX}, m AS (SELECT a.video_id, a.r, a.c, avg(CASE WHEN abs(b.v - a.v) > 12 THEN 1.0 ELSE 0 END) AS m FROM px a JOIN px b ON b.video_id = a.video_id AND b.r = a.r AND b.c = a.c AND b.idx = a.idx + 1 WHERE a.idx < 120 GROUP BY a.video_id, a.r, a.c),
q AS (SELECT video_id, avg(m) AS mean, quantile_cont(m, 0.99) AS p99 FROM m GROUP BY video_id),
h AS (SELECT m.video_id, r, c, CASE WHEN m > greatest(0.12, 0.6 * p99) THEN 1.0 ELSE 0 END AS hot FROM m JOIN q USING (video_id)),
g AS (SELECT video_id, floor(r / 2) AS i, floor(c / 2) AS j, avg(hot) AS hot FROM h WHERE r < 6 AND c < 6 GROUP BY ALL),
n AS (SELECT video_id, hot, concat(CASE i WHEN 0 THEN 'top-' WHEN 1 THEN 'mid-' ELSE 'bot-' END, CASE j WHEN 0 THEN 'L' WHEN 1 THEN 'C' ELSE 'R' END) AS place, i * 3 + j AS k FROM g),
p AS (SELECT video_id, place FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY hot DESC, place DESC) AS z FROM n) w WHERE z = 1),
l AS (SELECT video_id, string_agg(printf('%.6f', hot), ' ' ORDER BY k) AS grid FROM n GROUP BY video_id), o AS (SELECT video_id, avg(hot) AS hot_share FROM h GROUP BY video_id)
SELECT video_id, round(mean, 9) AS mean, round(p99, 9) AS p99, grid, place, CASE WHEN mean > 0.12 THEN 'global' WHEN p99 >= 0.15 AND p99 >= 4 * mean THEN 'localized' ELSE 'content-only' END AS kind, round(hot_share, 9) AS hot_share FROM q JOIN p USING (video_id) JOIN l USING (video_id) JOIN o USING (video_id)""")
def picture_motion(x):
    found = px.motion(_pictures(x))
    r = lambda c: F.round(c, 9).alias(c)
    return found.select("video_id", r("mean"), r("p99"), F.array_join(F.transform("grid", lambda g: F.format_string("%.6f", g)), " ").alias("grid"), "place", "kind", r("hot_share"))


@query(f"""WITH {_PX}, w AS (SELECT a.video_id, a.idx AS mid, b.idx, b.r, b.c, b.v FROM (SELECT DISTINCT video_id, idx FROM px) a JOIN px b ON b.video_id = a.video_id AND abs(b.idx - a.idx) <= 2),
n AS (SELECT video_id, mid, count(DISTINCT idx) AS frames FROM w GROUP BY ALL), md AS (SELECT video_id, mid, r, c, floor(median(v)) AS v FROM w GROUP BY ALL),
own AS ({_sharp('px', 'video_id, idx')}), src AS (SELECT w.video_id, mid, median(sharp) AS sharp FROM (SELECT DISTINCT video_id, mid, idx FROM w) w JOIN own USING (video_id, idx) GROUP BY ALL), mds AS ({_sharp('md', 'video_id, mid')}),
t AS (SELECT video_id, mid, string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ' ' ORDER BY r, c) AS grey FROM md GROUP BY ALL)
SELECT video_id, mid * 2.0 AS at, frames, round(CASE WHEN src.sharp = 0 THEN 1 ELSE mds.sharp / src.sharp END, 9) AS ratio, CASE WHEN src.sharp = 0 THEN true ELSE mds.sharp / src.sharp >= 0.6 END AS accepted, grey
FROM n JOIN src USING (video_id, mid) JOIN mds USING (video_id, mid) JOIN t USING (video_id, mid) WHERE frames >= 5""")
def picture_median(x):
    """The median over time around every frame."""
    p = _pictures(x)
    found = px.deocclude(p, p.select("video_id", F.col("t").cast("double").alias("at")), window=8)
    return found.select("video_id", "at", "frames", rounded("ratio", 9).alias("ratio"), "accepted", F.array_join(F.col("grey").cast("array<string>"), " ").alias("grey"))


@query(f"""WITH {_PX}, k AS (SELECT video_id, CAST(count(DISTINCT idx) AS BIGINT) AS n FROM px GROUP BY video_id), f AS (SELECT video_id, idx, row_number() OVER (PARTITION BY video_id ORDER BY idx) - 1 AS z FROM (SELECT DISTINCT video_id, idx FROM px) d),
middle AS (SELECT f.video_id, f.idx FROM f JOIN k USING (video_id) WHERE z >= greatest(0, floor(n / 2) - 10) AND z < greatest(0, floor(n / 2) - 10) + 21), mine AS (SELECT px.* FROM px SEMI JOIN middle USING (video_id, idx)),
md AS (SELECT video_id, r, c, floor(median(v)) AS v FROM mine GROUP BY ALL), own AS ({_sharp('mine', 'video_id, idx')}), src AS (SELECT video_id, median(sharp) AS sharp FROM own GROUP BY video_id), mds AS ({_sharp('md', 'video_id')})
SELECT video_id, CASE WHEN src.sharp = 0 THEN true ELSE mds.sharp / src.sharp >= 0.6 END AS static FROM src JOIN mds USING (video_id)""")
def picture_camera(x):
    return px.camera_static(_pictures(x))
