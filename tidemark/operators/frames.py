"""Frame operators over hash tables: distances, thresholds, segments, selection, coverage, layout.

Frames are rows (video_id, idx, t, h1..hn, ink): hashes as longs, compared with xor and bit counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import bits_apart

HASH = ("p", "d")


def _order(key: str = "video_id"):
    return Window.partitionBy(key).orderBy("idx")


def neighbor_distance(frames: DataFrame, hashes: tuple[str, ...] = HASH) -> DataFrame:
    """frames with nb: the distance to the frame before, 0 for a video's first."""
    lag = [F.lag(h).over(_order()) for h in hashes]
    return frames.withColumn("nb", F.coalesce(bits_apart([F.col(h) for h in hashes], lag), F.lit(0)).cast("long"))


def otsu(values: DataFrame, bins: int = 256, key: str = "video_id", value: str = "nb") -> DataFrame:
    """(key, n, otsu): the cut between two classes of values that maximizes the variance between them, the first of equals.

    Fewer than 8 values, or all equal: the largest. Bins span [least, most], the last one closed.
    """
    ends = values.groupBy(key).agg(F.count(value).alias("n"), F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    spread = ends.filter((F.col("n") >= 8) & (F.col("hi") > F.col("lo")))
    bin_of = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = values.filter(F.col(value).isNotNull()).join(spread, key).groupBy(key, bin_of.alias("bin")).agg(F.count("*").alias("c"))
    # empty bins repeat the split before them, so only the first strict maximum of the filled ones counts
    before = Window.partitionBy(key).orderBy("bin")
    whole = Window.partitionBy(key)
    s = counts.select(key, "bin", F.sum("c").over(before).alias("w0"), F.sum(F.col("bin") * F.col("c")).over(before).alias("s0"), F.sum("c").over(whole).alias("w"), F.sum(F.col("bin") * F.col("c")).over(whole).alias("s"))
    w1 = F.col("w") - F.col("w0")
    between = F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1, F.lit(2))
    best = s.filter("w > w0").withColumn("v", F.round(between, 6)).groupBy(key).agg(F.max_by("bin", F.struct("v", -F.col("bin"))).alias("bin"))
    edge = F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins
    return ends.join(best, key, "left").select(key, "n", F.coalesce(edge, "hi").alias("otsu"))


def calibrate(frames: DataFrame) -> DataFrame:
    """(video_id, cut, settle, cluster) for each video from its distances, the first (always 0) left out."""
    own = neighbor_distance(frames) if "nb" not in frames.columns else frames
    own = own.withColumn("_n", F.row_number().over(_order())).filter("_n > 1")
    p35 = own.groupBy("video_id").agg(F.expr("percentile(nb, 0.35)").alias("p35"))
    cut = otsu(own).withColumnRenamed("otsu", "c").join(p35, "video_id")
    settle = F.greatest(F.lit(2.0), F.col("p35"))
    settle = F.when(settle >= F.col("c") * 0.5, F.greatest(F.lit(2.0), F.col("c") * 0.15)).otherwise(settle)
    return cut.select("video_id", F.bround("c").cast("long").alias("cut"), F.bround(settle).cast("long").alias("settle"), F.bround(F.greatest(settle * 3, F.col("c") * 0.45)).cast("long").alias("cluster"))


def _quantile(values: Column, q: float) -> Column:
    """The q-quantile of sorted whole numbers, lo * (1 - d) + hi * d between two, of which only hi * d and the sum are
    rounded: the last bit decides on which side of a whole number it is. The sum is taken in units of 2 ** -53, as longs."""
    at, one = (F.size(values) - 1) * F.lit(q), F.lit(float(1 << 53))
    lo, hi, d = F.get(values, F.floor(at).cast("int")), F.get(values, F.ceil(at).cast("int")), at - F.floor(at)
    exact = (lo.cast("long") * ((1 - d) * one).cast("long") + (hi * d * one).cast("long")).cast("double") / one
    return F.when(hi.between(0, 511) & lo.between(0, 511), exact).otherwise(lo * (1 - d) + hi * d)


def still_profile(frames: DataFrame, camera: DataFrame | None = None, interval: float = 2.0) -> DataFrame:
    """One row per video: shares of still (<= 4), micro (4 to 20), churning (20 to 60) and cut (60 and more) steps, cuts a
    minute, median, suggested thresholds and the tier; camera: (video_id, static), static where unknown."""
    steps = frames.withColumn("_n", F.row_number().over(_order())).filter("_n > 1")
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    nb = F.col("nb")
    g = steps.groupBy("video_id").agg(
        share(nb <= 4).alias("still"), share((nb > 4) & (nb <= 20)).alias("micro"), share((nb > 20) & (nb < 60)).alias("churn"),
        F.count_if(nb >= 60).alias("cuts"), F.count("*").alias("steps"), F.median("nb").alias("median"),
        F.array_sort(F.collect_list("nb")).alias("_all"),
    )
    g = g.withColumn("p90", _quantile(F.col("_all"), 0.9)).withColumn("p25", _quantile(F.col("_all"), 0.25)).drop("_all")
    g = g.withColumn("cuts_min", F.col("cuts") / ((F.col("steps") + 1) * interval / 60))
    g = g.withColumn("static", F.lit(True)) if camera is None else g.join(camera, "video_id", "left").withColumn("static", F.coalesce("static", F.lit(True)))
    tier = F.when((F.col("still") >= 0.45) & (F.col("cuts_min") >= 0.5), 0).when((F.col("still") < 0.45) & F.col("static"), 1).when((F.col("median") > 20) | ~F.col("static"), 2).otherwise(0)
    return g.withColumn("tier", tier).withColumn("cut", F.greatest(F.lit(20), F.floor("p90"))).withColumn("settle", F.greatest(F.lit(4), F.floor("p25"))).drop("p90", "p25", "steps")


def probe_anchors(videos: DataFrame, anchors: int = 8, burst: int = 4, interval: float = 2.0, seed: int = 0) -> DataFrame:
    """(video_id, anchor, k, t) for videos (video_id, duration): one burst in each of `anchors` equal parts of 5 to 95 %.

    The place in a part is a hash of seed, video and part that any engine can compute, so runs agree.
    """
    a = videos.select("video_id", "duration", F.explode(F.sequence(F.lit(0), F.lit(anchors - 1))).alias("anchor"))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "video_id", "anchor")), 1, 8), 16, 10).cast("long") / float(1 << 32)
    at = F.col("duration") * (0.05 + 0.9 * (F.col("anchor") + draw) / anchors)
    return a.withColumn("at", at).select("video_id", "anchor", F.explode(F.sequence(F.lit(0), F.lit(burst - 1))).alias("k"), "at", "duration").select("video_id", "anchor", "k", F.least(F.col("at") + F.col("k") * interval, F.greatest(F.lit(0.0), F.col("duration") - 0.5)).alias("t"))


def probe_tier(samples: DataFrame) -> DataFrame:
    """(video_id, still, micro, ink_time_corr, tier) of sampled bursts (video_id, anchor, idx, t, ink, nb within a burst, null at its start)."""
    nb = F.col("nb")
    flat = F.stddev_pop("ink") * F.stddev_pop("t")
    corr = F.when((F.count("*") > 3) & (flat > 1e-12), F.try_divide(F.covar_pop("ink", "t"), flat)).otherwise(0.0)
    g = samples.groupBy("video_id").agg(F.avg(F.when(nb <= 4, 1.0).when(nb.isNotNull(), 0.0)).alias("still"), F.avg(F.when((nb > 4) & (nb <= 20), 1.0).when(nb.isNotNull(), 0.0)).alias("micro"), corr.alias("ink_time_corr"))
    return g.withColumn("tier", F.when(F.col("ink_time_corr") > 0.7, 1).when(F.col("still") >= 0.45, 0).when(F.col("micro") >= 0.4, 1).otherwise(2))


def segments(frames: DataFrame, cut: int = 60) -> DataFrame:
    """frames with seg: the number of hard cuts (nb >= cut) so far."""
    return frames.withColumn("seg", F.sum(F.when(F.col("nb") >= cut, 1).otherwise(0)).over(_order()))


def candidates(frames: DataFrame, cut: int = 60, settle: int = 4, min_plateau: float = 6, interval: float = 2.0, ink_drop: float = 0.02) -> DataFrame:
    """(video_id, idx, t, role, plateau_s): each segment's final frame, and states before content was taken away.

    final: the last frame with at least half the segment's most ink; its plateau reaches back over steps <= settle.
    state-before: the last frame of a plateau of `min_plateau` seconds before the final one's, if the final frame has
    less ink by more than `ink_drop`. A plateau still open at the final frame is not one of these.
    """
    need = max(2, round(min_plateau / interval))
    s = segments(frames, cut)
    seg = Window.partitionBy("video_id", "seg")
    inside = seg.orderBy("idx")
    s = s.withColumn("n", F.row_number().over(inside)).withColumn("most", F.max("ink").over(seg))
    s = s.withColumn("fin", F.max(F.when(F.col("ink") >= F.col("most") * 0.5, F.col("n"))).over(seg))
    # a step over settle opens a plateau; a segment's first frame always does
    s = s.withColumn("open", F.when((F.col("n") > 1) & (F.col("nb") > settle), 1).otherwise(0)).withColumn("run", F.sum("open").over(inside))
    final = s.filter("n = fin").select("video_id", "seg", "idx", "t", "ink", F.col("run").alias("last"), "n")
    runs = s.filter("n <= fin").groupBy("video_id", "seg", "run").agg(F.count("*").alias("len"), F.max_by(F.struct("idx", "t", "ink"), "n").alias("end"), F.min("n").alias("first"))
    met = runs.join(final.withColumnRenamed("idx", "f_idx").withColumnRenamed("ink", "f_ink").select("video_id", "seg", "last", "f_ink", "f_idx"), ["video_id", "seg"])
    before = met.filter((F.col("run") < F.col("last")) & (F.col("len") >= need) & (F.col("f_ink") < F.col("end.ink") * (1 - ink_drop))).select("video_id", "end.idx", "end.t", F.lit("state-before").alias("role"), (F.col("len") * interval).alias("plateau_s"))
    ends = met.filter("run = last").join(final, ["video_id", "seg"]).select("video_id", "idx", "t", F.lit("final").alias("role"), (F.col("len") * interval).alias("plateau_s"))
    return ends.union(before)


def _timeline(frames: DataFrame, *columns: str) -> DataFrame:
    """(video_id, rows): each video's frames as one array, by idx."""
    return frames.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("idx", *columns))).alias("rows"))


def chained_dedup(frames: DataFrame, threshold: int = 22, hashes: tuple[str, ...] = HASH) -> DataFrame:
    """(video_id, idx, t, d): frames at least `threshold` from the last one kept; the first has d 999. A fold over a video's frames."""
    far = lambda r, last: bits_apart([r[h] for h in hashes], [last[h] for h in hashes]).cast("long")
    kept = F.struct(F.lit(None).cast("long").alias("idx"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("long").alias("d"))
    first = F.struct(*[F.lit(None).cast("long").alias(h) for h in hashes], F.slice(F.array(kept), 1, 0).alias("kept"))

    def step(a: Column, r: Column) -> Column:
        d = F.coalesce(far(r, a), F.lit(999).cast("long"))
        one = F.struct(r["idx"].cast("long").alias("idx"), r["t"].cast("long").alias("t"), d.alias("d"))
        return F.when(d >= threshold, F.struct(*[r[h].cast("long").alias(h) for h in hashes], F.concat(a["kept"], F.array(one)).alias("kept"))).otherwise(a)

    return _timeline(frames, "t", *hashes).select("video_id", F.explode(F.aggregate("rows", first, step)["kept"]).alias("k")).select("video_id", "k.idx", "k.t", "k.d")


class _Kept:
    """Hashes kept so far, compared with a new one all at once."""

    def __init__(self, most: int, width: int):
        self.hashes, self.n = np.zeros((most, width), np.int64), 0

    def add(self, h: np.ndarray) -> None:
        self.hashes[self.n] = h
        self.n += 1

    def near(self, h: np.ndarray, most: int) -> np.ndarray:
        """For each kept one: is it within `most`?"""
        return np.bitwise_count((self.hashes[: self.n] ^ h).view(np.uint64)).sum(1) <= most


def _matrix(pdf: pd.DataFrame, hashes: tuple[str, ...]) -> np.ndarray:
    return np.stack([pdf[h].to_numpy(np.int64) for h in hashes], 1)


def leader_clusters(picked: DataFrame, cluster: int | str = 26, recur_span: int = 60, hashes: tuple[str, ...] = HASH) -> DataFrame:
    """(video_id, idx, t, role, cluster, recurs, recurs_at, is_divider) of candidates (video_id, idx, t, role, protected, hashes).

    A candidate joins the first cluster whose first member is within `cluster` (a number, or a column that holds each
    video's) and unprotected and whose last member is at least `recur_span` seconds away; protected candidates stand
    alone. A cluster is shown by its first member. Only the assignment is a fold; what clusters are is an aggregation.
    """
    limit = F.col(cluster) if isinstance(cluster, str) else F.lit(cluster)

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "late", "idx"], ignore_index=True)
        h, times, alone, most = _matrix(pdf, hashes), pdf.t.to_numpy(), pdf.protected.to_numpy(bool), int(pdf.near.iloc[0])
        leaders, open_, seen, label = _Kept(len(pdf), len(hashes)), np.zeros(len(pdf), bool), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k in range(len(pdf)):
            n = leaders.n
            fits = np.zeros(0, bool) if alone[k] else open_[:n] & (np.abs(times[k] - seen[:n]) >= recur_span) & leaders.near(h[k], most)
            label[k] = fits.argmax() if fits.any() else n
            if label[k] == n:
                leaders.add(h[k])
                open_[n] = not alone[k]
            seen[label[k]] = times[k]
        return pdf.assign(cluster=label, place=np.arange(len(pdf)))[["video_id", "idx", "t", "role", "cluster", "place"]]

    late = F.when(F.col("role") == "final", 0).otherwise(1).alias("late")
    rows = picked.select("video_id", "idx", "t", "role", "protected", late, limit.cast("long").alias("near"), *hashes)
    dealt = rows.groupBy("video_id").applyInPandas(assign, "video_id long, idx long, t long, role string, cluster long, place long")
    shown = dealt.groupBy("video_id", "cluster").agg(F.min_by(F.struct("idx", "t", "role"), "place").alias("r"), F.count("*").alias("recurs"), F.transform(F.array_sort(F.collect_list(F.struct("place", "t"))), lambda x: x["t"]).alias("recurs_at"))
    spread = F.array_max("recurs_at") - F.array_min("recurs_at")
    return shown.select("video_id", "r.*", "cluster", "recurs", "recurs_at", ((F.col("recurs") > 1) & (spread >= recur_span)).alias("is_divider"))


def dedup_against_kept(picked: DataFrame, threshold: int = 18, hashes: tuple[str, ...] = HASH) -> DataFrame:
    """(video_id, t, reason, duplicate_of): candidates by time that no kept one is within `threshold` of.

    Pointer and uncertain candidates stay and name the first kept one that they repeat.
    """

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "reason"], ignore_index=True)
        h, wanted, kept, rows, twins = _matrix(pdf, hashes), pdf.reason.isin(["pointer", "uncertain"]).to_numpy(), _Kept(len(pdf), len(hashes)), [], []
        for k in range(len(pdf)):
            same = kept.near(h[k], threshold)
            if wanted[k] or not same.any():
                twins.append(rows[same.argmax()] if same.any() else None)
                rows.append(k)
                kept.add(h[k])
        out = pdf.loc[rows, ["video_id", "t", "reason"]]
        return out.assign(duplicate_of=pd.array([None if x is None else pdf.t[x] for x in twins], "Int64"))

    return picked.select("video_id", "t", "reason", *hashes).groupBy("video_id").applyInPandas(keep, "video_id long, t long, reason string, duplicate_of long")


def coverage(truth: DataFrame, found: DataFrame, tol: int = 12, hashes: tuple[str, ...] = HASH) -> DataFrame:
    """(video_id, name, t, dist, nearest_t, covered): for each truth frame the nearest candidate of its video, the first of equals."""
    other = found.select("video_id", F.col("t").alias("c_t"), F.col("idx").alias("c_idx"), *[F.col(h).alias(f"c_{h}") for h in hashes])
    d = bits_apart([F.col(h) for h in hashes], [F.col(f"c_{h}") for h in hashes]).cast("long")
    best = F.min(F.when(F.col("c_t").isNotNull(), F.struct(d.alias("d"), F.col("c_idx").alias("i"), F.col("c_t").alias("t")))).alias("b")
    pairs = truth.join(other, "video_id", "left").groupBy("video_id", "name", "t").agg(best)
    return pairs.select("video_id", "name", "t", F.col("b.d").alias("dist"), F.col("b.t").alias("nearest_t"), F.coalesce(F.col("b.d") <= tol, F.lit(False)).alias("covered"))


def all_covered(covered: DataFrame) -> DataFrame:
    return covered.groupBy("video_id").agg(F.bool_and("covered").alias("ok"), F.count("*").alias("frames"), F.count_if("covered").alias("hit"))


def sheet_layout(frames: DataFrame, cols: int = 4, rows: int = 5) -> DataFrame:
    """frames (video_id, idx, t) with sheet, row and col of their tile."""
    n, per = F.row_number().over(Window.partitionBy("video_id").orderBy("t", "idx")) - 1, cols * rows
    return frames.withColumn("_n", n).withColumn("sheet", F.floor(F.col("_n") / per)).withColumn("row", F.floor(F.col("_n") % per / cols)).withColumn("col", (F.col("_n") % cols).cast("long")).drop("_n")


def sample_times(pointers: DataFrame, sections: DataFrame, uncertain: DataFrame, videos: DataFrame, spans: DataFrame, sweep: float = 30, settle_delay: float = 4) -> DataFrame:
    """(video_id, t, reason): times at which to grab frames, each once with its first reason, none in an excluded span.

    Pointers, sections (after a delay to settle), uncertain times, then a sweep of (video_id, duration). Times are
    rounded to a tenth, half to even, within [0, duration - 0.5].
    """
    def of(df, at, reason, rank):
        return df.select("video_id", at.cast("double").alias("t"), F.lit(reason).alias("reason"), F.lit(rank).alias("rank"))

    step = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("duration") / sweep).cast("int"))), lambda i: i * F.lit(float(sweep)))
    swept = videos.select("video_id", "duration", F.explode(step).alias("t")).filter("t < duration")
    every = of(pointers, F.col("t") + settle_delay, "pointer", 0).union(of(sections, F.col("t") + settle_delay, "section", 1)).union(of(uncertain, F.col("t"), "uncertain", 2)).union(of(swept, F.col("t"), "sweep", 3))
    clamped = every.join(videos, "video_id").withColumn("t", F.bround(F.greatest(F.lit(0.0), F.least(F.col("t"), F.col("duration") - 0.5)), 1))
    once = clamped.withColumn("n", F.row_number().over(Window.partitionBy("video_id", "t").orderBy("rank"))).filter("n = 1").select("video_id", "t", "reason")
    from tidemark.operators.intervals import exclude

    return exclude(once, spans)


def plan_chunks(videos: DataFrame, cuts: DataFrame, target: float = 25, least: float = 15, most: float = 40) -> DataFrame:
    """(video_id, chunk, start, end, minutes, title, snapped) for videos (video_id, duration): greedy, minutes as given.

    From each start the section hint (video_id, t, title) between `least` and `most` away that is nearest to `target`
    (the earliest of equals) ends the chunk, else the clock; a tail shorter than `least` joins the last chunk.
    """
    tgt, lo, hi = target * 60.0, least * 60.0, most * 60.0
    hints = cuts.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(F.col("t").cast("double").alias("t"), F.col("title").alias("title")))).alias("hints"))
    v = videos.join(hints, "video_id", "left").withColumn("hints", F.coalesce("hints", F.array().cast("array<struct<t: double, title: string>>")))
    # no chunk is shorter than `least`, so this many steps always do
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("duration") / lo).cast("int") + 1))
    kind = "array<struct<start: double, end: double, title: string, snapped: boolean>>"
    state = F.struct(F.lit(0.0).alias("start"), F.array().cast(kind).alias("done"))

    def step(a: Column, _: Column) -> Column:
        start, d = a["start"], F.col("duration")
        fit = F.filter("hints", lambda h: (h["t"] >= start + lo) & (h["t"] <= start + hi))
        ranked = F.array_sort(F.transform(fit, lambda h: F.struct(F.abs(h["t"] - start - tgt).alias("gap"), h["t"].alias("t"), h["title"].alias("title"))))
        hit = F.size(ranked) > 0
        near = F.get(ranked, F.lit(0))
        cut = F.when(hit, near["t"]).otherwise(F.least(start + tgt, d))
        cut = F.when(d - cut < lo, d).otherwise(cut)
        chunk = F.struct(start.alias("start"), cut.alias("end"), F.coalesce(near["title"], F.lit("")).alias("title"), hit.alias("snapped"))
        return F.when((start >= d - lo / 2) | (start >= d), a).otherwise(F.struct(cut.alias("start"), F.concat(a["done"], F.array(chunk)).alias("done")))

    done = v.select("video_id", F.posexplode(F.aggregate(steps, state, step)["done"]).alias("k", "c"))
    return done.select("video_id", (F.col("k") + 1).cast("long").alias("chunk"), F.bround("c.start", 1).alias("start"), F.bround("c.end", 1).alias("end"), F.bround((F.col("c.end") - F.col("c.start")) / 60, 1).alias("minutes"), "c.title", "c.snapped")


def token_estimate(minutes: Column) -> Column:
    """Thousands of tokens that a chunk of so many minutes takes."""
    return minutes * 72 / 22.3


def image_tokens(width: Column, height: Column) -> Column:
    """Tokens of an image whose longer edge is first shrunk to 1568."""
    scale = F.least(F.lit(1.0), F.lit(1568.0) / F.greatest(width, height))
    return F.ceil(width * scale * height * scale / 750)


def ink_collapse(frames: DataFrame, drop: float = 0.5) -> DataFrame:
    """(video_id, idx, t): the last frame before a page is wiped: the next has less than `drop` times the most ink of its page so far.

    A wipe starts a new page, so a page's most ink is that since the last wipe. A fold over a video's frames.
    """
    none = F.struct(F.lit(None).cast("long").alias("idx"), F.lit(None).cast("long").alias("t"))
    first = F.struct(F.lit(float("-inf")).alias("most"), none.alias("before"), F.slice(F.array(none), 1, 0).alias("wiped"))

    def step(a: Column, r: Column) -> Column:
        here = F.struct(r["idx"].cast("long").alias("idx"), r["t"].cast("long").alias("t"))
        wipe = a["before"]["idx"].isNotNull() & (r["ink"] < F.lit(drop) * a["most"])
        return F.struct(F.when(wipe, r["ink"]).otherwise(F.greatest(a["most"], r["ink"])).alias("most"), here.alias("before"), F.when(wipe, F.concat(a["wiped"], F.array(a["before"]))).otherwise(a["wiped"]).alias("wiped"))

    return _timeline(frames, "t", "ink").select("video_id", F.explode(F.aggregate("rows", first, step)["wiped"]).alias("w")).select("video_id", "w.idx", "w.t")
