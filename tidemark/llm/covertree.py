"""Near-duplicate vectors by cosine, with cover trees and a dual traversal.

Unit vectors with a cosine of at least c lie within r = sqrt(2 - 2c) of each other. A label's vectors are dealt to the
nearest of its centres; a vector also visits the cells that a neighbour within r could be dealt to, those whose
bisector it is near enough. In a cell a cover tree has levels with halving radii, each centre among its own children;
node pairs that their covering radii put out of reach are dropped, pairs wholly within reach are counted without
looking inside, and what is left at the leaves is computed. A task returns how many links each vector has and one row
per vector that joins it to its group, never a row per pair, so a cluster of g vectors costs g rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from . import common

#: How far rounding can move a distance of unit vectors; pairs nearer to the limit than this are computed as defined.
SLACK = 1e-9
LEAF = 32


class CoverTree:
    """Cover tree over unit vectors: nodes in arrays, children of a node side by side, each node's points one range."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.order = np.arange(n)
        self.centre, self.radius, self.start, self.end, self.child, self.children = [], [], [], [], [], []
        if not n:
            return
        self._add(x, 0, n)
        queue = [(0, None)]
        while queue:
            node, reach = queue.pop()
            s, e = self.start[node], self.end[node]
            if e - s <= LEAF or self.radius[node] <= SLACK:
                continue
            half = (self.radius[node] if reach is None else reach) / 2
            while half > 0 and half >= self.radius[node]:
                half /= 2  # a level without a new centre
            own = self.order[s:e]
            left, groups = own, []
            while len(left):  # greedily: the first point left over is a centre and takes what is within the new radius
                near = _distance(x[left], x[left[0]]) <= half
                near[0] = True
                groups.append(left[near])
                left = left[~near]
                if len(groups) >= 64 and len(left) > len(own) // 2:
                    # far-flung points: nothing is gained by levels, each is a node
                    groups += [left[k : k + 1] for k in range(len(left))]
                    break
            self.order[s:e] = np.concatenate(groups)
            self.child[node], self.children[node] = len(self.centre), len(groups)
            for g in groups:
                self._add(x, s, s + len(g))
                s += len(g)
            queue += [(self.child[node] + k, half) for k in range(len(groups))]
        self.centre, self.start, self.end, self.child, self.children = (np.array(v, np.int64) for v in (self.centre, self.start, self.end, self.child, self.children))
        self.radius = np.array(self.radius)

    def _add(self, x: np.ndarray, s: int, e: int) -> None:
        own = self.order[s:e]
        self.centre.append(own[0])
        self.radius.append(float(_distance(x[own], x[own[0]]).max()) if e - s > 1 else 0.0)
        self.start.append(s)
        self.end.append(e)
        self.child.append(0)
        self.children.append(0)


def _distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - c) ** 2).sum(1), 0))


def _blocks(a: np.ndarray, b: np.ndarray, most: int = 1 << 20):
    step = max(1, most // max(1, len(b)))
    for s in range(0, len(a), step):
        yield s, a[s : s + step]


def dual(tree: CoverTree, x: np.ndarray, other: CoverTree | None, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, exact, reach: float, met):
    """Per point of x and of y the weight of its links to the other side; `met` gets pairs (in x, in y) that join all linked ones.

    Without `other`, y is x and each pair of different points counts once for both. `exact(i, j)` settles pairs.
    """
    own = other is None
    t2 = tree if own else other
    nx, ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    least = 1 - reach * reach / 2

    def leaves(i, j, dot):
        close = dot >= least - SLACK
        i, j, dot = i[close], j[close], dot[close]
        unsure = np.flatnonzero(dot < least + SLACK)
        if len(unsure):
            good = np.ones(len(i), bool)
            good[unsure] = exact(i[unsure], j[unsure])
            i, j = i[good], j[good]
        np.add.at(nx, i, wy[j])
        np.add.at(ny, j, wx[i])
        met(i, j)

    if not len(x) or not len(y):
        return nx, ny
    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        pa_, pb = tree.order[tree.start[a] : tree.end[a]], t2.order[t2.start[b] : t2.end[b]]
        same = own and a == b
        if not same:
            d = float(np.sqrt(max(((x[tree.centre[a]] - y[t2.centre[b]]) ** 2).sum(), 0)))
            if d - tree.radius[a] - t2.radius[b] > reach + SLACK:
                continue
            most = d + tree.radius[a] + t2.radius[b]
        else:
            most = 2 * tree.radius[a]
        if most < reach - SLACK and len(pa_) * len(pb) > 1:  # all pairs link
            sx, sy = wx[pa_].sum(), wy[pb].sum()
            if same:
                nx[pa_] += sx - wx[pa_]
            else:
                nx[pa_] += sy
                ny[pb] += sx
            met(np.concatenate([np.full(len(pb), pa_[0]), pa_]), np.concatenate([pb, np.full(len(pa_), pb[0])]))
            continue
        ka, kb = tree.children[a], t2.children[b]
        if not ka and not kb:
            for s, part in _blocks(pa_, pb):
                dot = x[part] @ y[pb].T
                i, j = np.nonzero(dot >= least - SLACK)
                keep = i + s < j if same else slice(None)
                leaves(part[i[keep]], pb[j[keep]], dot[i[keep], j[keep]])
            continue
        # all children of both (a leaf stands for itself), in one product
        ca = np.arange(tree.child[a], tree.child[a] + ka) if ka else np.array([a])
        cb = np.arange(t2.child[b], t2.child[b] + kb) if kb else np.array([b])
        ra, rb = tree.radius[ca], t2.radius[cb]
        single_a, single_b = tree.end[ca] - tree.start[ca] == 1, t2.end[cb] - t2.start[cb] == 1
        yb = y[t2.centre[cb]]
        for s, part in _blocks(ca, cb):
            dot = x[tree.centre[part]] @ yb.T
            bound = reach + 1e-6 + ra[s : s + len(part), None] + rb[None]
            i, j = np.nonzero(2 - 2 * dot <= bound * bound)
            dot = dot[i, j]
            i += s
            if same:
                up = i <= j
                i, j, dot = i[up], j[up], dot[up]
            points = single_a[i] & single_b[j]
            different = points & (ca[i] != cb[j]) if own else points
            leaves(tree.centre[ca[i[different]]], t2.centre[cb[j[different]]], dot[different])
            stack += zip(ca[i[~points]].tolist(), cb[j[~points]].tolist())
    return nx, ny


def _matrix(vectors) -> np.ndarray:
    """A list column whose lists are of one length."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _dealer(sent, reach: float):
    """Deals vectors (label, dim, vec, rep, m) to their home cell and to those they visit."""

    def run(batches):
        centres = sent.value
        for b in batches:
            labels, dims, reps = (b.column(k).to_pylist() for k in ("label", "dim", "rep"))
            out = []
            by = {}
            for k, g in enumerate(zip(labels, dims)):
                by.setdefault(g, []).append(k)
            for g, rows in by.items():
                cs = centres.get(g)
                if cs is None or len(cs) == 1:
                    out += [(k, 0, 0) for k in rows]
                    continue
                x = _unit(_matrix(b.column("vec").take(pa.array(rows))))
                d2 = np.maximum(2 - 2 * x @ cs.T, 0)
                home = d2.argmin(1)
                gap = np.sqrt(np.maximum(2 - 2 * cs @ cs.T, 0))
                # a neighbour dealt to cell c is nearer to c than to home: the bisector is within reach
                visit = d2 - d2[np.arange(len(x)), home][:, None] <= 2 * (reach + 1e-6) * gap[home] + 1e-9
                visit &= np.arange(len(cs))[None] <= home[:, None]
                i, c = np.nonzero(visit)
                out += zip(np.array(rows)[i].tolist(), c.tolist(), home[i].tolist())
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(n).take(at) for n in ("label", "dim", "vec", "rep", "m")] + [pa.array([o[k] for o in out], pa.int32()) for k in (1, 2)], ["label", "dim", "vec", "rep", "m", "cell", "home"])

    return run


def _search(cosine: float):
    reach = float(np.sqrt(2 - 2 * cosine))
    keys = ("label", "dim", "cell", "low", "high")

    def same(t):
        return common.new_group(*(t.column(k).to_numpy() for k in keys))

    def run(batches):
        for t in common.whole_groups(batches, same, 1):
            starts = np.flatnonzero(~same(t))
            for s, e in zip(starts, [*starts[1:], t.num_rows]):
                g = t.slice(s, e - s)
                raw = _matrix(g.column("vec"))
                x = _unit(raw)
                rep, m, part, home = (g.column(k).to_numpy() for k in ("rep", "m", "part", "home"))
                cell, low, high = (g.column(k)[0].as_py() for k in ("cell", "low", "high"))
                norm = np.sqrt((raw * raw).sum(1))
                count, links = np.zeros(len(x), np.int64), common.Union(len(x))

                def meet(i, j):
                    def exact(a, b):
                        return (raw[i[a]] * raw[j[b]]).sum(1) / (norm[i[a]] * norm[j[b]]) >= cosine

                    na, nb = dual(CoverTree(x[i]), x[i], CoverTree(x[j]), x[j], m[i], m[j], exact, reach, lambda a, b: links.add(i[a], j[b]))
                    np.add.at(count, i, na)
                    np.add.at(count, j, nb)

                def inside(i):
                    def exact(a, b):
                        return (raw[i[a]] * raw[i[b]]).sum(1) / (norm[i[a]] * norm[i[b]]) >= cosine

                    na, nb = dual(CoverTree(x[i]), x[i], None, x[i], m[i], m[i], exact, reach, lambda a, b: links.add(i[a], i[b]))
                    np.add.at(count, i, na + nb)

                mine = home == cell
                if low == high:
                    inside(np.flatnonzero(mine))
                    meet(np.flatnonzero(mine), np.flatnonzero(~mine))
                else:
                    left, right = part == low, part == high
                    meet(np.flatnonzero(left & mine), np.flatnonzero(right & mine))
                    meet(np.flatnonzero(left & mine), np.flatnonzero(right & ~mine))
                    meet(np.flatnonzero(left & ~mine), np.flatnonzero(right & mine))
                root = links.roots()
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(rep[root]), pa.array(count)], ["rep", "root", "n"]).filter(pa.array((count > 0) | (root != np.arange(len(x)))))

    return run


def near_vectors(df: DataFrame, cosine: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label", cell: int = 16_384, most_centres: int = 4096, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of df.

    Rows link when their labels are equal and not null, their vectors have the same length, and the cosine in double
    precision is at least `cosine`. Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing. n_links counts the other rows linked directly, equal vectors too; component_id is the smallest id
    reachable; kept says whether it is the row's own. Repeated rows are kept and link with each other. A row without an
    id takes part but names no component; without links its component_id is null. Other columns are not looked at. An
    empty table gives an empty result.

    Equal vectors are joined first. Centres are a hash sample of about one vector in `cell`, at most about
    `most_centres` in all; a cell with more than `cell` vectors is dealt out by pairs of parts, so every pair still meets.
    A label of up to `cell` vectors is one cell, and nothing is sent twice. Beyond, a vector is sent to its own cell and to
    those it may have a neighbour in: a few where the vectors form groups, up to all of them where they have no structure.
    """
    spark = df.sparkSession
    reach = float(np.sqrt(2 - 2 * cosine))
    kind = "array<float>" if df.schema[vector].dataType == ArrayType(FloatType(), df.schema[vector].dataType.containsNull) else "array<double>"
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast(kind).alias("vec"))
    usable = F.col("label").isNotNull() & F.coalesce(F.size("vec") > 0, F.lit(False)) & F.coalesce(~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False)) & F.coalesce(F.exists("vec", lambda v: v != 0), F.lit(False))
    # 0.0 + x makes -0.0 and 0.0 one value
    named = common.stored(rows.withColumn("ok", usable).withColumn("vec", F.when(F.col("ok"), F.transform("vec", lambda v: v + F.lit(0.0)).cast(kind))).withColumn("key", F.when(F.col("ok"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("vec", lambda v: F.hex(v.cast("double").cast("string")))), 256))).drop("ok"), "vectors")
    classes = common.stored(
        named.filter("key is not null").groupBy("key").agg(F.min("id").alias("rep_id"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("vec").alias("vec")).select(F.monotonically_increasing_id().alias("rep"), "key", "rep_id", "m", "label", "vec", F.size("vec").alias("dim")),
        "classes",
    )
    total = classes.count()
    share = min(1.0 / cell, most_centres / max(total, 1))
    groups = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > cell).withColumnRenamed("label", "l").withColumnRenamed("dim", "d")
    drawn = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    sample = classes.filter(drawn).join(groups, (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d"))).select("label", "dim", "vec").collect()
    centres: dict = {}
    for r in sorted(sample):
        centres.setdefault((r.label, r.dim), []).append(r.vec)
    centres = {g: _unit(np.array(v)) for g, v in centres.items()}
    dealt = classes.select("label", "dim", "vec", "rep", "m").mapInArrow(common.frugal(_dealer(spark.sparkContext.broadcast(centres), reach)), f"label long, dim int, vec {kind}, rep long, m long, cell int, home int")
    sizes = dealt.groupBy("label", "dim", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > cell)
    k = F.ceil(F.coalesce("n", F.lit(1)) / cell).cast("int")
    tasks = (
        dealt.join(sizes, ["label", "dim", "cell"], "left")
        .withColumn("k", k)
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("label", "dim", "cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "home", "rep", "m", "vec")
    )
    keys = ("label", "dim", "cell", "low", "high")
    met = tasks.repartition(common.parts(spark), *keys).sortWithinPartitions(*keys).mapInArrow(common.frugal(_search(cosine)), "rep long, root long, n long")
    found = common.stored(met, "met")
    ends = common.components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    known = classes.select("rep", "key", "rep_id", "m").join(links, "rep", "left").join(ends.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.filter("n IS NOT NULL OR m > 1").select("rep", "key", "rep_id", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    # a vector that is alone is not joined; hot components and keys are dealt to several tasks
    known = common.stored(known, "known")
    least = known.groupBy("c").agg(F.min("rep_id").alias("component_id"))
    of = common.salted(known, least, "c", "rep").select("key", F.col("n_links").alias("found"), "component_id")
    joined = common.salted(named.select("id", "key").filter("key is not null"), of, "key", "id")
    joined = joined.select("id", F.coalesce("found", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("found").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    alone = named.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.union(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings
), n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE ok),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = r.vec_id) AS n_links, min(c) AS component_id, vec_id = min(c) AS kept FROM r GROUP BY vec_id
"""
