"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size says how many copies each of its documents gets on average: a whole part that all get,
and a fraction. The fractions are rounded in pairs: of two documents one gives up mass to the other, chosen so that the
expected words of each and the sum of both stay, until one of the two is a whole number. What remains of a block of
documents is one residual; residuals of blocks meet in the next level's blocks, up to one a source, which a draw
settles. The last residual is mostly one of the longest documents, so what its draw adds or takes is then made good by
turning over a few shorter documents that fit into the gap. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: How many documents of a source, about, are looked through for some that fill its last gap.
FILLERS = 2000
#: How many of a source's largest units are tried, one at a time, on the other side.
FIRST = 8
#: Of how many units any two may be turned at once.
SWAPS = 64
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """sources (source, source_size) and each one's target.

    In code point order, null last, the sources take the weights in turn and share out all sizes; no target is above
    `most` times its source's size, and what that leaves over is shared by weight among the others. One row per source
    stands in one window: this is a table of sources, not of documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = sources.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    full, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    # filling up to a common level: the first source that the level does not fill, if all before it are full, sets it
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(full), F.lit(0.0))) / F.sum("w").over(rest)
    levels = weighed.withColumn("level", level).withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    least = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), F.col("level").alias("level")))).over(every)
    return levels.withColumn("share", F.coalesce(least["level"] * F.col("w"), F.col("cap"))).select("source", "source_size", F.least("cap", "share").alias("target"))


def _draw(seed: int, *of: Column) -> Column:
    """Uniform in [0, 1), the same at every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11) / F.lit(float(1 << 53))


def _settle(state: Column, x: Column, seed: int) -> Column:
    """One step: the residual meets the next unit; one of them becomes whole and joins `done`."""
    cur = state["cur"]
    p, q, r = cur["p"], x["p"], x["size"] / cur["size"]
    up, down = F.least(1 - p, q * r), F.least(p, (1 - q) * r)
    rise = _draw(seed, cur["key"], x["key"]) * (up + down) < down

    def unit(of: Column, mass: Column) -> Column:
        return F.struct(of["key"].alias("key"), of["unit"].alias("unit"), of["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), mass)).alias("p"))

    def step(done: Column, mass: float, rest: Column, left: Column) -> Column:
        return F.struct(unit(rest, left).alias("cur"), F.concat(state["done"], F.array(unit(done, F.lit(mass)))).alias("done"))

    return (
        F.when(rise & (1 - p <= q * r), step(cur, 1.0, x, q - (1 - p) / r))
        .when(rise, step(x, 0.0, cur, p + q * r))
        .when(p <= (1 - q) * r, step(cur, 0.0, x, q + p / r))
        .otherwise(step(x, 1.0, cur, p - (1 - q) * r))
    )


def dependent_round(units: DataFrame, seed: int = 7, block: int = 64) -> DataFrame:
    """(unit, up): for units (grp, key, unit, size > 0, 0 <= p <= 1) whether each is rounded up.

    key must tell the units of a group apart. The sum of size * p over a group's rounded units differs from that of the
    given ones by less than one size. Groups of any size are cut into blocks of about `block` by the key's hash.
    """
    counts = units.groupBy("grp").agg(F.count("*").alias("n"))
    spread = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long")
    at = units.join(counts.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
        "grp", spread.alias("blocks"), F.pmod(F.xxhash64(F.lit(seed), "key"), spread).alias("block"), F.struct("key", "unit", F.col("size").cast("double").alias("size"), F.col("p").cast("double").alias("p")).alias("u")
    )
    settled = []
    while True:
        folded = at.groupBy("grp", "blocks", "block").agg(F.array_sort(F.collect_list("u")).alias("us"))
        first = F.struct(F.col("us")[0].alias("cur"), F.slice("us", 1, 0).alias("done"))
        state = F.aggregate(F.slice("us", 2, F.greatest(F.size("us") - 1, F.lit(0))), first, lambda s, x: _settle(s, x, seed))
        folded = common.stored(folded.select("grp", "blocks", "block", state.alias("s")), "folded")
        settled.append(folded.select(F.explode("s.done").alias("u")))
        above = folded.select("grp", F.ceil(F.col("blocks") / block).cast("long").alias("above"), "blocks", F.floor(F.col("block") / block).alias("block"), F.col("s.cur").alias("u"))
        settled.append(above.filter("blocks = 1").select(F.struct("u.key", "u.unit", "u.size", F.when(_draw(seed, F.col("u.key")) < F.col("u.p"), 1.0).otherwise(0.0).alias("p")).alias("u")))
        if not above.filter("blocks > 1").limit(1).count():
            break
        at = above.filter("blocks > 1").select("grp", F.col("above").alias("blocks"), "block", "u")
    out = settled[0]
    for x in settled[1:]:
        out = out.union(x)
    return out.select("u.unit", (F.col("u.p") >= 0.5).alias("up"))


def _turned(settled: DataFrame, seed: int) -> DataFrame:
    """(id, source, size) of the units to turn over so that each source's words come nearest to its target.

    Looked through are about FILLERS units of a source, drawn by hash. Twice, those that close the gap are turned by falling
    size as long as they fit, as the gap is or would be with one of the FIRST largest turned over before, whichever leaves
    less, and then the one or two, of SWAPS units, that leave the least of it, in either direction.
    """
    weight = F.col("size") * F.col("m")
    got = settled.groupBy("source").agg(F.sum((F.col("whole") + F.col("up").cast("long")) * weight).alias("got"), F.first("target").alias("aim"), F.count("*").alias("n"))
    gaps = got.select(F.col("source").alias("s"), (F.col("aim") - F.col("got")).alias("gap"), "n").filter(F.abs("gap") >= 1)
    met = settled.filter("open").drop("target").join(common.small(gaps), F.col("source").eqNullSafe(F.col("s")))
    some = met.filter(_draw(seed + 1, F.col("id"), F.col("size")) * F.col("n") < FILLERS)
    # e: how many words turning the unit over adds
    one = F.struct((-weight).alias("less"), _draw(seed + 2, F.col("id"), F.col("size")).alias("draw"), F.when(F.col("up"), -weight).otherwise(weight).alias("e"), "id", "size")
    now = some.groupBy("source").agg(F.array_sort(F.collect_list(one)).alias("rest"), F.first("gap").alias("left")).withColumn("taken", F.filter("rest", lambda u: F.lit(False)))
    fits = lambda u, left: (F.signum(u["e"].cast("double")) == F.signum(left)) & (F.abs(u["e"]) <= F.abs(left))
    step = lambda a, u: F.when(fits(u, a["left"]), F.struct((a["left"] - u["e"]).alias("left"), F.concat(a["taken"], F.array(u)).alias("taken"))).otherwise(a)
    none = F.filter("rest", lambda u: F.lit(False))
    for _ in range(2):  # one row a source; each step is stored, or else the next would work it out again at every mention
        plain = F.aggregate("rest", F.struct(F.col("left").alias("left"), F.col("taken").alias("taken")), step)
        begun = lambda u: F.struct((F.col("left") - u["e"]).alias("left"), F.concat("taken", F.array(u)).alias("taken"))
        other = F.transform(F.slice("rest", 1, FIRST), lambda u: F.aggregate(F.filter("rest", lambda x: x["draw"] != u["draw"]), begun(u), step))
        ranked = F.transform(F.concat(F.array(plain), other), lambda x: F.struct(F.abs(x["left"]).alias("open"), x["left"].alias("left"), x["taken"].alias("taken")))
        now = common.stored(now.select("source", "rest", F.array_min(ranked).alias("s")), "gaps")
        now = now.select("source", "s.left", "s.taken", F.array_except("rest", "s.taken").alias("rest"))
        now = common.stored(now.withColumn("few", F.slice(F.array_sort(F.transform("rest", lambda u: F.struct(u["draw"].alias("draw"), u.alias("u")))), 1, SWAPS)), "gaps")
        pairs = F.flatten(F.transform("few", lambda a: F.transform("few", lambda b: F.struct(F.abs(F.col("left") - a["u"]["e"] - F.when(a["draw"] == b["draw"], 0).otherwise(b["u"]["e"])).alias("open"), a["u"].alias("a"), b["u"].alias("b")))))
        now = common.stored(now.select("source", "left", "taken", "rest", F.array_min(pairs).alias("best")), "gaps")
        turned = F.when(F.col("best.open") < F.abs("left"), F.array_distinct(F.array("best.a", "best.b"))).otherwise(none)
        now = common.stored(now.select("source", "left", "taken", "rest", turned.alias("turned")), "gaps")
        now = now.select("source", F.aggregate("turned", F.col("left"), lambda a, u: a - u["e"]).alias("left"), F.concat("taken", "turned").alias("taken"), F.array_except("rest", "turned").alias("rest"))
    taken = now.select("source", F.explode("taken").alias("u"))
    return taken.select(F.col("source").alias("t_source"), F.col("u.id").alias("t_id"), F.col("u.size").alias("t_size"), F.lit(True).alias("turn"))


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7, block: int = 64) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), one row per row of df.

    size is the text's number of words (null and empty: 0); taken = copies * size. Copies are at most `most`, rounded
    up. A document without words, and all of a source without words, gets the copies that its source's whole part gives
    and takes 0 words. Rows that repeat an id within a source, at one size, are one unit: all get the same copies. Null
    ids and sources are values like others. Other columns are not looked at; an empty table gives an empty result.

    A source's taken words miss its target by less than its smallest unit that could still be turned over, mostly by far
    less; a source of a few documents misses it by what no one or two of them can close.
    """
    docs = common.stored(df.select(F.col(id).cast("long").alias("id"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size")).groupBy("id", "source", "size").agg(F.count("*").alias("m")), "sizes")
    sources = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    aims = common.stored(targets(sources, weights, most), "targets").withColumnRenamed("source", "s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = docs.join(aims, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("whole", F.floor(rate)).withColumn("p", rate - F.floor(rate))
    unit = F.struct("id", "source", "size", "m", "source_size", "target", "whole", ((F.col("p") > 0) & (F.col("size") > 0)).alias("open"))
    weighed = aimed.filter("size > 0").select(F.col("source").alias("grp"), F.struct("id", "size").alias("key"), unit.alias("unit"), (F.col("size") * F.col("m")).alias("size"), "p")
    done = dependent_round(weighed, seed, block).union(aimed.filter("size = 0").select(unit.alias("unit"), F.lit(False).alias("up")))
    settled = common.stored(done.select("unit.*", "up"), "settled")
    turned = common.stored(_turned(settled, seed), "turned")
    same = F.col("source").eqNullSafe(F.col("t_source")) & F.col("id").eqNullSafe(F.col("t_id")) & (F.col("size") == F.col("t_size"))
    up = F.col("up") != F.coalesce("turn", F.lit(False))
    rows = settled.join(common.small(turned), same, "left").withColumn("copies", F.col("whole") + up.cast("long"))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return rows.select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: each row of df as often as it is taken, with df's own columns.

    The copies are broadcast while the documents that have any are few; beyond that texts are shuffled to them.
    """
    units = common.stored(mix(df, id, text, source, **how).filter("copies > 0").select("id", "source", "size", "copies").distinct(), "copies")
    each = common.small(units.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("id", "source", "size"))
    same = df[id].cast("long").eqNullSafe(each["id"]) & df[source].cast("string").eqNullSafe(each["source"]) & (words(df[text]) == each["size"])
    return df.join(each, same).select(*[df[c] for c in df.columns])


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    done = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")
