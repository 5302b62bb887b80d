"""SimHash near-duplicates through a Gray-order hierarchical index.

Two fingerprints that differ in at most `bits` places agree on some choice of whole blocks, so each fingerprint goes
to one bucket per choice (the index's uppermost nodes: a mask and the pattern that all below share). In a bucket the
fingerprints are sorted by Gray rank, which puts patterns with long common parts side by side; runs of them become
nodes that keep the bits all members share, and runs of nodes become upper nodes. A search walks node pairs downwards
and drops a pair as soon as the differences accumulated on the shared bits exceed the limit. What a task returns is
each fingerprint's link to the smallest one that it reaches there, so a group of g copies costs g rows, not g * g.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SEED = 42
FAN = 16
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingles(text: bytes, words: int) -> list[bytes]:
    """Runs of `words` words; a shorter text is one shingle, a text without words has none."""
    found = text.lower().split()  # both know ASCII only: A-Z, and \x20 and \x09 to \x0d
    if not found:
        return []
    if len(found) < words:
        return [b" ".join(found)]
    return [b" ".join(x) for x in zip(*(found[k:] for k in range(words)))]


def fingerprint(text: bytes, words: int = 4, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's shingles; no word gives zero."""
    digest = xxhash.xxh64_intdigest
    return _majority(np.array([digest(x, seed) for x in shingles(text, words)], dtype="<u8"))


def _majority(h: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    if not len(h):
        return 0
    at = h.view(np.uint8).reshape(-1, 8) + 256 * np.arange(8, dtype=np.uint16)
    votes = np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * votes > len(h)).ravel(), bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): fp holds the fingerprint's 64 bits as a signed long. Null texts are empty ones: fingerprint zero."""

    def run(batches):
        for b in (part for b in batches for part in common.sliced(b, 1)):
            fp = np.array([fingerprint(x, words) for x in common.utf8(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(common.frugal(run), "id long, fp long")


def gray_rank(fp: Column) -> Column:
    """A pattern's place in Gray order, as 64 bits."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def block_masks(bits: int, n: int, target: int = 512) -> list[int]:
    """Masks of which any two fingerprints within `bits` share at least one, so wide that `n` random ones fill buckets of about `target`."""
    blocks = bits + 1
    while (64 * (blocks - bits) // blocks) < np.log2(max(n / target, 1)) and blocks < bits + 5:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(x) for x in combinations(own, blocks - bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class GrayIndex:
    """Hierarchical index over fingerprints given bucket by bucket in Gray order; nodes never straddle buckets."""

    def __init__(self, fp: np.ndarray, bucket_start: np.ndarray, fan: int = FAN):
        self.levels = []  # from the fingerprints up: (all-ones bits, any-ones bits, first child, number of children)
        one, some, starts = fp, fp, bucket_start
        while True:
            sizes = np.diff(np.append(starts, len(one)))
            owner, off = common.spans(-(-sizes // fan))
            first = starts[owner] + off * fan
            count = np.minimum(fan, starts[owner] + sizes[owner] - first)
            one, some = np.bitwise_and.reduceat(one, first), np.bitwise_or.reduceat(some, first)
            self.levels.append((one, some, first, count))
            starts = np.searchsorted(owner, np.arange(len(sizes)))
            if len(first) == len(sizes):
                return


def _paths(a: GrayIndex, x: np.ndarray, b: GrayIndex, y: np.ndarray, bits: int, own: bool, level: int, left: np.ndarray, right: np.ndarray, most: int = 1 << 18):
    """Linked pairs (positions) below pairs of nodes of one level."""
    if not len(left):
        return
    below = level < 0
    if not below:
        (one_a, some_a, first_a, count_a), (one_b, some_b, first_b, count_b) = a.levels[level], b.levels[level]
        shared = ~((one_a ^ some_a)[left] | (one_b ^ some_b)[right])
        keep = np.bitwise_count((one_a[left] ^ one_b[right]) & shared) <= bits
    else:
        keep = np.bitwise_count(x[left] ^ y[right]) <= bits
    left, right = left[keep], right[keep]
    if below:
        yield left, right
        return
    sizes = count_a[left] * count_b[right]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(left):  # in slices, so that what is expanded at once is bounded
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        owner, off = common.spans(sizes[at:to])
        l, r, k = left[at:to][owner], right[at:to][owner], count_b[right[at:to]][owner]
        i, j = first_a[l] + off // k, first_b[r] + off % k
        if own:
            fits = i < j if level == 0 else i <= j
            i, j = i[fits], j[fits]
        yield from _paths(a, x, b, y, bits, own, level - 1, i, j, most)
        at = to


def linked(fp: np.ndarray, bucket_start: np.ndarray, bits: int):
    """Pairs of positions within `bits` of each other in the same bucket; fp in Gray order by bucket."""
    index = GrayIndex(fp, bucket_start)
    top = np.arange(len(bucket_start))
    yield from _paths(index, fp, index, fp, bits, True, len(index.levels) - 1, top, top)


def linked_across(x: np.ndarray, y: np.ndarray, bits: int):
    """Pairs of positions (in x, in y) within `bits`; both in Gray order."""
    zero = np.zeros(1, dtype=np.int64)
    a, b = GrayIndex(x, zero), GrayIndex(y, zero)
    while len(a.levels) < len(b.levels):
        a.levels.append((a.levels[-1][0], a.levels[-1][1], zero, zero + 1))
    while len(b.levels) < len(a.levels):
        b.levels.append((b.levels[-1][0], b.levels[-1][1], zero, zero + 1))
    yield from _paths(a, x, b, y, bits, False, len(a.levels) - 1, zero, zero)


def _search(bits: int):
    def keys(t: pa.Table):
        return [t.column(k).to_numpy() for k in ("choice", "pattern", "low", "high")]

    def run(batches):
        for t in common.whole_groups(batches, lambda t: common.new_group(*keys(t))):
            fp = t.column("fp").to_numpy().view(np.uint64)
            low, high, part = (t.column(k).to_numpy() for k in ("low", "high", "part"))
            same = common.new_group(*keys(t))
            starts = np.flatnonzero(~same)
            crossed = low[starts] != high[starts]
            ends = np.append(starts[1:], len(fp))
            met = common.Union(len(fp))
            plain = np.repeat(~crossed, ends - starts)
            if plain.any():
                at = np.flatnonzero(plain)
                for i, j in linked(fp[at], np.flatnonzero(~same[at]), bits):
                    met.add(at[i], at[j])
            for s, e in zip(starts[crossed], ends[crossed]):
                l = s + np.flatnonzero(part[s:e] == low[s])
                r = s + np.flatnonzero(part[s:e] == high[s])
                if len(l) and len(r):
                    for i, j in linked_across(fp[l], fp[r], bits):
                        met.add(l[i], r[j])
            root = met.roots()
            far = np.flatnonzero(root != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[root[far]].view(np.int64)), pa.array(fp[far].view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, bits: int = 4, chunk: int = 1024, masks: list[int] | None = None) -> DataFrame:
    """(a, b): links that join exactly the fingerprints (column fp, no repeats) which chains of pairs within `bits` join.

    Buckets of more than `chunk` fingerprints are dealt out by pairs of parts, so no task holds more than about two
    chunks of one bucket, however many fingerprints share it, and every pair still meets.
    """
    if masks is None:
        masks = block_masks(bits, distinct.count())
    choices = F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("pattern")) for k, m in enumerate(masks)]))
    keyed = distinct.select("fp", choices.alias("c")).select("fp", "c.choice", "c.pattern")
    large = keyed.groupBy("choice", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
    k = F.ceil(F.coalesce("n", F.lit(1)) / chunk).cast("int")
    dealt = (
        keyed.join(large, ["choice", "pattern"], "left")
        .select("fp", "choice", "pattern", k.alias("k"), F.pmod(F.xxhash64("fp"), k).cast("int").alias("part"))
        .select("fp", "choice", "pattern", "part", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        .select("fp", "choice", "pattern", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    )
    tasks = dealt.repartition(common.parts(distinct.sparkSession), "choice", "pattern", "low", "high").sortWithinPartitions("choice", "pattern", "low", "high", gray_rank(F.col("fp")))
    return tasks.mapInArrow(common.frugal(_search(bits)), "a long, b long")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, bits: int = 4, chunk: int = 1024) -> DataFrame:
    """(id, fp, component_id), one row per row of df.

    Texts link when their fingerprints differ in at most `bits` bits; component_id is the smallest id reachable, the
    row's own included. Null and empty texts have fingerprint zero and link like any other. Repeated rows are kept and
    link with each other. A null id takes part but never names a component unless its component has no other: then
    component_id is null. Other columns are not looked at. An empty table gives an empty result.
    """
    prints = common.stored(fingerprints(df, id, text, words), "prints")
    classes = common.stored(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "classes")
    ends = common.components(fingerprint_links(classes.select("fp"), bits, chunk)).withColumnRenamed("id", "fp")
    return _named(prints, classes, ends, "fp").select("id", "fp", "component_id")


def _named(rows: DataFrame, classes: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """rows (id, key, ...) with component_id: the least id of all classes (key, rep, m) that `ends` puts together.

    A class of one row that links to nothing is its own component, so only the others are joined, and their hot keys
    and components are dealt to several tasks.
    """
    linked = common.stored(classes.join(ends, key).select(key, "rep", F.col("component").alias("c")), "linked")
    least = linked.groupBy("c").agg(F.min("rep").alias("component_id"))
    told = common.salted(linked, least, "c", key).select(key, "component_id")
    alone = classes.filter("m > 1").join(linked.select(key), key, "left_anti").select(key, F.col("rep").alias("component_id"))
    of = told.union(alone).withColumn("found", F.lit(True))
    return common.salted(rows, of, key, "id").withColumn("component_id", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id"))).drop("found")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def hashes(text: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """The set of a text's shingles as 64-bit hashes, ascending."""
    return np.unique(np.array([xxhash.xxh64_intdigest(x, seed) for x in shingles(text, words)], dtype=np.uint64))


def common_shingles(df: DataFrame, text: str, words: int, sample: int = 4_000, least: int = 4, most: int = 100_000) -> np.ndarray:
    """Hashes of shingles that many texts have, rarest first, judged by about `sample` texts.

    They only say which shingles `similar` looks at last. What is found does not depend on them.
    """
    n = df.count()
    some = df.select(F.col(text).cast("string").alias("text"))
    if n > sample:
        some = some.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * sample / n))

    def run(batches):
        for b in (part for b in batches for part in common.sliced(b, 0, 4 << 20)):
            found = np.concatenate([np.zeros(0, np.uint64), *(hashes(x, words) for x in common.utf8(b.column(0)))])
            h, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    often = some.distinct().mapInArrow(common.frugal(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    rows = often.orderBy(F.desc("n"), "h").limit(most).collect()
    return np.array([r.h for r in reversed(rows)], dtype=np.int64).view(np.uint64)


#: A text's shingle set as parity bits: about one bit a shingle, within these bounds; NEAR_BITS at most go along to buckets.
LEAST_BITS, MOST_BITS, NEAR_BITS = 64, 1 << 17, 512
#: Tokens that one task looks through for those which several texts have.
ENTRIES = 1_000_000
#: Members of a bucket that meet in one task; of a larger one, pairs of parts do.
PART = 512


def parity(h: np.ndarray) -> np.ndarray:
    """For each place the parity of the number of shingles that hash to it, as 64-bit words.

    Two sets whose parities differ in k places differ in at least k shingles. Half the places follow by folding.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, len(h)) - 1).bit_length()))
    odd = np.bincount((h % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _prefixes(words: int, late: np.ndarray):
    order = np.argsort(late)
    known = late[order]

    def run(batches):
        for b in (part for b in batches for part in common.sliced(b, 2, 4 << 20)):
            key, size, prints, bits, near, first = [], [], [], [], [], []
            for x in common.utf8(b.column(2)):
                h = hashes(x, words)
                rank = np.zeros(len(h), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    rank = np.where(known[at] == h, order[at] + 1, 0)
                key.append(xxhash.xxh64_intdigest(h.tobytes(), SEED))
                size.append(len(h))
                prints.append(_majority(h))
                bits.append(parity(h).view(np.int64))
                near.append(_folded(bits[-1], NEAR_BITS))
                first.append(h[np.lexsort((h, rank))][: len(h) - (4 * len(h) + 4) // 5 + 1].view(np.int64))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (key, prints)]
            rows = [b.column(0), b.column(1), longs[0], pa.array(size, pa.int32()), longs[1], *(pa.array(x, pa.list_(pa.int64())) for x in (bits, near, first))]
            yield pa.RecordBatch.from_arrays(rows, ["id", "th", "set", "n", "fp", "bits", "near", "first"])

    return run


def _folded(bits: np.ndarray, most: int) -> np.ndarray:
    """Parities over fewer places, which differ in no more of them."""
    while len(bits) > most // 64:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _entries(late: np.ndarray, buckets: int, spread: int):
    """(bucket, token, key, pos) as arrays: a class's first shingles dealt by hash, the common ones aside, since they need
    no second look, in buckets from `buckets` on."""
    common_ = np.sort(late)

    def run(batches):
        for b in batches:
            lists = b.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            token = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
            owner, pos = common.spans(lengths)
            key, h = b.column(0).to_numpy()[owner], token.view(np.uint64)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            if len(common_):
                known = common_[np.minimum(np.searchsorted(common_, h), len(common_) - 1)] == h
                bucket[known] = buckets + key[known] % spread
            order = np.argsort(bucket, kind="stable")
            starts = np.flatnonzero(~common.new_group(bucket[order]))
            ends = pa.array(np.append(starts, len(order)).astype(np.int32))
            cut = lambda x, t: pa.ListArray.from_arrays(ends, pa.array(x[order].astype(t)))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order][starts]), cut(token, np.int64), cut(key, np.int64), cut(pos, np.int32)], ["bucket", "token", "key", "pos"])

    return run


def _met(buckets: int):
    """(token, key, pos) of the tokens that stand in a bucket more than once, or that are known to be common."""

    def run(batches):
        for t in common.whole_groups(batches, lambda t: common.new_group(t.column("bucket").to_numpy()), 1):
            lengths = np.diff(t.column("token").combine_chunks().offsets.to_numpy())
            bucket = np.repeat(t.column("bucket").to_numpy(), lengths)
            token, key, pos = (t.column(k).combine_chunks().flatten().to_numpy() for k in ("token", "key", "pos"))
            _, back, n = np.unique(token, return_inverse=True, return_counts=True)
            keep = (bucket >= buckets) | (n[back] > 1)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, key, pos)], ["token", "key", "pos"])

    return run


def _inside(starts: np.ndarray, sizes: np.ndarray, most: int = 1 << 18):
    """All pairs of positions of the same group, in slices of about `most`; a row meets those behind it."""
    owner, off = common.spans(sizes)
    left, count = starts[owner] + off, sizes[owner] - off - 1
    ends = np.cumsum(count)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        o, k = common.spans(count[at:to])
        i = left[at:to][o]
        yield i, i + 1 + k
        at = to


def _near_pairs(t: pa.Table, starts: np.ndarray, sizes: np.ndarray, crossed: np.ndarray):
    """Pairs of positions in one group that are of different components and that no bound keeps below 0.8, with how far
    their parities differ against what 0.8 allows."""
    key, n, pos, c, part, low, high = (t.column(k).to_numpy() for k in ("key", "n", "pos", "c", "part", "low", "high"))
    lists = t.column("near").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.values.to_numpy().view(np.uint64)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    wide = int(lengths.max(initial=1))
    own = np.zeros((len(key), wide), np.uint64)
    owner, off = common.spans(lengths)
    own[owner, off] = flat
    half = np.zeros_like(own)
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        half[at, : max(1, size // 2)] = own[at, : size // 2] ^ own[at, size // 2 : size] if size > 1 else own[at, :1]
    for i, j in _inside(starts, sizes):
        most = np.minimum(n[i] - pos[i], n[j] - pos[j])
        on = (c[i] != c[j]) & (9 * most >= 4 * (n[i] + n[j])) & (~crossed[i] | (part[i] != part[j]))
        i, j = i[on], j[on]
        for s in range(0, len(i), 20_000):
            a, b = i[s : s + 20_000], j[s : s + 20_000]
            k = int(np.minimum(lengths[a], lengths[b]).max(initial=1))
            x, y = own[a, :k], own[b, :k]
            x = np.where((lengths[a] > lengths[b])[:, None], half[a, :k], x)
            y = np.where((lengths[b] > lengths[a])[:, None], half[b, :k], y)
            far = 9 * np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            both = n[a] + n[b]
            fits = far <= both
            yield a[fits], b[fits], far[fits] / both[fits]


def _bucket_pairs(forest: bool):
    """(token, a, b, cut): candidates (a < b, by key) of each bucket part: all of them, or as few as join what they join,
    the likeliest first; `cut` says that there were more."""

    def run(batches):
        keys = lambda t: [t.column(k).to_numpy() for k in ("token", "low", "high")]
        for t in common.whole_groups(batches, lambda t: common.new_group(*keys(t))):
            starts = np.flatnonzero(~common.new_group(*keys(t)))
            sizes = np.diff(np.append(starts, t.num_rows))
            token, low, high = keys(t)
            key, c = (t.column(k).to_numpy() for k in ("key", "c"))
            found = [x for x in _near_pairs(t, starts, sizes, low != high) if len(x[0])]
            if not found:
                continue
            i, j, far = (np.concatenate([x[k] for x in found]) for k in range(3))
            group, cut = np.repeat(np.arange(len(starts)), sizes), np.zeros(len(starts), bool)
            if forest:
                order = np.argsort(far, kind="stable")
                i, j = i[order], j[order]
                _, node = np.unique(np.stack([group, c], 1), axis=0, return_inverse=True)
                node = node.ravel()
                keep = _forest(node[i], node[j])
                dropped = np.ones(len(i), bool)
                dropped[keep] = False
                cut[group[i[dropped]]] = True
                i, j = i[keep], j[keep]
            else:  # tokens that two texts share stand for one pair
                _, once = np.unique(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], 1), axis=0, return_index=True)
                i, j = i[once], j[once]
            yield pa.RecordBatch.from_arrays([pa.array(token[i]), pa.array(np.minimum(key[i], key[j])), pa.array(np.maximum(key[i], key[j])), pa.array(cut[group[i]])], ["token", "a", "b", "cut"])

    return run


def _forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Places of the pairs that join two trees when taken in order."""
    parent, keep = {}, []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        while (p := parent.get(a, a)) != a:
            parent[a] = a = parent.get(p, p)
        while (p := parent.get(b, b)) != b:
            parent[b] = b = parent.get(p, p)
        if a != b:
            parent[b] = a
            keep.append(k)
    return np.array(keep, np.int64)


def _checked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b): the pairs whose sets of shingles have a Jaccard similarity of 0.8 or more, from the whole texts."""

    def run(batches):
        for b in (part for b in batches for part in common.sliced(b, 1, 4 << 20)):
            found = [hashes(x, words) for x in common.utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))], ["key", "set"])

    need = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    named = common.stored(classes.select("key", F.col("rep").alias("r"), F.col("th").alias("t")).join(need, "key", "left_semi"), "needed")
    rows = texts.join(common.small(named), F.col("id").eqNullSafe(F.col("r")) & (F.col("th") == F.col("t"))).select("key", "text")
    sets = common.stored(rows.mapInArrow(common.frugal(run), "key long, set array<bigint>").dropDuplicates(["key"]), "sets")
    both = pairs.join(sets.select(F.col("key").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("key").alias("a"), F.col("set").alias("x")), "a")
    good = common.stored(both.filter(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), "near")
    common.dropped(named, sets)
    return good


def similar(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, bits: int = 4) -> DataFrame:
    """(id, component_id), one row per row of df: texts link when the Jaccard similarity of their sets of `words`-word
    shingles is 0.8 or more, all such pairs that join something and no others; ids and components as in `near_duplicates`.

    Candidates come first from the Gray-order index, over fingerprints of the sets. No radius that an index can search
    holds all pairs of 0.8, so what it leaves apart meets again by shared shingles: two sets this similar share one of
    the first fifth of their shingles, in whatever order all texts follow. Pairs that lengths, places or parity bits show
    to be below 0.8 are dropped, the others are compared as whole sets. A bucket, or a part of a large one, first offers
    only as few pairs as could join its components. Where one of them turns out not to link, and across parts, all pairs
    still apart are offered, so no link is lost, and a group of g near copies costs a few times g comparisons, not g * g.
    """
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    late, parts = common_shingles(df, text, words), common.parts(df.sparkSession)
    prints = common.stored(texts.select("id", "th", "text").mapInArrow(common.frugal(_prefixes(words, late)), "id long, th long, set long, n int, fp long, bits array<bigint>, near array<bigint>, first array<bigint>"), "prefixes")
    sets = prints.groupBy("set").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("r"), F.count("*").alias("m"), *(F.first(c).alias(c) for c in ("n", "fp", "bits", "near", "first")))
    classes = common.stored(sets.select(F.monotonically_increasing_id().alias("key"), "set", F.col("r.id").alias("rep"), F.col("r.th").alias("th"), "m", "n", "fp", "bits", "near", "first"), "classes")
    ids = common.stored(prints.select("id", "set"), "ids")
    common.dropped(prints)

    lead = common.stored(classes.groupBy("fp").agg(F.min("key").alias("lead"), F.count("*").alias("sets")), "lead")
    hops = common.stored(fingerprint_links(lead.select("fp"), bits).select(F.col("a").alias("fp"), F.col("b").alias("other")), "hops")
    hops = common.stored(lead.select("fp", "lead").join(common.small(hops), "fp").select(F.col("other").alias("fp"), F.col("lead").alias("u")), "hops")
    hops = lead.select("fp", "lead").join(common.small(hops), "fp").select("u", F.col("lead").alias("v"))
    same = common.salted(classes.select("key", "fp"), lead.filter("sets > 1").select("fp", "lead"), "fp", "key", "inner").filter("key <> lead").select(F.col("lead").alias("u"), F.col("key").alias("v"))
    seen = common.stored(hops.union(same).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "offered")
    links = _checked(seen, classes, texts, words)

    total = classes.agg(F.sum(F.size("first"))).first()[0] or 0
    buckets = max(parts, -(-total // ENTRIES))
    entries = classes.select("key", "first").mapInArrow(common.frugal(_entries(late, buckets, parts)), "bucket int, token array<bigint>, key array<bigint>, pos array<int>")
    met = entries.repartition(min(2 * parts, buckets + parts), "bucket").sortWithinPartitions("bucket").mapInArrow(common.frugal(_met(buckets)), "token long, key long, pos int")
    shared = common.stored(met, "met")
    often = shared.groupBy("token").agg(F.ceil(F.count("*") / PART).cast("int").alias("k")).filter("k > 1")

    def offers(shared: DataFrame, links: DataFrame, forest: bool) -> DataFrame:
        ends = common.components(links).withColumnRenamed("id", "key")
        known = classes.select("key", "n", "near").join(common.small(ends), "key", "left").select("key", "n", "near", F.coalesce("component", "key").alias("c"))
        at = shared.join(known, "key").join(common.small(large), "token", "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("key"), F.col("k")).cast("int"))
        at = at.withColumn("other", F.col("part") if forest else F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        at = at.select("token", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "key", "n", "pos", "c", "near")
        dealt = at.repartition(parts, "token", "low", "high").sortWithinPartitions("token", "low", "high")
        return common.stored(dealt.mapInArrow(common.frugal(_bucket_pairs(forest)), "token long, a long, b long, cut boolean"), "offers")

    def good(offered: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What was offered and not seen before, and its links."""
        fresh = common.stored(offered.select("a", "b").distinct().join(seen, ["a", "b"], "left_anti"), "fresh")
        ends = [classes.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"x{k}")) for k in "ab"]
        both = fresh.join(ends[1], "b").join(ends[0], "a")
        likely = common.stored(both.filter(9 * _differ(F.col("xa"), F.col("xb")) <= F.col("na") + F.col("nb")).select("a", "b"), "likely")
        found = _checked(likely, classes, texts, words)
        common.dropped(likely)
        return fresh, found

    large = common.stored(often, "large")
    tried = offers(shared, links, True)
    fresh, found = good(tried)
    links, seen = common.stored(links.union(found), "links"), common.stored(seen.union(fresh), "seen")
    # a bucket that left pairs out is done if all that it offered link; else, and if it has parts, all its pairs are due
    due = tried.filter("cut").join(links, ["a", "b"], "left_anti").select("token").union(large.select("token")).distinct()
    again = common.stored(shared.join(common.small(common.stored(due, "due")), "token", "left_semi"), "again")
    rest = offers(again, links, False)
    links = common.stored(links.union(good(rest)[1]), "links")
    ends = common.components(links).withColumnRenamed("id", "key")
    common.dropped(shared, large, tried, fresh, again, rest)
    ends = classes.select("key", "set").join(ends, "key").join(classes.select(F.col("key").alias("component"), F.col("set").alias("c")), "component").select("set", F.col("c").alias("component"))
    return _named(ids, classes.select("set", "rep", "m"), ends, "set").select("id", "component_id")


def _differ(x: Column, y: Column) -> Column:
    """In how many places two parities differ, the longer one folded to the other's length."""
    half = lambda v: F.zip_with(F.slice(v, F.lit(1), (F.size(v) / 2).cast("int")), F.slice(v, (F.size(v) / 2).cast("int") + 1, (F.size(v) / 2).cast("int")), lambda a, b: a.bitwiseXOR(b))
    x, y = F.when(F.size(x) > F.size(y), half(x)).otherwise(x), F.when(F.size(y) > F.size(x), half(y)).otherwise(y)
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, n: a + n)


def _kept(df: DataFrame, found: DataFrame, id: str) -> DataFrame:
    """df's rows whose id is its own component's; what goes is broadcast while it is small, so texts need not move."""
    own = F.col("id").eqNullSafe(F.col("component_id"))
    gone = common.stored(found.groupBy("id").agg(F.bool_or(own).alias("stays")).filter("NOT stays").select("id"), "gone")
    return df.join(common.small(gone), df[id].cast("long").eqNullSafe(gone["id"]), "left_anti")


def keep_one(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that no near-duplicate with a smaller id stands for, with df's own columns.

    Of rows that repeat the kept id all stay; rows without an id stay only if nothing they link to has one.
    """
    return _kept(df, near_duplicates(df, id, text), id)


def keep_one_similar(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """As `keep_one`, with the links of `similar` in place of fingerprints."""
    return _kept(df, similar(df, id, text), id)
