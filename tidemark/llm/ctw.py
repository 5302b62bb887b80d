"""Language-model scores by context-tree weighting over bytes, beside a smoothed unigram base.

A text is its lower-cased words joined by one space, and an end byte. Every byte is eight binary decisions; each has a
tree of contexts (the bytes before, up to `depth`) whose nodes hold Krichevsky-Trofimov estimates from the training
texts, and every node mixes its own estimate with those of the longer contexts in proportion to how well each would
have coded the training bits. All depths are mixed; none is picked.

Counting reads the texts once. The trees are tables, one row a node, folded up (evidence of the longer contexts) and
walked down (mixed prediction) by joins, so they may be far larger than a machine. Scoring looks the commonest entries
up in a broadcast table of bounded size and joins the rest, so no entry is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

END = 10  # a line feed: no byte of a word, and not the space between words
#: Text worked on at once: some hundred bytes of arrays a byte.
SLICE_BYTES = 1 << 19
#: Distinct keys that a counting task holds before it hands them on.
HELD_KEYS = 800_000
#: Most entries of each kind that are broadcast, at 16 bytes: 32 MB. The others are joined.
BROADCAST = 1 << 21
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: The end's key; no word's sum is likelier to be this than any other 128-bit value.
END_KEY = (0, 0)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (an invertible multiply and shift chain)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different pair (a, b), and for every place which of these it is."""
    _, at, back = np.unique(a, return_index=True, return_inverse=True)
    if (b[at][back] != b).any():  # one a with two b
        _, at, back = np.unique(np.stack([a, b], 1), axis=0, return_index=True, return_inverse=True)
        back = back.ravel()
    return at, back


class Stream:
    """Texts as one array of bytes, with the grams and word keys of each.

    Before each text stand `depth` end bytes. A gram is a byte and the `depth` bytes before it, the oldest highest. A
    word's key has 128 bits: two sums of a hash of each byte with its place.
    """

    def __init__(self, texts: list[bytes], depth: int):
        start = bytes([END]) * depth
        clean = [b" ".join(t.lower().split()) for t in texts]
        self.lengths = np.array([len(c) + 1 for c in clean], dtype=np.int64)
        raw = np.frombuffer(b"".join([x for c in clean for x in (start, c, b"\n")]), dtype=np.uint8)
        ends = np.cumsum(self.lengths + depth)
        first = ends - self.lengths
        inside = np.ones(len(raw), dtype=bool)
        for k in range(1, depth + 1):
            inside[first - k] = False
        gram = raw.astype(np.uint64)
        for k in range(1, depth + 1):
            gram[k:] |= raw[:-k].astype(np.uint64) << np.uint64(8 * k)
        self.grams = gram[inside]
        self.text_of_gram = np.repeat(np.arange(len(texts)), self.lengths)
        # words: what stands between separators
        letter = (raw != 32) & (raw != END)
        edge = np.diff(letter.astype(np.int8), prepend=0)
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = stops - starts
        if len(starts):
            at = np.flatnonzero(letter)
            place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            part = _mix(((place.astype(np.uint64) << np.uint64(8)) | raw[at]) * _GOLDEN + np.uint64(1))
            first_of = np.cumsum(sizes) - sizes
            self.words, self.words2 = np.add.reduceat(part, first_of), np.add.reduceat(_mix(part ^ _GOLDEN), first_of)
        else:
            self.words = self.words2 = np.zeros(0, np.uint64)
        self.text_of_word = np.searchsorted(ends, starts, "right")


def _slices(batch: pa.RecordBatch, column: int):
    texts = common.utf8(batch.column(column))
    start = size = 0
    for k, t in enumerate(texts):
        if k > start and size + len(t) > SLICE_BYTES:
            yield start, texts[start:k]
            start, size = k, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


class _Counts:
    """Keys of two parts with two counts, added up part by part."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > 2 * HELD_KEYS:
            self.fold()

    def fold(self) -> None:
        key, key2, *counts = (np.concatenate([p[k] for p in self.parts] or [np.zeros(0, np.uint64)]) for k in range(4))
        at, back = _distinct(key, key2)
        sums = (np.bincount(back, x, len(at)).astype(np.int64) for x in counts)
        self.parts, self.n = [(key[at], key2[at], *sums)], len(at)

    def batch(self, kind: int) -> pa.RecordBatch:
        self.fold()
        key, key2, trained, total = self.parts[0]
        self.parts, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int8)), pa.array(key.view(np.int64)), pa.array(key2.view(np.int64)), pa.array(trained), pa.array(total)], ["kind", "key", "key2", "trained", "total"])


def _counter(depth: int):
    def run(batches):
        kinds = (_Counts(), _Counts())
        for b in batches:
            train = b.column(1).to_numpy(zero_copy_only=False)
            for at, texts in _slices(b, 0):
                s = Stream(texts, depth)
                mine = train[at : at + len(texts)]
                grams, n = np.unique(s.grams * np.uint64(2) + mine[s.text_of_gram], return_counts=True)
                kinds[0].add(grams >> np.uint64(1), np.zeros(len(grams), np.uint64), n * (grams & np.uint64(1)).astype(np.int64), n)
                known = mine[s.text_of_word]
                words, words2 = s.words[known], s.words2[known]
                at_, back = _distinct(words, words2)
                n = np.append(np.bincount(back, minlength=len(at_)), int(mine.sum()))
                kinds[1].add(np.append(words[at_], np.uint64(END_KEY[0])), np.append(words2[at_], np.uint64(END_KEY[1])), n, n)
                for k, counts in enumerate(kinds):
                    if counts.n > HELD_KEYS:
                        counts.fold()
                        if counts.n > HELD_KEYS:
                            yield counts.batch(k)
        for k, counts in enumerate(kinds):
            yield counts.batch(k)

    return run


def _log_gamma(x):
    """Stirling's series eight further on, and back by the recurrence; for a column or an array."""
    log = F.log if isinstance(x, Column) else np.log
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + series - log(product)


def _log_kt(a, b):
    """log of the estimate of a zeros and b ones, in any order."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)


class _Subtrees:
    """The nodes from `split` bytes of context down to `depth`, of all grams whose last `split` context bytes are here.

    A gram's eight decisions are nodes of its full context: the context's bytes, and a one with the bits decided so far.
    A node's parent has the same decision in a context that lacks the oldest byte.
    """

    def __init__(self, grams: np.ndarray, trained: np.ndarray, depth: int, split: int):
        byte, context = grams & np.uint64(255), grams >> np.uint64(8) << np.uint64(8)
        nodes = np.concatenate([context | np.uint64(1 << (7 - k)) | (byte >> np.uint64(k + 1)) for k in range(7, -1, -1)])
        self.bit = np.concatenate([(byte >> np.uint64(k)) & np.uint64(1) for k in range(7, -1, -1)]).astype(bool)
        n = np.tile(trained.astype(float), 8)
        keys, self.of = np.unique(nodes, return_inverse=True)
        a, b = np.bincount(self.of, n * ~self.bit, len(keys)), np.bincount(self.of, n * self.bit, len(keys))
        pw = _log_kt(a, b)
        self.levels = [(keys, a, b, pw, np.ones(len(keys)), None)]  # the last: where a level's nodes are in the one above
        for d in range(depth - 1, split - 1, -1):
            above, up = np.unique(keys & np.uint64((1 << (8 * d + 8)) - 1), return_inverse=True)
            self.levels[-1] = (*self.levels[-1][:5], up)
            a, b, below = (np.bincount(up, x, len(above)) for x in (a, b, pw))
            kt = _log_kt(a, b)
            high = np.maximum(kt, below)
            pw = high + np.log((np.exp(kt - high) + np.exp(below - high)) / 2)
            keys = above
            self.levels.append((keys, a, b, pw, np.exp(kt - pw) / 2, None))

    def values(self, nodes: np.ndarray, p1: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 of each gram's probability, given the mix down to the uppermost level here (nodes in order)."""
        at = np.searchsorted(nodes, self.levels[-1][0])
        p, r = p1[at], rest[at]
        for k in range(len(self.levels) - 2, -1, -1):
            _, a, b, _, w, up = self.levels[k]
            p, r = p[up] + r[up] * w * (b + 0.5) / (a + b + 1), r[up] * (1 - w)
        p = p[self.of]
        return np.log10(np.where(self.bit, p, 1 - p)).reshape(8, -1).sum(0)


#: Below this many context bytes, or more where they are too common, a subtree is worked on by one task.
SPLIT = 3
#: Most grams of one subtree, some 600 MB; with a whole context there are at most 256.
SUBTREE = 500_000


def gram_values(grams: DataFrame, depth: int, split: int = SPLIT, subtree: int = SUBTREE) -> DataFrame:
    """(key, value): log10 of the mixed probability of each gram's last byte after the others, from (key, trained).

    Every gram that is to be scored must be in the table, with 0 if no training text has it. Subtrees begin at the least
    number of context bytes, from `split` on, at which none has more than `subtree` grams.
    """
    spark, split = grams.sparkSession, min(split, depth)
    context = lambda c: F.shiftrightunsigned(c, 8).bitwiseAND(F.lit((1 << (8 * split)) - 1))
    while split < depth and (grams.groupBy(context(F.col("key")).alias("sub")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > subtree:
        split += 1

    def same(t: pa.Table):
        return common.new_group(t.column("sub").to_numpy())

    def dealt(rows):
        return rows.withColumn("sub", context(F.col("key"))).repartition(common.parts(spark), "sub").sortWithinPartitions("sub")

    def fold(batches):
        for t in common.whole_groups(batches, same):
            top = _Subtrees(t.column("key").to_numpy().view(np.uint64), t.column("trained").to_numpy(), depth, split).levels[-1]
            yield pa.RecordBatch.from_arrays([pa.array(top[0].view(np.int64)), *map(pa.array, top[1:5])], ["node", "a", "b", "pw", "w"])

    levels = [None] * (split + 1)
    levels[split] = common.stored(dealt(grams.select("key", "trained")).mapInArrow(common.frugal(fold), "node long, a double, b double, pw double, w double"), "level")
    for d in range(split - 1, -1, -1):
        up = F.col("node").bitwiseAND(F.lit((1 << (8 * d + 8)) - 1))
        own = levels[d + 1].groupBy(up.alias("node")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("below"))
        own = own.withColumn("kt", _log_kt(F.col("a"), F.col("b")))
        high = F.greatest("kt", "below")
        pw = high + F.log((F.exp(F.col("kt") - high) + F.exp(F.col("below") - high)) / 2)
        levels[d] = common.stored(own.withColumn("pw", pw).select("node", "a", "b", "pw", (F.exp(F.col("kt") - F.col("pw")) / 2).alias("w")), "level")
    one = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    top = levels[0].select("node", (F.col("w") * one).alias("p1"), (1 - F.col("w")).alias("rest"))
    for d in range(1, split + 1):
        above = top.select(F.col("node").alias("up"), F.col("p1").alias("p"), F.col("rest").alias("r"))
        up = F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1))
        top = levels[d].join(above, up == F.col("up")).select("node", (F.col("p") + F.col("r") * F.col("w") * one).alias("p1"), (F.col("r") * (1 - F.col("w"))).alias("rest"))

    def value(batches):
        for t in common.whole_groups(batches, same):
            trained = t.column("trained").to_numpy(zero_copy_only=False)
            gram = ~np.isnan(trained)
            key, p1, rest = (t.column(k).to_numpy(zero_copy_only=False) for k in ("key", "p1", "rest"))
            order = np.argsort(key[~gram].view(np.uint64))
            keys = key[gram].view(np.uint64)
            v = _Subtrees(keys, trained[gram], depth, split).values(key[~gram].view(np.uint64)[order], p1[~gram][order], rest[~gram][order])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(v)], ["key", "value"])

    none = F.lit(None).cast("double")
    both = grams.select("key", F.col("trained").cast("double").alias("trained"), none.alias("p1"), none.alias("rest")).union(top.select("node", none, "p1", "rest"))
    return dealt(both).mapInArrow(common.frugal(value), "key long, value double")


class Lookup:
    """Key to value for whole arrays: entries sorted by a mixed key, an index on its leading bits, short probes.

    A second part of the keys, where there is one, is compared too."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, more: np.ndarray | None = None):
        self.bits = max(1, int(len(keys)).bit_length())
        mixed = _mix(keys)
        order = np.argsort(mixed)
        self.keys, self.values, self.more = keys[order], values[order], None if more is None else more[order]
        self.start = np.searchsorted(mixed[order] >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray, more: np.ndarray | None = None) -> np.ndarray:
        """Positions, -1 where there is none."""
        slot = (_mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.flatnonzero(at < end)
        at = at[open_]
        while len(open_):
            hit = self.keys[at] == keys[open_]
            if self.more is not None:
                hit &= self.more[at] == more[open_]
            out[open_[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at < end[open_])
            open_, at = open_[on], at[on]
        return out


def _commonest(table: DataFrame, count: str, most: int) -> DataFrame:
    """At most `most` rows, those with the largest counts; a histogram of the counts' size sets the least."""
    size = F.floor(F.log2(F.col(count)) * 4)
    least, total = math.inf, 0
    for r in sorted(table.filter(F.col(count) > 0).groupBy(size.alias("s")).agg(F.count("*").alias("n")).collect(), reverse=True):
        total += r.n
        if total > most:
            break
        least = r.s
    return table.filter((F.col(count) > 0) & (size >= F.lit(float(least))))


def score(df: DataFrame, id: str = "doc_id", text: str = "text", depth: int = 5, fold: int = 5, held: int = 1, broadcast: int = BROADCAST) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bytes, bits_per_byte), one row per row of df.

    Training texts are those whose crc32 of the id as text, modulo `fold`, is not `held`. Null and empty texts have one
    token, the end; a null id counts as the empty text. Repeated rows are each counted and scored. base_score is the
    unigram's log10 probability, score the trees'; both are of the lower-cased words and the end. Without training texts
    the base is 0 and every bit costs one bit. Other columns are not looked at; an empty table gives an empty result.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), (F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % fold != held).alias("train"))
    counted = texts.select("text", "train").mapInArrow(common.frugal(_counter(depth)), "kind byte, key long, key2 long, trained long, total long")
    counts = common.stored(counted.groupBy("kind", "key", "key2").agg(F.sum("trained").alias("trained"), F.sum("total").alias("total")), "counts")
    words = counts.filter("kind = 1 AND trained > 0").select("key", "key2", F.col("trained").alias("c"))
    n, v = (x or 0 for x in words.agg(F.sum("c"), F.count("*")).first())
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    values = common.stored(gram_values(counts.filter("kind = 0").select("key", "trained"), depth).join(counts.filter("kind = 0").select("key", "total"), "key"), "values")

    def sent(table, count, value, most, *more):
        t = _commonest(table, count, most).select("key", value, *more).toArrow()
        return spark.sparkContext.broadcast((t.column(0).to_numpy().view(np.uint64), t.column(1).to_numpy(), *(t.column(2).to_numpy().view(np.uint64) for _ in more)))

    # a fixed part of the words, so that as much is left to join at every size
    hot_grams, hot_words = sent(values, "total", "value", broadcast), sent(words, "c", "c", min(broadcast, v // 8), "key2")

    def run(batches):
        grams, known = Lookup(*hot_grams.value), Lookup(*hot_words.value)
        worth = np.log10((known.values + 0.5) / (n + 0.5 * (v + 1)))
        end = int(known.find(*(np.full(1, k, np.uint64) for k in END_KEY))[0])
        for b in batches:
            for at, texts in _slices(b, 2):
                s = Stream(texts, depth)
                k = len(texts)
                g = grams.find(s.grams)
                found = g >= 0
                tree = np.bincount(s.text_of_gram[found], grams.values[g[found]], k)
                w = known.find(s.words, s.words2)
                hit = w >= 0
                line = np.bincount(s.text_of_word[hit], worth[w[hit]], k) + (worth[end] if end >= 0 else 0)
                tokens = np.bincount(s.text_of_word, minlength=k) + 1
                n_known = np.bincount(s.text_of_word[hit], minlength=k) + (end >= 0)
                whose, late, late2 = s.text_of_word[~hit], s.words[~hit], s.words2[~hit]
                if end < 0:
                    whose, late, late2 = np.append(whose, np.arange(k)), np.append(late, np.full(k, END_KEY[0], np.uint64)), np.append(late2, np.full(k, END_KEY[1], np.uint64))
                late_words, late_words2 = _lists(whose, late, k), _lists(whose, late2, k)
                late_grams = _lists(s.text_of_gram[~found], s.grams[~found], k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, k), b.column(1).slice(at, k), pa.array(tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)), pa.array(line.astype(float)), pa.array(tree.astype(float)), pa.array(s.lengths), late_words, late_words2, late_grams],
                    ["id", "train", "n_tokens", "n_known", "line", "tree", "bytes", "late_words", "late_words2", "late_grams"],
                )

    scored = texts.select("id", "train", "text").mapInArrow(common.frugal(run), "id long, train boolean, n_tokens long, n_known long, line double, tree double, bytes long, late_words array<long>, late_words2 array<long>, late_grams array<long>")
    scored = common.stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    late_w = scored.select("row", F.explode(F.arrays_zip(F.col("late_words").alias("key"), F.col("late_words2").alias("key2"))).alias("w")).select("row", "w.key", "w.key2").groupBy("row", "key", "key2").agg(F.count("*").alias("n"))
    late_w = late_w.join(words, ["key", "key2"], "left").select("row", F.when(F.col("c").isNull(), 0).otherwise(F.col("n")).alias("k"), (F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("l"), F.lit(0.0).alias("t"))
    late_g = scored.select("row", F.explode("late_grams").alias("key")).groupBy("row", "key").agg(F.count("*").alias("n"))
    late_g = late_g.join(values.select("key", "value"), "key").select("row", F.lit(0).cast("long").alias("k"), F.lit(0.0).alias("l"), (F.col("n") * F.col("value")).alias("t"))
    late = late_w.union(late_g).groupBy("row").agg(F.sum("k").alias("k"), F.sum("l").alias("l"), F.sum("t").alias("t"))
    none = F.lit(0)
    total = F.col("tree") + F.coalesce("t", none)
    return scored.drop("late_words", "late_words2", "late_grams").join(late, "row", "left").select(
        "id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("k", none)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("line") + F.coalesce("l", none)).alias("base_score"), total.alias("score"), "bytes", (-total / F.col("bytes") / F.lit(math.log10(2))).alias("bits_per_byte"),
    )


def _lists(owner: np.ndarray, keys: np.ndarray, n: int) -> pa.ListArray:
    order = np.argsort(owner, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order].view(np.int64)))


def op9_ctw(spark, sf_dir: str) -> DataFrame:
    done = score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
