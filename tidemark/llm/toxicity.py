"""Toxic passages by maximum-scoring segments.

Tokens get log-odds of standing in a toxic text, smoothed by a chain of Dirichlet priors: a word's prior is what its
longest known prefix says, a prefix's what the next shorter one says, and the shortest's the overall rate. Each token's
score is its log-odds less a cost, so text without signal falls. One pass over a text finds every maximal segment, the
passages that no longer or shorter neighbour outscores. Under the scores' distribution in clean text, a segment's
score follows an extreme-value law (parameters lambda and K); that gives each passage its expected number by chance,
and the text a statistic that a logistic curve, fitted on labelled texts that the log-odds have not seen, turns into a
probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Prefix lengths that back a word up, shortest first.
PREFIXES = (3, 4, 5, 6)
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
MEMO = 400_000


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


@dataclass
class Model:
    """odds: natural log-odds against the overall rate, by feature (a prefix with `*`, or a word); a word's longest known feature counts."""

    odds: dict[str, float]
    cost: float = 0.5
    lam: float = 1.0
    k: float = 0.1
    slope: float = 1.0
    offset: float = 0.0
    alone: float = 0.0
    significant: float = 1e-3

    def scorer(self):
        odds, cost, known = self.odds, self.cost, {}

        def of(word: str) -> float:
            s = known.get(word)
            if s is None:
                s = odds.get(word)
                for n in reversed(PREFIXES):
                    if s is not None:
                        break
                    if len(word) >= n:
                        s = odds.get(word[:n] + "*")
                s = (s or 0.0) - cost
                if len(known) >= MEMO:
                    known.clear()
                known[word] = s
            return s

        return of

    def passages(self, words: list[str], of) -> list[tuple[int, int, float, float]]:
        """(first token, token after the last, score, expected number by chance) of every significant passage."""
        n = max(1, len(words))
        found = []
        for start, end, score in segments(np.fromiter(map(of, words), float, len(words))):
            expected = self.k * n * math.exp(-self.lam * score)
            if expected <= self.significant:
                found.append((start, end, score, expected))
        return found

    def statistic(self, words: list[str], of) -> float:
        """How far the passages together exceed chance: the sum of -ln(expected number), at least 0."""
        n = max(1, len(words))
        return sum(max(0.0, self.lam * s - math.log(self.k * n)) for _, _, s in segments(np.fromiter(map(of, words), float, len(words))))

    def probability(self, statistic: float) -> float:
        x = self.slope * math.log1p(statistic) + self.offset if statistic > 0 else self.alone
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    Only tokens with a positive score can start one, and runs of others between them matter by their sum. Candidates
    are kept with the running totals before and after them; a new one joins back to the nearest earlier one that began
    lower, if that one ended lower than it does.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []  # [start, end, total before, total after, the nearest earlier candidate that began lower, or -1]
    for at in np.flatnonzero(scores > 0).tolist():
        cur = [at, at + 1, total[at], total[at + 1], -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= cur[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= cur[3]:
                cur[4] = j
                stack.append(cur)
                break
            cur = [stack[j][0], cur[1], stack[j][2], cur[3], -1]
            del stack[j:]
    return [(s, e, float(b - a)) for s, e, a, b, _ in stack]


def _features(text: str) -> set[str]:
    words = set(tokens(text))
    return words.union(*({w[:n] + "*" for w in words if len(w) >= n} for n in PREFIXES)) if words else words


def _count(batches):
    for b in (part for b in batches for part in common.sliced(b, 0, 4 << 20)):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for f in _features(text or ""):
                counts.setdefault(f, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (1, 0))], ["feature", "toxic", "clean"])


def log_odds(texts: DataFrame, alpha: float | None = None, least: float = 2.0, shift: float = 1.0) -> dict[str, float]:
    """Features' log-odds against the overall rate, from labelled texts (text, toxic: 0 or 1).

    A feature counts once a text. alpha is the priors' weight in texts, a quarter of the toxic texts between 2 and 20 if it
    is not given. A feature that differs from what its prefix says by less than `shift`, or that speaks for toxicity against
    a clean prefix by less than `least` standard errors of its own, says what the prefix says, and so needs no entry. All
    others are in the model, which the bounded number of labelled texts bounds.
    """
    n = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return {}
    rate = n[1] / (n[0] + n[1])
    alpha = min(20.0, max(2.0, n[1] / 4)) if alpha is None else alpha
    counts = texts.select(F.col("text"), F.col("toxic").cast("int").alias("toxic")).mapInArrow(common.frugal(_count), "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = common.stored(counts.withColumn("stem", F.regexp_replace("feature", r"\*$", "")).withColumn("size", F.when(F.col("feature").endswith("*"), F.length("stem")).otherwise(0)), "features")

    def posterior(own: DataFrame, up: str, prefixes: DataFrame | None) -> DataFrame:
        own = own.withColumn("prior", F.lit(rate)) if prefixes is None else own.withColumn("up", F.expr(up)).join(prefixes.select(F.col("stem").alias("up"), F.col("p").alias("above")), "up", "left").withColumn("prior", F.coalesce("above", F.lit(rate)))
        return own.select("feature", "stem", "toxic", "clean", "prior", ((F.col("toxic") + F.lit(alpha) * F.col("prior")) / (F.col("toxic") + F.col("clean") + F.lit(alpha))).alias("p"))

    prefixes = level = None
    for k in PREFIXES:
        level = posterior(counts.filter(F.col("size") == k), f"substring(stem, 1, {k - 1})", level)
        prefixes = level if prefixes is None else prefixes.union(level)
    every = prefixes.union(posterior(counts.filter("size = 0"), f"substring(stem, 1, {PREFIXES[-1]})", prefixes))
    logit = lambda c: F.log(F.col(c) / (1 - F.col(c)))
    # the variance of a posterior log-odds, from its counts with the prior's
    error = F.sqrt(1 / (F.col("toxic") + F.lit(alpha) * F.col("prior")) + 1 / (F.col("clean") + F.lit(alpha) * (1 - F.col("prior"))))
    gain = logit("p") - logit("prior")
    sure = (F.col("prior") > 0.5) | (gain >= F.lit(least) * error)
    kept = every.filter((gain <= -shift) | ((gain >= shift) & sure))
    return {r.feature: r.odds for r in kept.select("feature", (logit("p") - F.lit(math.log(rate / (1 - rate)))).alias("odds")).collect()}


def _solve(counts: dict[float, int], step: float) -> float:
    """lambda > 0 at which the mean of exp(lambda * score) is 1; one more of the best score keeps it finite."""
    top = max(1.0, *counts)
    x = np.array([*counts, top])
    p = np.array([*counts.values(), 1.0])
    p /= p.sum()
    if (p * x).sum() >= 0:
        return step
    low, high = 0.0, 1.0
    while (p * np.exp(high * x)).sum() < 1:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * x)).sum() < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset, by Newton steps on the slightly shrunk likelihood."""
    a = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(texts: DataFrame, check: DataFrame, cost: float = 0.5, most_texts: int = 200_000, **odds) -> Model:
    """A model from labelled texts (text, toxic): log-odds from `texts`, and from `check` the law of chance and the curve.

    Each of the two is thinned to about `most_texts` rows by a hash of the text if it has more; that is the bound of
    what training reads beyond a count, and of what the driver gets (three numbers a text of `check`). If `check` lacks
    a toxic text or a clean one with words, `texts` stand in for it. Labels that tell nothing apart (one class, none, no
    feature) give every text their smoothed rate, held below one half: without evidence no text is called toxic.
    """

    def bounded(df):
        n = df.count()
        return df if n <= most_texts else df.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * most_texts / n))

    texts, check = bounded(texts), bounded(check)
    labels = texts.select("toxic").union(check.select("toxic"))
    model = Model(log_odds(texts, **odds), cost)
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def look(batches):
        of = sent.value.scorer()
        for b in batches:
            labels, sizes, best, bins = [], [], [], {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = np.fromiter(map(of, tokens(text or "")), float)
                labels.append(toxic)
                sizes.append(len(s))
                best.append(max((x for _, _, x in segments(s)), default=0.0))
                if not toxic:
                    for v, n in zip(*np.unique(np.round(s, 1), return_counts=True)):
                        bins[float(v)] = bins.get(float(v), 0) + int(n)
            rows = [pa.array(labels + [-1] * len(bins), pa.int32()), pa.array(sizes + list(bins.values()), pa.int64()), pa.array(best + list(bins), pa.float64())]
            yield pa.RecordBatch.from_arrays(rows, ["label", "n", "x"])

    bins = {}
    for check in (check, texts) if model.odds else ():
        seen = common.stored(check.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(common.frugal(look), "label int, n long, x double"), "chance")
        bins = {r.x: r.n for r in seen.filter("label = -1").groupBy("x").agg(F.sum("n").alias("n")).collect()}
        if bins and seen.filter("label = 1").limit(1).count():
            break
    if not bins:
        n = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        rate = min(0.49, (n.get(1, 0) + 0.05) / (n.get(0, 0) + n.get(1, 0) + 1))
        model.slope, model.offset = 0.0, math.log(rate / (1 - rate))
        model.alone = model.offset
        return model
    model.lam = _solve(bins, 0.1)
    best = seen.filter("label = 0 AND n > 0").select("n", "x").toPandas()
    # the mean of the largest segment's score under the law is (ln(K n) + Euler's constant) / lambda
    if len(best):
        model.k = float(np.clip(np.exp((model.lam * best.x - np.log(best.n)).mean() - 0.5772156649), 1e-6, 1.0))
    sent_b = texts.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        m = sent_b.value
        of = m.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([m.statistic(tokens(t or ""), of) for t in b.column(0).to_pylist()], pa.float64())], ["label", "x"])

    pairs = check.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(common.frugal(measure), "label int, x double").toPandas()
    some, rest = pairs[pairs.x > 0], pairs[pairs.x == 0]
    if len(some):
        model.slope, model.offset = _logistic(np.log1p(some.x.to_numpy()), some.label.to_numpy(float))
    toxic = (rest.label.sum() + 0.05) / (len(rest) + 1)
    model.alone = math.log(toxic / (1 - toxic))
    return model


def score(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, passages), one row per row of df; passages: array of (start, end, score, expected), by token.

    Whole texts; null and empty ones have no passage and get the score of a text without signal. Repeated rows and null
    ids are kept as they are. Other columns are not looked at.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches):
        m = sent.value
        of = m.scorer()
        for b in batches:
            scores, found = [], []
            for t in b.column(1):
                words = tokens(t.as_py() or "")
                scores.append(m.probability(m.statistic(words, of)))
                found.append([dict(zip(("start", "end", "score", "expected"), p)) for p in m.passages(words, of)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], ["id", "score", "passages"])

    return df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(common.frugal(run), "id long, score double, passages array<struct<start: bigint, end: bigint, score: double, expected: double>>")


def keep_clean(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of df whose score is below the threshold, with all their columns; whole texts, no shuffle."""
    sent, at = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text)

    def run(batches):
        m = sent.value
        of = m.scorer()
        for b in batches:
            yield b.filter(pa.array([m.probability(m.statistic(tokens(t.as_py() or ""), of)) < threshold for t in b.column(at)], pa.bool_()))

    return df.mapInArrow(common.frugal(run), df.schema)


FOLDS, HELD, CURVE = 5, 0, 4


def fold(id) -> F.Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def trained(docs: DataFrame, labels: DataFrame, most_texts: int = 200_000) -> Model:
    """A model for documents (doc_id, text) from labels (doc_id, toxic), without those of the held-out fold.

    A document with several labels counts once, as toxic if any says so. At most about `most_texts` labels are used, chosen
    by a hash of the id. These ids, a few megabytes, are broadcast, so texts are not shuffled; the labelled texts are then
    written once to the shared folder.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(fold(F.col("doc_id")) != HELD)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > most_texts:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most_texts / n))
    rows = common.stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("text", "toxic", (fold(F.col("doc_id")) == CURVE).alias("curve")), "labelled")
    return fit(rows.filter("NOT curve").select("text", "toxic"), rows.filter("curve").select("text", "toxic"), most_texts=most_texts)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = score(docs, trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return done.select(F.col("id").alias("doc_id"), (fold(F.col("id")) == HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
