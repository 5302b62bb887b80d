import collections
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import words
from tidemark.llm import covertree, ctw, toxicity


def plain_segments(s):
    def best_of(a, b):
        best, at = 0.0, None
        for i in range(a, b):
            t = 0.0
            for j in range(i, b):
                t += s[j]
                if t > best + 1e-12 or at and abs(t - best) <= 1e-12 and j + 1 - i < at[1] - at[0]:
                    best, at = t, (i, j + 1)
        return [] if at is None else best_of(a, at[0]) + [(*at, best)] + best_of(at[1], b)

    return best_of(0, len(s))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-3.001, -2.51, -1.02, -0.73, 0.94, 1.35, 2.16, 4.07]), max_size=24), st.integers(0, 10**6))
def test_segments(s, seed):
    rng = random.Random(seed)
    s = [x + rng.random() * 1e-3 for x in s]
    assert [(a, b, round(x, 6)) for a, b, x in toxicity.segments(np.array(s))] == [(a, b, round(x, 6)) for a, b, x in plain_segments(s)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(f"{words(k, 40)} {'vilestem' + str(k % 9) if k % 8 == 0 else ''} {words(k + 5000, 20)}", int(k % 8 == 0)) for k in range(700)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    return toxicity.fit(df.limit(500), df)


def test_toxicity_learns_stems_and_scores_awkward_rows(spark, awkward, empty, model):
    rows = [(1, words(9001, 60)), (2, words(9002, 30) + " vilestemnew " + words(9003, 3000)), (3, None), (4, ""), (4, "")]
    got = [(r.id, r.score, r.passages) for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    by = {i: (s, p) for i, s, p in got}
    assert len(got) == 5 and by[2][0] > 0.5 and [(p.start, p.end) for p in by[2][1]] == [(30, 31)]
    assert all(0 <= by[k][0] < 0.1 and not by[k][1] for k in (1, 3, 4))
    assert toxicity.score(awkward, model).count() == awkward.count() and toxicity.score(empty, model).count() == 0
    clean = toxicity.keep_clean(awkward, model)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()


def test_toxicity_without_labels(spark, awkward, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = toxicity.score(awkward, toxicity.trained(awkward, labels)).collect()
    assert len(scores) == awkward.count() and all(0 <= r.score <= 1 for r in scores)


@pytest.mark.parametrize("kind", ["none", "clean", "toxic", "no clean curve"])
def test_toxicity_without_two_classes(spark, tmp_path, kind):
    """Labels that tell nothing apart drop nothing; where only the curve fold lacks a class, the others still teach."""
    import corpus_pipeline as cp

    rows = [(k, words(k, 60) + (" vilestem" if k % 4 == 3 else ""), "en", "s", 1) for k in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    curve = lambda k: zlib.crc32(str(k).encode()) % toxicity.FOLDS == toxicity.CURVE
    given = {"none": [], "clean": [(k, 1, 0) for k in range(160)], "toxic": [(k, 1, 1) for k in range(160)], "no clean curve": [(k, 1, int(k % 4 == 3)) for k in range(160) if k % 4 == 3 or not curve(k)]}[kind]
    spark.createDataFrame(given, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    model = toxicity.trained(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {r.doc_id for r in cp.clean(spark, docs, str(tmp_path)).collect()}
    assert kept == {k for k in range(160) if kind != "no clean curve" or k % 4 != 3}


def test_held_out_accuracy(spark):
    import os

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("needs the shared test tables")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r.predicted, labels[r.doc_id]) for r in toxicity.op4_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert len(got) > 300 and sum(p == y for p, y in got) / len(got) > 0.95


def vectors(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(160, 12))
    for k in range(60, 160):
        x[k] = x[k % 7] + rng.normal(size=12) * 0.05 * (k % 5)
    return x


@pytest.mark.parametrize("cell", [1024, 40, 12])
def test_vectors_against_plain(spark, cell):
    x = vectors(cell)
    rows = [(k, v.astype(np.float32).tolist(), k % 2) for k, v in enumerate(x)]
    rows += [(200, rows[3][1], 1), (201, rows[3][1], 1), (202, [2 * v for v in rows[3][1]], 1), (203, rows[3][1], 0), (None, rows[3][1], 1), (3, rows[3][1], 1)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 12, 1), (303, [1.0] * 11 + [float("nan")], 1), (304, [1.0] * 11 + [None], 1), (305, [1.0] * 11 + [float("inf")], 1), (306, rows[3][1], None), (307, [1.0, 2.0], 1), (308, [2.0, 4.0], 1), (309, [-0.0, 1.0], 1), (310, [0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], "vec_id long, embedding array<float>, label int, rep long, key string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in covertree.near_vectors(df, cell=cell).collect()), key=repr)
    good = lambda v: v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    cos = lambda a, b: np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b)))
    arr = [np.array(v, np.float32).astype(float) if good(v) and lab is not None else None for _, v, lab in rows]
    link = [[j != i and arr[i] is not None and arr[j] is not None and rows[i][2] == rows[j][2] and len(arr[i]) == len(arr[j]) and (np.array_equal(arr[i], arr[j]) or cos(arr[i], arr[j]) >= 0.98) for j in range(len(rows))] for i in range(len(rows))]
    group = list(range(len(rows)))
    for _ in range(12):
        for i in range(len(rows)):
            for j in range(len(rows)):
                if link[i][j]:
                    group[i] = group[j] = min(group[i], group[j])
    want = []
    for i, (v, _, _) in enumerate(rows):
        c = min((rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None), default=None)
        want.append((v, sum(link[i]), c, v == c))
    assert got == sorted(want, key=repr)
    assert covertree.near_vectors(df.limit(0)).count() == 0


def plain_ctw(train, depth):
    node = collections.defaultdict(lambda: [0, 0])
    bits = lambda b: [((1 << (7 - k)) | (b >> (k + 1)), (b >> k) & 1) for k in range(7, -1, -1)]
    whole = lambda w: b"\n" * depth + b" ".join(w) + b"\n"
    for w in train:
        s = whole(w)
        for p in range(depth, len(s)):
            for n, b in bits(s[p]):
                for d in range(depth + 1):
                    node[s[p - d : p], n][b] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    below, weight = collections.defaultdict(float), {}
    for (c, n), (a, b) in sorted(node.items(), key=lambda x: -len(x[0][0])):
        own = kt(a, b)
        pw, weight[c, n] = own, 1.0
        if len(c) < depth:
            m = below[c, n]
            pw = max(own, m) + math.log((math.exp(own - max(own, m)) + math.exp(m - max(own, m))) / 2)
            weight[c, n] = 0.5 * math.exp(own - pw)
        if c:
            below[c[1:], n] += pw

    def one(c, n, d=0):
        q = c[len(c) - d :]
        if (q, n) not in node:
            return 0.5
        a, b = node[q, n]
        p = (b + 0.5) / (a + b + 1)
        return p if d == depth else weight[q, n] * p + (1 - weight[q, n]) * one(c, n, d + 1)

    def log10(w):
        s = whole(w)
        return sum(math.log10(p if b else 1 - p) for k in range(depth, len(s)) for n, b in bits(s[k]) for p in [one(s[k - depth : k], n)])

    return log10


@pytest.mark.parametrize("depth, broadcast", [(2, 1 << 21), (3, 40), (0, 5)])
def test_ctw_against_plain(spark, depth, broadcast):
    texts = [(k, words(k % 23, 5 + k % 7)) for k in range(60)] + [(60, None), (61, ""), (62, " É\t漢 A"), (None, "x y"), (63, words(1, 400)), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(i, t, 1, 2.0, "z") for i, t in texts], "doc_id long, text string, train int, value double, row string")
    got = sorted(((r.id if r.id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, r.held_out, r.base_score, r.score) for r in ctw.score(df, depth=depth, broadcast=broadcast).collect()))
    toks = [(i, (t or "").encode().lower().split()) for i, t in texts]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = collections.Counter(x for i, w in toks if not held(i) for x in [*w, None])
    n, v = sum(count.values()), len(count)
    score = plain_ctw([w for i, w in toks if not held(i)], depth)
    want = sorted((-1 if i is None else i, len(w) + 1, sum(x in count for x in [*w, None]), n, held(i), sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None]), score(w)) for i, w in toks)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-8)


def test_ctw_without_training_and_empty(spark):
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    got = ctw.score(spark.createDataFrame([(k, "ab c") for k in held], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.score == pytest.approx(-40 * math.log10(2)) for r in got) and len(got) == 3
    assert ctw.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    docs = [(k, words(k // 2 if k < 20 else k, 60) + (" vilestem" if k % 8 == 3 else ""), "en", f"s{k % 4}", 1) for k in range(240)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k % 8 == 3)) for k in range(20, 240)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    x, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = x.columns
    for name, stage in cp.STAGES:
        out = stage(spark, x, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        x = spark.read.parquet(str(tmp_path / name))
        seen.append(x)
    toxic, unique, mixed, coded = seen
    assert toxic.columns == unique.columns == mixed.columns == columns
    assert {r.doc_id for r in toxic.collect()} == {k for k in range(240) if k % 8 != 3}
    ids = {r.doc_id for r in unique.collect()}
    assert ids == {k for k in range(240) if k % 8 != 3 and not (k < 20 and k % 2 and (k - 1) % 8 != 3)}
    assert {r.doc_id for r in mixed.collect()} <= ids
    assert sorted(r.doc_id for r in coded.collect()) == sorted(r.doc_id for r in mixed.collect())
    assert cp.run(spark, str(tmp_path)).count() == coded.count()
