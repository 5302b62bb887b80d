import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import common, simhash


def plain_print(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints, bits):
    group = list(range(len(ids)))
    for _ in ids:
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= bits:
                    group[i] = group[j] = min(group[i], group[j])
    return [min((ids[j] for j in range(len(ids)) if group[j] == group[i] and ids[j] is not None), default=None) for i in range(len(ids))]


def test_awkward_rows(spark, awkward):
    got = simhash.near_duplicates(awkward).collect()
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    prints = [plain_print(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], prints, plain_components([i for i, _ in rows], prints, 4)), key=repr)
    assert sorted(((r.id, r.fp % 2**64, r.component_id) for r in got), key=repr) == want
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i == c}


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("chunk, blocks", [(1024, 5), (8, 5), (8, 6), (16, 7)])
def test_links_are_whole(spark, chunk, blocks):
    """Random fingerprints, chains and a tight crowd, in one task a bucket or dealt out by parts."""
    rng = np.random.default_rng(chunk + blocks)
    fps = [int(x) for x in rng.integers(0, 2**63, 60)]
    for k in range(240):
        x = fps[int(rng.integers(len(fps)))] if k % 2 else fps[0]
        for b in rng.integers(0, 64, int(rng.integers(1, 6))):
            x ^= 1 << int(b)
        fps.append(x)
    fps = sorted(set(fps))
    masks = None
    if blocks > 5:
        edges = [64 * k // blocks for k in range(blocks + 1)]
        from itertools import combinations

        masks = [sum(x) for x in combinations([((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])], blocks - 4)]
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    ends = {r.id % 2**64: r.component for r in common.components(simhash.fingerprint_links(df, 4, chunk, masks)).collect()}
    want = plain_components(fps, fps, 4)
    name = {}
    for f, c in zip(fps, want):
        assert name.setdefault(c, ends.get(f, f)) == ends.get(f, f)
    assert len(set(name.values())) == len(name)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80, unique=True), st.integers(0, 12))
def test_index_finds_all_pairs(fps, bits):
    x = np.array(sorted(fps), dtype=np.uint64)
    got = {(int(a), int(b)) for i, j in simhash.linked(x, np.zeros(1, np.int64), bits) for a, b in zip(i, j)}
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if (int(x[i]) ^ int(x[j])).bit_count() <= bits}
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.lists(st.tuples(st.integers(0, 59), st.integers(0, 59)), max_size=120))
def test_local_roots(n, links):
    i, j = (np.array([x[k] % n for x in links], dtype=np.int64) for k in (0, 1))
    want = list(range(n))
    for _ in range(n):
        for a, b in zip(i, j):
            want[a] = want[b] = min(want[a], want[b])
    assert common.local_roots(n, i, j).tolist() == want
    met = common.Union(n, most=7)
    for a, b in zip(i, j):
        met.add(np.array([a]), np.array([b]))
    assert met.roots().tolist() == want


@pytest.mark.parametrize("few", [0, 1000])
def test_components_on_a_chain(spark, few):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (None, 3), (-5, -9)], "a long, b long")
    got = {r.id: r.component for r in common.components(chain, few=few).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, -5: -9, -9: -9}
    assert common.components(chain.limit(0), few=few).count() == 0


@pytest.mark.parametrize("part, few", [(512, None), (3, 0)])
def test_similar_against_plain_in_whole_buckets_and_in_parts(spark, monkeypatch, part, few):
    """Crowds of copies of copies, common passages and many sizes: the components of brute force, whatever the parts."""
    import random

    from tests.llm.conftest import words

    monkeypatch.setattr(simhash, "PART", part)
    if few is not None:
        monkeypatch.setattr(common, "FEW_LINKS", few)
    rng, texts = random.Random(part), []
    for base in range(3):
        family = [words(base + 50, 40 + 60 * base).split()]
        while len(family) < 40:
            w = list(rng.choice(family))
            for _ in range(rng.randrange(1, 3)):
                w[rng.randrange(len(w))] = f"y{rng.randrange(1000)}"
            family.append(w)
        texts += [" ".join(w) for w in family]
    passage = words(999, 30)
    texts += [f"{words(700 + k, 5 + k % 9)} {passage} {words(800 + k, k % 5)}" for k in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)]
    sets = [set(simhash.hashes(t.encode(), 5).tolist()) for t in texts]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    got = {r.id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(group))


def five_words(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_stage_drops_near_copies_from_jaccard_0_8(spark):
    """Planted copies at 0.8 to 0.97 go, those below stay; a chain, short texts and a crowd are as brute force says."""
    import random

    import corpus_pipeline
    from tests.llm.conftest import words

    rng = random.Random(5)
    rows = []
    for base in range(12):
        w = words(base + 300, 300).split()
        rows.append((base * 100, " ".join(w)))
        for k in (1, 2, 4, 6, 7, 9):
            v = list(w)
            for j in range(k):
                v[10 + 30 * j] = f"new{j}"
            rows.append((base * 100 + k, " ".join(v)))
    for k in range(90):
        w = (words(1, 12) + " " + words(2 + k % 4, 40)).split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(5)}"
        rows.append((5000 + k, " ".join(w[: 52 - rng.randrange(4)])))
    rows += [(6000 + k, t) for k, t in enumerate([None, "", "a b", "A  b", "a b c", "one two three four five six"])]
    sets = [five_words(t) for _, t in rows]
    group = list(range(len(rows)))
    near = [(i, j) for i in range(len(rows)) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    for i, j in near:
        low, high = sorted((group[i], group[j]))
        group = [low if g == high else g for g in group]
    want = {i for k, (i, _) in enumerate(rows) if group[k] == k}
    got = {r.doc_id for r in corpus_pipeline.dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert got == want
    assert not {b * 100 + k for b in range(12) for k in (1, 2, 4, 6)} & got
    assert sum(k in got for k in range(5000, 5090)) < 60
