"""The registered queries on the smallest tables: against their SQL, or against plain versions of what they define."""

import base64
import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import pytest
import xxhash

from tidemark.llm import media, simhash
from tidemark.llm.queries import ORACLES, QUERIES

SF, SF10 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the shared test tables")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def rows(found):
    return sorted((tuple(plain(v) for v in r) for r in found), key=repr)


def docs(spark, sf=SF):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    df = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel, cols = con.sql(ORACLES[name]), sorted(df.columns)
    assert sorted(rel.columns) == cols
    got = rows(df.select(cols).collect())
    assert got and got == rows(rel.select(", ".join(f'"{c}"' for c in cols)).fetchall())


def test_op1(spark):
    texts = docs(spark)
    got = QUERIES["op1_media"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = (texts[r.doc_id].text or "").encode()
        whole = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        stored = media.build(whole)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        (track,) = r.tracks
        assert track.n_samples == len(whole) // 192 and all(stored[k.offset : k.offset + k.size] == whole[k.sample * 192 : k.sample * 192 + 192] for k in track.keyframes)


def plain_targets(sizes):
    """Shares by weight, what is above three times a size given to the others until none is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("sf, share", [(SF, 0.05), (SF10, 0.001)])  # ten documents a source, then fifty
def test_op2(spark, sf, share):
    texts = docs(spark, sf)
    size = {i: len(WORD.findall((r.text or "").encode())) for i, r in texts.items()}
    per = collections.Counter()
    for i, r in texts.items():
        per[r.source] += size[i]
    want, got = plain_targets(per), QUERIES["op2_mixing"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    taken = collections.Counter()
    for r in got:
        s = texts[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], per[s]) and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s, aim in want.items():
        assert abs(taken[s] - aim) <= max(1, aim * share), (s, taken[s], aim)
    again = QUERIES["op2_mixing"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_op3(spark):
    texts = docs(spark)

    def mark(text):
        w = WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
        grams = [b" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: mark(r.text) for i, r in texts.items()}
    group = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for i in fp:
            for j in fp:
                if (fp[i] ^ fp[j]).bit_count() <= 4 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    got = QUERIES["op3_simhash"](spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{f:016x}", group[i]) for i, f in fp.items())


@pytest.mark.parametrize("sf, share", [(SF, 0.85), (SF10, 0.95)])
def test_op4(spark, sf, share):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}
    got = QUERIES["op4_toxicity"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs(spark, sf))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    right, majority = sum(p == y for p, y in held) / len(held), max(collections.Counter(y for _, y in held).values()) / len(held)
    assert right >= max(share, majority)


def test_op8(spark):
    import public_tokenizers as P
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    plain_bpe = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=load_tiktoken_bpe(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = docs(spark)
    for r in QUERIES["op8_byte_bpe"](spark, SF).collect():
        text = texts[r.doc_id].text or ""
        ids = plain_bpe.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op9(spark):
    texts = docs(spark)
    words = {i: [*WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (r.text or "").encode())), None] for i, r in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    count = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    got = QUERIES["op9_ctw"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words[r.doc_id]), sum(w in count for w in words[r.doc_id]), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def test_op10(spark):
    first = {}
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = QUERIES["op10_warc"](spark, SF).collect()
    want = [(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first[p] == i else "revisit", None if first[p] == i else first[p]) for i, p in pages.items()]
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)


def test_pipeline(spark, tmp_path):
    """Stage by stage against plain versions: what one stage gives is the next one's input."""
    import public_tokenizers as P
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    import corpus_pipeline as cp
    from tidemark.llm import mixing, toxicity

    x, given = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        given.append(x)
        stage(spark, x, SF).write.parquet(str(tmp_path / name))
        x = spark.read.parquet(str(tmp_path / name))
    given.append(x)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    model = toxicity.trained(given[0], spark.read.parquet(f"{SF}/labels.parquet"))
    of = model.scorer()
    clean = {r.doc_id for r in given[0].collect() if model.probability(model.statistic(toxicity.tokens(r.text or ""), of)) < 0.5}
    assert {r.doc_id for r in given[1].collect()} == clean
    assert sum(labels.get(i) == 0 for i in clean) >= 0.9 * sum(y == 0 for y in labels.values())
    sets = {r.doc_id: set(simhash.hashes((r.text or "").encode(), 5).tolist()) for r in given[1].collect()}
    group = {i: i for i in sets}
    for _ in range(20):
        for i in sets:
            for j in sets:
                if group[i] != group[j] and (sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])):
                    group[i] = group[j] = min(group[i], group[j])
    assert {r.doc_id for r in given[2].collect()} == {i for i in sets if group[i] == i}
    copies = {r.id: r.copies for r in mixing.mix(given[2]).collect() if r.copies}
    assert collections.Counter(r.doc_id for r in given[3].collect()) == copies
    plain_bpe = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=load_tiktoken_bpe(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = sorted((r.doc_id, plain_bpe.encode_ordinary(r.text or "")) for r in given[3].collect())
    assert sorted((r.doc_id, list(r.ids)) for r in given[4].collect()) == want and all(r.n_tokens == len(r.ids) for r in given[4].collect())
