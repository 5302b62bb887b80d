import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, mixing, urls


def fill(sizes, weights, most):
    """Targets by sharing out again and again."""
    total, done = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[k] for k in done)
        wsum = sum(w for k, w in enumerate(weights) if k not in done)
        t = [most * s if k in done else rest * weights[k] / wsum for k, s in enumerate(sizes)]
        over = {k for k in range(len(sizes)) if k not in done and t[k] > most * sizes[k] + 1e-9}
        if not over:
            return t
        done |= over


def test_targets(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 17):
        sizes = [rng.choice([0, 1, 10, 1000, 100_000]) for _ in range(n - 1)] + [50_000]
        names = sorted(f"é{k:03d}" for k in range(n - 1)) + [None]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()}
        want = fill(sizes, [[5, 2, 1][k % 3] for k in range(n)], 3.0)
        assert [got[x] for x in names] == pytest.approx(want)


def test_rounding_keeps_sums_and_chances(spark):
    rng = random.Random(2)
    units = [(g, k, k, rng.choice([1, 5, 40, 900]), rng.choice([0.0, 0.25, 0.7, 1.0])) for g, n in (("a", 1500), ("b", 3), (None, 70)) for k in range(n)]
    df = spark.createDataFrame(units, "grp string, key long, unit long, size long, p double").withColumn("unit", F.struct("grp", "key", "size", "p"))
    got = [(r.unit, r.up) for r in mixing.dependent_round(df, block=8).collect()]
    assert len(got) == len(units)
    for g in ("a", "b", None):
        own = [(u.size, u.p, up) for u, up in got if u.grp == g]
        assert abs(sum(s * up for s, _, up in own) - sum(s * p for s, p, _ in own)) <= 900
        assert all(up == bool(p) for _, p, up in own if p in (0.0, 1.0))
    # over many seeds each unit is rounded up as often as its mass says
    n = {}
    for seed in range(60):
        for r in mixing.dependent_round(df.filter("grp = 'b'"), seed=seed).collect():
            n[r.unit.key] = n.get(r.unit.key, 0) + r.up
    for g, k, _, _, p in units:
        if g == "b":
            assert abs(n[k] / 60 - p) < 0.25


def test_mix_of_awkward_rows(spark, awkward, empty):
    got = mixing.mix(awkward).collect()
    rows = awkward.collect()
    assert len(got) == len(rows) and mixing.mix(empty).count() == 0
    assert sorted((r.id is None, r.id or 0, r.size) for r in got) == sorted((r.doc_id is None, r.doc_id or 0, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in rows)
    assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(awkward.repartition(3)).collect()), key=repr)
    mixed = mixing.apply(awkward)
    assert mixed.columns == awkward.columns and sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixed.count() == sum(r.copies for r in got)  # those without words too


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host, path = "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "http://WWW.Example.COM/en/x?y#z", "x://a.b.www.example.com/en/", "https://example.com/en", "http://a.net/es/1", "http://net/fr/", "http://planet/fr/",
    "http://a.net?u=/fr/", "http://a.net#/fr/", "http://u@h.com:80/p//q/", "a://b://c.com/", "http://..com/", "http://com./", "http://É.com/é/", "http://a.net/" + "d/" * 300 + "x", ".".join(["s"] * 200) + "://" + ".".join(["s"] * 200) + ".net/es/", "http://a.com/en\n/x",
]


@pytest.mark.parametrize("rules", [urls.RULES, [("block", "com", "/en"), ("allow", "com", "/e"), ("block", "b.net", ""), ("allow", "net", "/x/y"), ("block", "net", "/x/y"), ("allow", "a.com", "/p/q/r/")]])
def test_urls_against_plain(spark, rules):
    more = ["http://x.com/en", "http://x.com/english/", "http://x.com/ex", "http://b.net", "http://a.b.net/x/y", "http://c.net/x/yz", "http://a.com/p/q/r/s"]
    rows = [(k, u, "old", 1) for k, u in enumerate(URLS + more + URLS[:3])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, short long")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, urls.rule_table(spark, rules)).collect()}
    assert got == {k: plain_verdict(u, rules) for k, u, *_ in rows}


def test_urls_sql_and_empty(spark, tmp_path):
    rows = [(k, u) for k, u in enumerate(URLS)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cols = "page_id, host, path, rule, verdict"
    assert sorted(map(tuple, urls.op5_urls(spark, str(tmp_path)).collect())) == sorted(con.sql(f"SELECT {cols} FROM ({urls.OP5_SQL})").fetchall())
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, urls.rule_table(spark, urls.RULES)).count() == 0


def test_licences(spark):
    mit, gpl = licenses.TEMPLATES[0][1], "THIS work is licensed under the GNU general public license - version 3"
    files = [
        (1, "a/LICENSE", mit), (2, "a/x.txt", "nothing"), (3, "a/b/c/y.txt", None), (4, "a/b/LICENSE.txt", f"head\n{gpl}\n"), (5, "a/b/c/z.txt", ""), (6, "q/LICENSE", "plain"), (7, "q/w.txt", "the work is under a version"),
        (8, "LICENSE.md", "Licensed under CC BY-NC 4.0"), (9, None, "a license to be read"), (10, "a/b/own.txt", f"{'lorem ipsum ' * 20_000}\n{mit}"), (2, "a/x.txt", "nothing"), (None, "a/n.txt", mit),
    ]
    df = spark.createDataFrame([(*f, "x", "y", 3) for f in files], "doc_id long, path string, text string, licence string, term string, line_no long")
    got = sorted(((r.id, r.path, r.licence, r.origin, r.from_path) for r in licenses.scan(df).collect()), key=repr)
    want = [
        (1, "a/LICENSE", "MIT", "header", None), (2, "a/x.txt", "MIT", "directory", "a/LICENSE"), (2, "a/x.txt", "MIT", "directory", "a/LICENSE"), (3, "a/b/c/y.txt", "GPL-3.0", "directory", "a/b/LICENSE.txt"),
        (4, "a/b/LICENSE.txt", "GPL-3.0", "header", None), (5, "a/b/c/z.txt", "GPL-3.0", "directory", "a/b/LICENSE.txt"), (6, "q/LICENSE", "CC-BY-NC-4.0", "directory", "LICENSE.md"), (7, "q/w.txt", "CC-BY-NC-4.0", "directory", "LICENSE.md"),
        (8, "LICENSE.md", "CC-BY-NC-4.0", "header", None), (9, "", "CC-BY-NC-4.0", "directory", "LICENSE.md"), (10, "a/b/own.txt", "MIT", "header", None), (None, "a/n.txt", "MIT", "header", None),
    ]
    assert got == sorted(want, key=repr)
    assert licenses.scan(df.limit(0)).count() == 0


def test_licence_cosines_against_plain(spark):
    rng = random.Random(3)
    vocabulary = " ".join(x for _, x in licenses.TEMPLATES).split() + ["foo", "bar", "baz"]
    texts = ["\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 14))) for _ in range(6)) for _ in range(60)] + [x for _, x in licenses.TEMPLATES]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "path string, text string")
    got = {r.path: tuple(r.own) for r in licenses.notices(df, threshold=0.6).collect() if r.own}
    import math

    split = lambda s: [t for t in re.split("[^a-z0-9]+", s.lower()) if t]
    bags = [(n, split(x)) for n, x in licenses.TEMPLATES]
    known = {t for _, b in bags for t in b}
    idf = lambda t: math.log((1 + len(texts)) / (1 + sum(t in split(x) for x in texts) * (t in known))) + 1
    w = {t: idf(t) for t in known}
    rest = math.log(1 + len(texts)) + 1
    want = {}
    for k, t in enumerate(texts):
        blocks = re.split(r"\n[^A-Za-z0-9\n]*\n", t)
        top = []
        for unit in {*t.split("\n"), *blocks, *(x for b in blocks for x in re.split(r"[.!?]\s+", b))}:
            x = split(unit)
            norm = math.sqrt(sum((x.count(u) * w[u]) ** 2 for u in set(x) if u in known) + sum(rest**2 for u in x if u not in known))
            best = max(((round(sum(x.count(u) * w[u] * b.count(u) * w[u] for u in set(x) & set(b)) / norm / math.sqrt(sum((b.count(u) * w[u]) ** 2 for u in set(b))), 6), -i, name) for i, (name, b) in enumerate(bags)), default=None) if norm else None
            top += [best] if best and best[0] >= 0.6 else []
        if top:
            want[str(k)] = (max(top)[2], max(top)[0])
    assert got == want and len(want) > 15
