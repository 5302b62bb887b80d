"""Extra columns under every name that an operator uses inside."""

import ast
import pathlib

import pytest
from pyspark.sql import functions as F

from tidemark import llm
from tidemark.llm import bpe, covertree, ctw, licenses, media, mixing, simhash, toxicity, urls, warc


def names():
    """Every string in the subpackage that could be a column's name."""
    found = set()
    for p in pathlib.Path(llm.__file__).parent.glob("*.py"):
        for n in ast.walk(ast.parse(p.read_text())):
            if isinstance(n, ast.Constant) and isinstance(n.value, str) and n.value.replace(" ", "a").isidentifier() and len(n.value) < 20:
                found.add(n.value)
    return sorted({n.lower(): n for n in found}.values())


@pytest.fixture(scope="module")
def wide(spark):
    own = [(k, f"one two three four five six seven eight {k % 3}", f"s{k % 2}") for k in range(9)]
    docs = spark.createDataFrame(own, "doc_id long, text string, source string")
    return docs.select("*", *[F.lit("x").alias(n) for n in names() if n not in docs.columns])


@pytest.mark.parametrize("run", [simhash.keep_one, simhash.keep_one_similar, mixing.apply], ids=["keep_one", "keep_one_similar", "apply"])
def test_own_columns_stay(wide, run):
    assert len(wide.columns) > 150
    got = run(wide)
    assert got.columns == wide.columns and {r.doc_id for r in got.collect()} <= set(range(9))


def test_others(spark, wide, tmp_path):
    model = toxicity.Model({"one": 1.0})
    assert toxicity.keep_clean(wide, model).columns == wide.columns and toxicity.score(wide, model).count() == 9
    for df in (simhash.near_duplicates(wide), simhash.similar(wide), mixing.mix(wide), ctw.score(wide), media.store_texts(wide), bpe.encode(wide, {bytes([b]): b for b in range(256)}, r"\s*\S+")):
        assert df.count() == 9
    pages = wide.withColumn("url", F.concat(F.lit("http://a.com/"), F.col("doc_id").cast("string")))
    judged = urls.judge(pages, urls.rule_table(spark, urls.RULES))
    assert set(judged.columns) == set(pages.columns) and judged.filter("verdict = 'allow' AND rule = 'com/'").count() == 9
    assert licenses.scan(wide.withColumn("path", F.lit("a/b"))).count() == 9
    vectors = wide.withColumn("vec_id", F.col("doc_id")).withColumn("embedding", F.array(F.lit(1.0), F.col("doc_id").cast("double"))).withColumn("label", F.lit(1))
    assert covertree.near_vectors(vectors).count() == 9
    files = wide.withColumn("media", F.lit(media.build(b" " * 192)))
    assert set(media.index_media(files).columns) == set(files.columns) | {"tracks", "problem"}
    index = warc.write(wide.withColumn("page_id", F.col("doc_id")).withColumn("url", F.lit(None).cast("string")).withColumn("html", F.col("text")), f"file://{tmp_path}/w")
    assert warc.read(index.select("*", F.lit(1).alias("block")), f"file://{tmp_path}/w").count() == 9


def test_shared_ids_and_paths_keep_their_own_licence(spark):
    rows = [(1, "a/x", "Released under the MIT License."), (1, "a/x", "plain words only"), (None, "b/y", "Licensed under CC BY 4.0."), (None, "b/y", "nothing here")]
    got = sorted((r.path, r.licence or "", r.origin) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect())
    assert got == [("a/x", "", "none"), ("a/x", "MIT", "header"), ("b/y", "", "none"), ("b/y", "CC-BY-4.0", "header")]


def test_headers_that_are_wrapped_boxed_or_in_prose_and_whole_files(spark):
    by = {}
    for name, text in licenses.TEMPLATES:
        by[name] = max(by.get(name, ""), text, key=len)
    wrap = lambda t, k, lead: "\n".join(lead + " ".join(t.split()[i : i + k]) for i in range(0, len(t.split()), k))
    rows = [
        ("a/LICENSE", "Copyright (c) 2020 Some Body\n\n" + by["MIT"].replace(". ", ".\n\n"), "MIT"),
        ("b/COPYING.txt", "Copyright 2001, 2002 The Authors.\n" + wrap(by["BSD-3-Clause"], 9, ""), "BSD-3-Clause"),
        ("c/main.c", "/*\n" + wrap(by["GPL-3.0"], 8, " * ") + "\n */\nint main(void) { return 0; }\n" * 30, "GPL-3.0"),
        ("d/x.py", wrap(by["Apache-2.0"], 7, "# ") + "\n\nimport os\n" * 40, "Apache-2.0"),
        ("e/t.txt", "Some long prose about other things stands here first. This work is licensed under the GNU General Public\nLicense, version 2. And more prose stands after it, in the same block of lines.\n", "GPL-2.0"),
        ("a/src/deep/y.c", "int x;", "MIT"),
        ("f/z.c", "the quick brown fox", None),
    ]
    got = {r.path: r.licence for r in licenses.scan(spark.createDataFrame([(k, *r[:2]) for k, r in enumerate(rows)], "doc_id long, path string, text string")).collect()}
    assert got == {p: want for p, _, want in rows}
