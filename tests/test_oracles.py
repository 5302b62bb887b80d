"""Every query with SQL gives the rows of its SQL, at the smallest scale, with 1 and with 4 shuffle partitions for some."""

import os

import duckdb
import pytest

from tidemark.plans import queries as timeline

SF = "/root/testdata/sf0.001"
TABLES = "customer supplier orders lineitem events documents embeddings benchmark conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the shared test tables")
#: What the smallest scale must show, so that no comparison is empty.
FLOOR = {"ad_spans": 5, "pointers": 5, "signal_validate": 4, "hallucination": 50, "correction_audit": 10, "candidates": 100, "quote_verbatim": 5, "numeric_provenance": 50, "voice_lint": 50, "chunk_plan": 2, "pointer_holes": 3}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return round(float(v), 9) if type(v).__name__ == "Decimal" else v


def rows(found):
    return sorted((tuple(plain(v) for v in r) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(timeline.QUERIES))
def test_rows(spark, con, name):
    df = timeline.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cols = sorted(df.columns)
    got = rows(df.select(cols).collect())
    assert len(got) >= FLOOR.get(name, 1)
    if name in timeline.oracles():
        rel = con.sql(timeline.oracles()[name])
        assert sorted(rel.columns) == cols
        assert got == rows(rel.select(", ".join(f'"{c}"' for c in cols)).fetchall())


@pytest.mark.parametrize("name", ["ad_spans", "candidates", "leader_cluster", "dedup_vs_all", "chunk_plan", "frame_selection"])
def test_partition_counts_do_not_matter(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(rows(timeline.QUERIES[name](spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_lint_labels_all_fire(spark):
    from tidemark.operators.notes import BANNED

    found = {r.label for r in timeline.QUERIES["lint_by_label"](spark, SF).collect()}
    assert len(found & set(BANNED)) >= 10 and "inline timestamp" in found


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
