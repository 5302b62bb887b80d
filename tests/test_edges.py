"""Queries against their SQL on tables made for one edge each."""

import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from tidemark.plans import queries as timeline


def both(spark, tmp_path, name, **tables):
    """The rows of a query and of its SQL, unrounded."""
    con = duckdb.connect()
    tmp_path.mkdir(exist_ok=True)
    for t, table in tables.items():
        pq.write_table(table, tmp_path / f"{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = timeline.QUERIES[name](spark, str(tmp_path))
    cols = sorted(df.columns)
    return sorted(map(tuple, df.select(cols).collect())), sorted(con.sql(timeline.oracles()[name]).select(", ".join(f'"{c}"' for c in cols)).fetchall())


def test_shares_halfway_between_two_millionths(spark, tmp_path):
    # 41 and 599 still steps of 640: 0.0640625 and 0.9359375, whose scaled doubles are on either side of the half
    rows = [(u, i, "view" if i <= u else "error") for u in (41, 307, 599) for i in range(641)]
    start = datetime.datetime(2024, 1, 1)
    events = pa.table({
        "event_id": pa.array([u * 1000 + i for u, i, _ in rows], pa.int64()), "ts": pa.array([start + datetime.timedelta(seconds=i) for _, i, _ in rows], pa.timestamp("us")),
        "user_id": pa.array([u for u, _, _ in rows], pa.int64()), "event_type": [e for _, _, e in rows], "value": [30.0 if e == "error" else 1.0 for _, _, e in rows],
    })
    got, want = both(spark, tmp_path, "still_profile", events=events)
    assert len(got) == 3 and got == want


def test_components_are_scaled_in_their_own_width(spark, tmp_path):
    # 0.196 as a float is below 0.196, yet its product with 1000 is 196 in floats
    values = [[(-0.196 if (i + k) % 5 == 0 else 0.053 if (i + k) % 5 == 1 else (i * 37 + k * k * 11) % 251 / 1000) for k in range(64)] for i in range(6)]
    embeddings = pa.table({"vec_id": pa.array(range(6), pa.int64()), "embedding": pa.array(values, pa.list_(pa.float32()))})
    for name in ("picture_median", "picture_sharpness"):
        got, want = both(spark, tmp_path / name, name, embeddings=embeddings)
        assert len(got) >= 2 and got == want


def test_quantiles_at_whole_numbers(spark, tmp_path):
    # cuts of 60 + lo up to the 0.9 quantile's place, of `gap` more beyond it
    cases = [(n, lo, gap) for n in (10, 15, 19, 29) for lo in (0, 1, 3, 6) for gap in (2, 5, 10, 15, 20, 25, 30, 40, 50, 60)]
    rows = [(u, i, lo if i <= (n - 1) * 9 // 10 + 1 else lo + gap) for u, (n, lo, gap) in enumerate(cases) for i in range(n + 1)]
    start = datetime.datetime(2024, 1, 1)
    events = pa.table({
        "event_id": pa.array([u * 1000 + i for u, i, _ in rows], pa.int64()), "ts": pa.array([start + datetime.timedelta(seconds=i) for _, i, _ in rows], pa.timestamp("us")),
        "user_id": pa.array([u for u, _, _ in rows], pa.int64()), "event_type": ["purchase"] * len(rows), "value": [float(v) for _, _, v in rows],
    })
    got, want = both(spark, tmp_path, "still_profile", events=events)
    assert len(got) == len(cases) and got == want
