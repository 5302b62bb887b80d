import pytest

#: Rows with every awkward case: nulls, empty and long texts, ties, repeats, clashing names.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, score double, score_ string"


def words(seed: int, n: int) -> str:
    x, out = seed * 2654435761 % 2**32 or 1, []
    for _ in range(n):
        x = (1103515245 * x + 12345) % 2**31
        out.append("".join("abcdefghijklmnop"[(x >> k) & 15] for k in (4, 9, 14, 19)))
    return " ".join(out)


@pytest.fixture(scope="session")
def awkward(spark):
    base = words(7, 120)
    texts = [
        (1, base), (2, base), (3, base.upper()), (4, base.replace(base.split()[60], "zzzz")), (5, words(8, 120)), (6, None), (7, ""), (8, "  \t\n "),
        (9, "one"), (10, "one two three"), (11, words(9, 60_000)), (11, words(9, 60_000)), (None, "lone text"), (None, None), (12, "é ß 漢字 🙂 \x00\x1f end"), (13, "x" * 50_000),
    ]
    rows = [(i, t, None, None if k % 5 == 0 else f"s{k % 3}", None, 99, 98, 0.5, "c") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
