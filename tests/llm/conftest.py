import random

import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that every operator must take: nulls, empty and blank texts, ties, repeated rows, a long
    text without spaces, characters beyond the basic plane, and columns with names operators use."""
    long = "x" * 30_000 + " " + "word " * 3000
    texts = [None, "", " \t\n", "One two", "One two", long, "é ü 漢字 \U0001f600 password=abcdefgh12 a@b.co", "\x00\x1c a"]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(4, "One two"), (None, None)]
    names = ["id", "row", "size", "taken", "spans", "score", "bucket", "place", "next", "n_words", "component_id", "kept"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names)
    full = [(k, t, None, ["a", "b", None][i % 3], *["clash"] * len(names)) for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n invented words."""

    def make(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def docs(spark):
    """docs(texts): rows (doc_id, text) in several partitions."""
    return lambda texts: spark.createDataFrame(
        [Row(doc_id=i, text=t, source="s", lang="en") for i, t in enumerate(texts)],
        "doc_id long, text string, source string, lang string",
    ).repartition(3)
