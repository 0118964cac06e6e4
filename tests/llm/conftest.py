from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows and a column with a clashing name."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "Jota", "käse", "été"]
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(20_000))
    prose = " ".join(rng.choice(words) for _ in range(80))
    rows = [
        (1, prose, "en", "a", 9, "x"), (1, prose, "en", "a", 9, "x"), (2, prose, "de", None, None, "y"), (3, None, None, "b", 0, None),
        (4, "", "en", "a", 0, "z"), (5, " \n\t ", None, None, 3, ""), (6, long, "en", "b", len(long), "l"), (None, prose, "en", "a", 1, "n"),
        (None, None, None, None, None, None), (7, "one", "en", "b", 3, "t"), (8, "one", "en", "b", 3, "t"), (8, "other text of this id", "en", "b", 3, "t"),
    ]
    return spark.createDataFrame(rows, DOCS + ", kept string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
