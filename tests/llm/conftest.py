import random

import pytest
from pyspark.sql import functions as F

CLASHING = ("score", "slot", "position", "text_hash", "row", "first", "block", "spans", "kept", "n_words", "component", "bucket", "windows")


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def make_rows():
    """Null and empty texts, ties, repeated rows, near copies, shared passages and a long text."""
    rng = random.Random(5)
    passage, long = words(rng, 60), words(rng, 20_000, 5000)
    base = words(rng, 150).split()
    near = [" ".join(base[:k] + ["edit"] + base[k + 1:]) for k in (10, 70, 140)]
    texts = [None, "", "  \n\t ", "one", "One", "a b c d", "A b c d\n", "x " * 300, "café Ünï – 日本語   naïve", long, long[:2000], " ".join(base), *near,
             words(rng, 40) + " " + passage, passage + "\n" + words(rng, 30), "Line one here.\n" * 5, "tab\tvt\x0bff\x0cend\r\n#*$ %%"]
    texts += [words(rng, rng.randrange(1, 120)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(3, "one"), (11, " ".join(base)), (11, "same id other text " + words(rng, 60)), (None, passage), (None, None), (-5, near[0])]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names clash with those that operators use."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING} | {"source": F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"), "lang": F.lit(None).cast("string")})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
