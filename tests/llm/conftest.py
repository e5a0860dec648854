import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """make(rows): a documents table; rows are (doc_id, text) or whole rows."""

    def make(rows, extra=""):
        rows = [(*r, "en", "src", len(r[1] or "")) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long{extra}")

    return make


#: Names that operators use inside; an input may have such columns too.
CLASHING = ["key", "body", "part", "place", "before", "shard", "slot", "size", "kind", "spans", "cls", "same", "row", "k", "s"]


@pytest.fixture(scope="session")
def clashing():
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING])
