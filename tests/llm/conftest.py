import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField(n, k) for n, k in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()))]
)
#: Extra columns with the names that the operators use inside.
CLASHES = ("row", "digest", "kept", "label", "size", "a", "b", "bucket", "key", "n", "target", "words", "score")


@pytest.fixture(scope="session")
def table(spark):
    """Makes a documents table from rows of up to four values, with clashing extra columns if asked for."""

    def make(rows, clash=False):
        made = spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], DOCS)
        if clash:
            from pyspark.sql import functions as F

            made = made.withColumns({c: F.lit("x") for c in CLASHES})
        return made

    return make


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
