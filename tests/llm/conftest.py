import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside or return.
CLASHES = ["row", "key", "h", "n", "id", "size", "target", "copies", "copy", "score", "evidence", "kept", "n_words", "_text", "_words", "_n", "_gone",
           "_sha", "component_id", "class", "named", "bucket", "packed", "start", "ids", "value", "a.b"]


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text[, source]) as a documents table."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def clashing():
    """The same table with columns of all names that might clash."""
    def add(df):
        return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    return add


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 5000} of the line\n" for i in range(40000))
    same = "the same text of some words that two rows hold in the very same way"
    return [(1, None, "s"), (2, "", "s"), (3, " \n\t ", None), (None, same, "t"), (4, same, "t"), (5, same + " ", "t"), (4, same, "t"),
            (6, long, "u"), (7, "one", None), (7, "another text under the same id", "s"), (8, "Ünï cödé \U0001F642 ' 's 're x", ""), (None, None, None)]
