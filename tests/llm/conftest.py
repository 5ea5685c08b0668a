import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("window", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang) rows, with extra columns that clash."""

    def make(rows, parts=3):
        full = []
        for doc_id, text, *lang in rows:
            full.append((doc_id, text, lang[0] if lang else "en", "s", len(text) if text is not None else None, "x", None, "y", "z", None))
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make
