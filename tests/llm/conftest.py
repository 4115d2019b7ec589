import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text, lang, source) rows."""

    def make(rows, clash=()):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (i, row, "en", "s")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        frame = spark.createDataFrame(full, DOCUMENTS)
        return frame.withColumns({name: F.lit("x") for name in clash}) if clash else frame

    return make
