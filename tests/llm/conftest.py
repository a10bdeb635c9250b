import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def make_docs(spark):
    """A documents table from (doc_id, text) pairs, with extra columns whose names operators use."""
    from daybook.llm.common import prepare

    def make(rows, extra=True):
        prepare(spark)
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        if extra:
            for name in ("id", "key", "label", "rank", "_may", "_t", "row", "part", "length", "keys"):
                df = df.selectExpr("*", f"doc_id * 7 as `{name}`")
        return df
    return make


ODD_TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "word " * 40_000), (6, "y" * 300_000),
             (7, "Grüße aus Köln, ça va? 😀 naïve\r\nzweite Zeile"), (8, "x"), (8, "x"), (None, "no id here at all"),
             (9, "\n".join(f"line number {i} of a long list" for i in range(3000)))]
