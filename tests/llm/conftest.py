import pytest

from voltframe.llm.common import on_workers

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers(spark):
    on_workers(spark)


@pytest.fixture()
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    further columns with names that the operators use themselves."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(1, "alpha beta gamma delta " * 30, "en", "s1", 5), (2, "alpha beta gamma delta " * 30, "en", "s2", 5),
            (2, "alpha beta gamma delta " * 30, "en", "s2", 5), (3, None, None, None, None), (4, "", "en", "s1", 0),
            (None, "no id here", "de", "s3", 1), (None, None, None, None, None), (5, long_text, "fr", "s1", 9),
            (6, long_text + " tail", "fr", None, 9), (7, "one", "es", "s4", 3), (8, "A\x0bB\tc d\r\ne ünï 𝒳", "en", "s1", 1),
            (9, "line one of all sites\nother", "en", "s5", 1)]
    clash = ["id", "fp", "root", "crc", "doc", "tokens", "rate", "copies", "post", "pos", "line", "h1", "key", "t",
             "spans", "first", "n", "domain", "base", "runs", "length", "f", "grade", "at"]
    df = spark.createDataFrame(rows, DOC_COLUMNS)
    for c in clash:
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture()
def empty(docs):
    return docs.where("false")
