import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) rows; languages may be given as a third value."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build


@pytest.fixture
def clashing():
    """A table with the columns that operators make on their way."""

    def build(df):
        from pyspark.sql import functions as F

        names = ["row_id", "normal", "fp", "n", "text_key", "component", "kept", "id", "piece", "length", "score", "p", "block",
                 "first", "size", "bucket", "toxic", "quality", "label"]
        return df.withColumns({name: F.lit("x") for name in names})

    return build
