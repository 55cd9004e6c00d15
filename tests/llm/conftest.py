import pytest

CLASH = (
    *("text", "lang_pred", "n_words", "n_hit", "label", "part", "peek", "h", "_words", "_doc", "ids", "spans", "base"),
    *("_marks", "_lines", "_kept", "_site", "_host", "_low", "_answer", "_found", "_gone", "host", "low", "place"),
)


@pytest.fixture
def table(spark):
    """A table of two columns, with more columns whose names an operator may use itself."""

    def make(rows, schema="doc_id long, text string", clash=True):
        df = spark.createDataFrame(rows, schema)
        for name in CLASH if clash else ():
            if name not in df.columns:
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make
