import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source), with columns whose names clash with others."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DDL)
        if clash:
            df = df.selectExpr("*", "'x' as TEXT", "7 as Doc_Id", "1 as part", "2 as kind", "3 as tokens")
        return df

    return make
