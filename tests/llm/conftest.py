import pytest


@pytest.fixture
def make(spark):
    """Documents with the usual columns from (doc_id, text[, source]) tuples."""

    def of(rows, extra=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        if not extra:
            return df
        # names that the operators use themselves
        return df.selectExpr(
            "*", "1 AS id", "'x' AS content", "2 AS fingerprint", "3 AS place", "'y' AS host", "4 AS size",
            "5 AS component_id", "6 AS found", "7 AS due", "8 AS doc", "9 AS gone", "10 AS taken", "11 AS bucket",
        )

    return of
