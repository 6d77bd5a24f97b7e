import datetime

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def build(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, score date, `a.b` int"
        day = datetime.date(2020, 1, 1)
        full = [(i, t, "en", "s", len(t or ""), "x", day, 1) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build
