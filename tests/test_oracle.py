"""Registered queries against their DuckDB twins (sf0.001 here; the driver runs sf0.01)."""

import pytest

from tests.conftest import SF001

# a cross-section; tools/oracle_check.py runs every query
NAMES = [
    "clean_except",
    "tokenize",
    "train_test_split",
    "vocabulary",
    "class_sizes",
    "gain_ratio",
    "top_splits",
    "forest_mr_depth3",
    "accuracy",
    "stem_vocabulary",
    "doc_index",
]


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as connect

    return connect(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql_twin(spark, duck, name):
    import __spark_entry__ as E
    from tools.oracle_check import _rows

    df = E.queries()[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_every_query_has_a_twin():
    import __spark_entry__ as E
    from sylvan.plans.queries import QUERIES
    from sylvan.plans.sql_queries import SQL

    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].n_test > 0
