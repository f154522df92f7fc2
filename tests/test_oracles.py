"""Every query against its SQL twin on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, rows_of_spark, rows_of_sql
from conftest import MEDIUM

from reelstar.oracles import all_oracles
from reelstar.queries import all_queries


@pytest.fixture(scope="module")
def con():
    return connect(MEDIUM)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    columns, rows = rows_of_spark(all_queries()[name](spark, MEDIUM))
    sql_columns, sql_rows = rows_of_sql(con, all_oracles()[name])
    assert columns == sql_columns
    assert rows.total() > 0
    missing, extra = sql_rows - rows, rows - sql_rows
    assert not missing and not extra, (
        f"{rows.total()} rows against {sql_rows.total()}; "
        f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    )
