"""Every registered query gives the rows of its oracle SQL, with the same column types."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from acceptance.compare import differences
from acceptance.registry import ORACLE, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    want = oracle.sql(ORACLE[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert differences(got.to_pandas(), want.to_pandas()) is None


def test_entry(spark):
    assert entry(spark).count() > 0
