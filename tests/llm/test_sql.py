"""Registered text queries against their SQL twins on whole tables."""

import pytest

from compare import connect, differences
from curbline.llm import queries


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(connect(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name]) == ""
