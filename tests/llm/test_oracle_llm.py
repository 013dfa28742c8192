"""The SQL of the training-data queries."""

from __future__ import annotations

import pytest

from compare import compare, connect
from tollbook.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_llm_query_equals_sql(spark, folder, name):
    count, problem = compare(spark, connect(folder), folder, name)
    assert not problem
    assert count
