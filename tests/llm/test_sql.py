"""The registered queries that have SQL, on the smallest data."""

import os

import pytest

import check_oracle
from tephra.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.mark.parametrize("name", list(registry.oracles()))
def test_query(spark, name):
    state, note, _ = check_oracle.compare(spark, check_oracle.connect(SF), SF, name)
    assert state == "ok", note
