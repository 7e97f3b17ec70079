import os
import re

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", entry.queries())
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, name, SF, entry.queries(), entry.oracle_sql()) is None


def test_every_query_has_sql():
    """Those of the corpus subpackage, if it is there, are tested on their own where SQL can't express them."""
    own = {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["check", "severity", "passed", "n"] and df.count() == 6
