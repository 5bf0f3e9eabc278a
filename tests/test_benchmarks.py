"""The compared shapes come to the same results."""

import pytest
from pyspark.sql.types import DecimalType

from benchmarks.two_joins import TWO_JOINS
from tests.helpers import tuples
from tidemark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(TWO_JOINS))
def test_two_joins_give_the_same(spark, name):
    other = TWO_JOINS[name](spark, SF_DIR)
    money = [f.name for f in other.schema if isinstance(f.dataType, DecimalType)]
    other = other.withColumns({m: other[m].cast("string") for m in money})
    ours = QUERIES[name.partition(":")[0]](spark, SF_DIR)
    assert tuples(other, *sorted(other.columns)) == tuples(ours, *sorted(ours.columns))
