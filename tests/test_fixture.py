"""Row counts of the fixture, as they were measured with another engine."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classify_changes, scd1_merge, scd2_merge
from tidemark.plans.fixture import audited_batch, stored_table

# Per scale factor, stored Y, stored N, batch, new, changed,
# Type 1 total, Type 2 total, Type 2 Y, Type 2 total with all versions re-closed
COUNTS = {
    "0.001": (135, 26, 90, 15, 38, 150, 214, 150, 201),
    "0.01": (1350, 250, 900, 150, 375, 1500, 2125, 1500, 2000),
}


@pytest.mark.parametrize("sf", sorted(COUNTS))
def test_counts(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    stored, batch = stored_table(spark, folder), audited_batch(spark, folder)
    open_rows = stored.where("current = 'Y'")
    classified = classify_changes(batch, stored, ["c_custkey"]).persist()
    key = ["c_custkey"]
    two = scd2_merge(stored, classified, key, "2024-02-01")
    got = (
        open_rows.count(),
        stored.where("current = 'N'").count(),
        batch.count(),
        classified.where("rowType = 'NewRows'").count(),
        classified.where("rowType = 'CurrentRows'").count(),
        scd1_merge(open_rows, classified, key).count(),
        two.count(),
        two.where("current = 'Y'").count(),
        scd2_merge(stored, classified, key, "2024-02-01", close_scope="all").count(),
    )
    assert got == COUNTS[sf]
    doubled = two.where("current = 'Y'").groupBy("c_custkey").count().where(F.col("count") > 1)
    assert doubled.count() == 0
    classified.unpersist()
