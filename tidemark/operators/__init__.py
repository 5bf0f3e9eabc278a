from tidemark.operators.changes import (
    affected_partitions,
    changed_rows,
    classify_changes,
    current_snapshot,
    dedupe_batch,
    new_rows,
    require_keys,
)
from tidemark.operators.merge import (
    MergeParts,
    retained_rows,
    scd1_merge,
    scd1_parts,
    scd2_merge,
    scd2_parts,
    superseded_rows,
)
from tidemark.operators.sizing import few_keys, fits_broadcast, fits_by_rows
from tidemark.operators.skew import heavy_keys, heavy_of, key_sketch, salted_left_join

__all__ = [
    "MergeParts",
    "affected_partitions",
    "changed_rows",
    "classify_changes",
    "current_snapshot",
    "dedupe_batch",
    "few_keys",
    "fits_broadcast",
    "fits_by_rows",
    "heavy_keys",
    "heavy_of",
    "key_sketch",
    "new_rows",
    "require_keys",
    "retained_rows",
    "salted_left_join",
    "scd1_merge",
    "scd1_parts",
    "scd2_merge",
    "scd2_parts",
    "superseded_rows",
]
