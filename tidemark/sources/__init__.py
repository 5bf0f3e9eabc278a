from tidemark.sources.columnlists import note_lists, over_shared, with_known
from tidemark.sources.extracts import Extracts
from tidemark.sources.keyindex import index_partitions, partitions_with_keys, read_candidates
from tidemark.sources.lock import TableLocked, WriterLock
from tidemark.sources.tables import (
    Staged,
    clear_work,
    empty_table,
    partition_folder,
    partition_path,
    publish_partitions,
    read_final,
    read_landing,
    read_landing_judged,
    read_partitions,
    recover_table,
    replace_table,
    replace_table_parts,
    save_rows,
    settle_extracts,
    shared_folder,
    table_exists,
    write_observed,
)

__all__ = [
    "Extracts",
    "Staged",
    "TableLocked",
    "WriterLock",
    "clear_work",
    "empty_table",
    "index_partitions",
    "note_lists",
    "over_shared",
    "partition_folder",
    "partition_path",
    "partitions_with_keys",
    "publish_partitions",
    "read_candidates",
    "read_final",
    "read_landing",
    "read_landing_judged",
    "read_partitions",
    "recover_table",
    "replace_table",
    "replace_table_parts",
    "save_rows",
    "settle_extracts",
    "shared_folder",
    "table_exists",
    "with_known",
    "write_observed",
]
