from tidemark.functions.audit import (
    AUDIT_COLUMNS,
    CLOSED_FLAG,
    CURRENT,
    EFFECTIVE,
    END,
    HASH,
    OPEN_FLAG,
    PARTITION,
    as_date,
    close_rows,
    col,
    list_name,
    named_hash,
    parse_run_date,
    row_hash,
    with_audit,
)

__all__ = [
    "AUDIT_COLUMNS",
    "CLOSED_FLAG",
    "CURRENT",
    "EFFECTIVE",
    "END",
    "HASH",
    "OPEN_FLAG",
    "PARTITION",
    "as_date",
    "close_rows",
    "col",
    "list_name",
    "named_hash",
    "parse_run_date",
    "row_hash",
    "with_audit",
]
