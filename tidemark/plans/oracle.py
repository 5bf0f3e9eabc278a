"""The queries of `tidemark.plans.queries` as plain SQL over the same tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from tidemark.plans.fixture import CUSTOMER, MONEY, ORDERS, Source
from tidemark.plans.queries import ROUNDTRIP_FORMATS

AUDIT = '"current", effectiveDate, endDate, rowHash'
NO_END = "CAST(NULL AS DATE)"


def _hash(columns: Sequence[str], mode: str = "compat") -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    if mode == "compat":
        parts = [f"coalesce({t}, '')" for t in texts]
    else:
        parts = [f"CASE WHEN {t} IS NULL THEN '-' ELSE concat(length({t}), ':', {t}) END" for t in texts]
    return f"sha256(concat({', '.join(parts)}))"


def _base(source: Source) -> str:
    picked = ", ".join(
        f"CAST({name} AS {ddl.replace('string', 'varchar')}) AS {name}" for name, ddl in source.columns
    )
    return f"base AS (SELECT {picked} FROM {source.table})"


def _fixture(source: Source, mode: str = "compat", whole: bool = False) -> str:
    """CTEs ``base``, ``final0`` (stored table) and ``raw`` (audited batch)."""
    key, amount = source.key, source.amount
    kept = "true" if whole else f"{key} % 10 <> 9"
    names = ", ".join(source.names)

    def changed(expr: str) -> str:
        return names.replace(amount, f"CAST({expr} AS {MONEY}) AS {amount}")

    earlier = f"CASE WHEN {key} % 12 = 0 THEN {amount} + 100 ELSE {amount} - 50 END"
    later = f"CASE WHEN {key} % 4 = 0 THEN {amount} + 100 ELSE {amount} END"
    return f"""
{_base(source)},
f0 AS (
  SELECT {names}, 'Y' AS "current", DATE '2024-01-01' AS effectiveDate, {NO_END} AS endDate,
         CAST(20240101 + {key} % 3 AS INTEGER) AS partitionKey
  FROM base WHERE {kept}
  UNION ALL
  SELECT {changed(earlier)}, 'N', DATE '2023-01-01', DATE '2023-12-31', 20230101
  FROM base WHERE {key} % 12 IN (0, 4) AND {kept}),
final0 AS (
  SELECT {names}, "current", effectiveDate, endDate, {_hash(source.names, mode)} AS rowHash, partitionKey FROM f0),
r0 AS (SELECT {changed(later)} FROM base WHERE {key} % 2 = 0 OR {key} % 10 = 9),
raw AS (
  SELECT {names}, 'Y' AS "current", DATE '2024-02-01' AS effectiveDate, {NO_END} AS endDate,
         {_hash(source.names, mode)} AS rowHash, 20240201 AS partitionKey FROM r0)"""


def _classified(source: Source, stored: str = "final0") -> str:
    key = source.key
    return f"""
classified AS (
  SELECT r.*, CASE WHEN c.{key} IS NULL THEN 'NewRows' ELSE 'CurrentRows' END AS rowType,
         coalesce(c.partitionKey, r.partitionKey) AS pKey
  FROM raw r LEFT JOIN (SELECT * FROM {stored} WHERE "current" = 'Y') c ON r.{key} = c.{key}
  WHERE c.{key} IS NULL OR r.rowHash <> c.rowHash),
changed AS (SELECT * FROM classified WHERE rowType = 'CurrentRows')"""


def _with(source: Source, select: str, mode: str = "compat") -> str:
    return f"WITH {_fixture(source, mode)},{_classified(source)}\n{select}"


def _whole(select: str) -> str:
    """Over a stored table of all customers."""
    return f"WITH {_fixture(CUSTOMER, whole=True)}\n{select}"


def _batch_rows(source: Source, partitioned: bool = True) -> str:
    part = ", partitionKey" if partitioned else ""
    return f"SELECT {', '.join(source.names)}, {AUDIT}{part} FROM classified"


def _scd2(source: Source, partitioned: bool = True) -> str:
    key, names = source.key, ", ".join(f"f.{c}" for c in source.names)
    hit = f"""f."current" = 'Y' AND f.{key} IN (SELECT {key} FROM changed)"""
    part = ", f.partitionKey" if partitioned else ""
    return f"""
SELECT {names}, CASE WHEN {hit} THEN 'N' ELSE f."current" END AS "current", f.effectiveDate,
       CASE WHEN {hit} THEN DATE '2024-01-31' ELSE f.endDate END AS endDate, f.rowHash{part}
FROM final0 f
UNION ALL {_batch_rows(source, partitioned)}"""


def _scd2_all(source: Source) -> str:
    key, names = source.key, ", ".join(f"f.{c}" for c in source.names)
    return f"""
SELECT f.* FROM final0 f LEFT JOIN changed c ON f.{key} = c.{key} WHERE c.{key} IS NULL
UNION ALL
SELECT {names}, 'N', f.effectiveDate, DATE '2024-01-31', f.rowHash, f.partitionKey
FROM final0 f JOIN changed c ON f.{key} = c.{key} WHERE f.rowHash <> c.rowHash
UNION ALL {_batch_rows(source)}"""


def _scd1(source: Source, partitioned: bool = True) -> str:
    key, names = source.key, ", ".join(source.names)
    part = ", partitionKey" if partitioned else ""
    return f"""
SELECT {names}, {AUDIT}{part} FROM final0
WHERE "current" = 'Y' AND {key} NOT IN (SELECT {key} FROM changed)
UNION ALL {_batch_rows(source, partitioned)}"""


def _audited(source: Source, run_date: str, partition: int | None, frm: str, mode: str = "compat") -> str:
    part = f", {partition} AS partitionKey" if partition else ""
    return (
        f"""SELECT {', '.join(source.names)}, 'Y' AS "current", DATE '{run_date}' AS effectiveDate, """
        f"{NO_END} AS endDate, {_hash(source.names, mode)} AS rowHash{part} FROM {frm}"
    )


def _ingest() -> str:
    """First load of 9 in 10 base rows, then the batch, with delimited hashes."""
    key = CUSTOMER.key
    names = ", ".join(CUSTOMER.names)
    first = _audited(CUSTOMER, "2024-01-01", 20240101, "base", "delimited")
    return f"""WITH {_fixture(CUSTOMER, "delimited")},
day1 AS ({first} WHERE {key} % 10 <> 9),{_classified(CUSTOMER, "day1")}
SELECT {names}, CASE WHEN {key} IN (SELECT {key} FROM changed) THEN 'N' ELSE 'Y' END AS "current", effectiveDate,
       CASE WHEN {key} IN (SELECT {key} FROM changed) THEN DATE '2024-01-31' END AS endDate, rowHash, partitionKey
FROM day1
UNION ALL {_batch_rows(CUSTOMER)}"""


def _column_change(before: Sequence[str], after: Sequence[str]) -> str:
    """Nine in ten base rows stored under some columns, then the batch under others: what
    both have decides, and each hash has the name of its column list."""
    key = CUSTOMER.key
    shared = [c for c in before if c in after]

    def hashed(columns: Sequence[str]) -> str:
        listed = json.dumps(["compat", *columns])
        return f"concat(left(sha256('{listed}'), 8), ':', {_hash(columns)})"

    stored = ", ".join(c if c in before else f"CAST(NULL AS VARCHAR) AS {c}" for c in after)
    return f"""WITH {_fixture(CUSTOMER)},
day1 AS (SELECT {stored}, {_hash(shared)} AS seen, {hashed(before)} AS rowHash FROM base WHERE {key} % 10 <> 9),
day2 AS (SELECT {', '.join(after)}, {_hash(shared)} AS seen, {hashed(after)} AS rowHash FROM r0),
fresh AS (SELECT b.* FROM day2 b LEFT JOIN day1 s ON b.{key} = s.{key} WHERE s.{key} IS NULL OR s.seen <> b.seen)
SELECT {', '.join(after)}, CASE WHEN {key} IN (SELECT {key} FROM fresh) THEN 'N' ELSE 'Y' END AS "current",
       DATE '2024-01-01' AS effectiveDate, CASE WHEN {key} IN (SELECT {key} FROM fresh) THEN DATE '2024-01-31' END AS endDate,
       rowHash, CAST(20240101 AS INTEGER) AS partitionKey FROM day1
UNION ALL
SELECT {', '.join(after)}, 'Y', DATE '2024-02-01', {NO_END}, rowHash, 20240201 FROM fresh"""


def _by_customer(select: str, key: str = "CAST(o_custkey AS VARCHAR)") -> str:
    """All orders keyed by customer against the last order of each."""
    columns = ("o_custkey", "o_orderstatus", "o_orderpriority")
    return f"""
WITH stored AS (
  SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority, 'Y' AS "current",
         DATE '2024-01-01' AS effectiveDate, {NO_END} AS endDate, {_hash(columns)} AS rowHash
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
raw AS (
  SELECT {key} AS o_custkey, o_orderstatus, o_orderpriority, 'Y' AS "current",
         DATE '2024-02-01' AS effectiveDate, {NO_END} AS endDate, {_hash(columns)} AS rowHash
  FROM orders),
classified AS (
  SELECT r.*, CASE WHEN s.o_custkey IS NULL THEN 'NewRows' ELSE 'CurrentRows' END AS rowType
  FROM raw r LEFT JOIN stored s ON r.o_custkey = s.o_custkey
  WHERE s.o_custkey IS NULL OR r.rowHash <> s.rowHash)
{select}"""


C_NAMES = ", ".join(CUSTOMER.names)
UNKEYED = "CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END"
RENAMED_NAMES = (
    "c_custkey AS id, c_name AS name, c_nationkey AS nation, CAST(c_acctbal AS DECIMAL(14,2)) AS balance,"
    " c_mktsegment AS segment"
)

_RESULTS: dict[str, str] = {
    "landing_scan": f"WITH {_base(CUSTOMER)} SELECT {C_NAMES} FROM base",
    "landing_rejects": f"""WITH {_base(CUSTOMER)},
texts AS (
  SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE c_nationkey::VARCHAR END AS nation,
         CASE WHEN c_custkey % 11 = 0 THEN '12x' ELSE c_acctbal::VARCHAR END AS balance FROM base)
SELECT CASE WHEN nation = 'n/a' OR balance = '12x' THEN concat_ws(',', c_custkey, c_name, nation, balance, c_mktsegment)
            ELSE c_custkey::VARCHAR END AS landed,
       concat_ws('; ', CASE WHEN nation = 'n/a' THEN 'c_nationkey is no int: n/a' END,
                 CASE WHEN balance = '12x' THEN 'c_acctbal is no decimal(12,2): 12x' END) AS reasons FROM texts""",
    "raw_projection": f"WITH {_base(CUSTOMER)} SELECT c_mktsegment, c_custkey, c_acctbal FROM base",
    "final_scan": _whole("SELECT * FROM final0"),
    "final_scan_typed": f"WITH {_base(CUSTOMER)}, audited AS ("
    + _audited(CUSTOMER, "2024-02-01", None, "base")
    + f") SELECT {RENAMED_NAMES}, {AUDIT} FROM audited",
    "final_partition_scan": _whole("SELECT * FROM final0 WHERE partitionKey IN (20240101, 20240102)"),
    "format_roundtrip": _whole(
        "SELECT f.*, v.format FROM final0 f CROSS JOIN (VALUES "
        + ", ".join(f"('{name}')" for name in ROUNDTRIP_FORMATS)
        + ") v(format)",
    ),
    "audit_columns": f"WITH {_base(CUSTOMER)} " + _audited(CUSTOMER, "2024-02-01", 20240201, "base"),
    "row_hash": f"WITH {_base(CUSTOMER)} SELECT c_custkey, {_hash(CUSTOMER.names)} AS rowHash FROM base",
    "row_hash_delimited": f"WITH {_base(CUSTOMER)} "
    f"SELECT c_custkey, {_hash(CUSTOMER.names, 'delimited')} AS rowHash FROM base",
    "row_hash_orders": f"WITH {_base(ORDERS)} "
    f"SELECT o_orderkey, {_hash(ORDERS.names, 'delimited')} AS rowHash FROM base",
    "close_rows": _whole(
        f"""SELECT {C_NAMES}, 'N' AS "current", effectiveDate, DATE '2024-01-31' AS endDate, rowHash, partitionKey
FROM final0 WHERE "current" = 'Y'""",
    ),
    "current_snapshot": _whole("""SELECT * FROM final0 WHERE "current" = 'Y'"""),
    "dedupe_batch": f"""
WITH n AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
         CAST(l_extendedprice AS {MONEY}) AS l_extendedprice FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC, l_extendedprice DESC) AS rn
  FROM n)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "classify_changes": _with(CUSTOMER, "SELECT * FROM classified"),
    "classify_changes_orders": _with(ORDERS, "SELECT * FROM classified"),
    "classify_changes_indexed": _with(CUSTOMER, "SELECT * FROM classified"),
    "scd2_merge_indexed": _with(CUSTOMER, _scd2(CUSTOMER)),
    "classify_changes_repeated_keys": _by_customer("SELECT * FROM classified"),
    "classify_changes_null_keys": _by_customer(
        "SELECT * FROM classified", UNKEYED
    ),
    "affected_partitions": _with(
        CUSTOMER,
        "SELECT DISTINCT pKey FROM classified UNION SELECT partitionKey FROM classified",
    ),
    "new_rows": _with(
        CUSTOMER,
        f"SELECT {C_NAMES}, {AUDIT}, partitionKey FROM classified WHERE rowType = 'NewRows'",
    ),
    "new_rows_null_keys": _by_customer(
        "SELECT * FROM raw WHERE o_custkey IS NULL OR o_custkey NOT IN "
        "(SELECT o_custkey FROM stored WHERE CAST(o_custkey AS BIGINT) % 5 <> 0)",
        UNKEYED,
    ),
    "changed_rows": _with(CUSTOMER, f"SELECT {C_NAMES}, {AUDIT}, partitionKey FROM changed"),
    "retained_rows": _with(
        CUSTOMER, "SELECT * FROM final0 WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)"
    ),
    "superseded_rows": _with(
        CUSTOMER,
        f"""SELECT {C_NAMES}, 'N' AS "current", effectiveDate, DATE '2024-01-31' AS endDate, rowHash, partitionKey
FROM final0 WHERE "current" = 'Y' AND c_custkey IN (SELECT c_custkey FROM changed)""",
    ),
    "scd1_merge": _with(CUSTOMER, _scd1(CUSTOMER)),
    "scd1_merge_partitioned": _with(CUSTOMER, _scd1(CUSTOMER)),
    "scd1_merge_table": _with(CUSTOMER, _scd1(CUSTOMER, partitioned=False)),
    "scd1_merge_bucketed": _with(CUSTOMER, _scd1(CUSTOMER, partitioned=False)),
    "scd1_merge_legacy_layout": _with(CUSTOMER, _scd1(CUSTOMER)),
    "scd1_merge_repeated_keys": _by_customer(
        "SELECT * FROM stored WHERE o_custkey NOT IN (SELECT o_custkey FROM classified WHERE rowType = 'CurrentRows') "
        "UNION ALL SELECT * EXCLUDE (rowType) FROM classified"
    ),
    "scd2_merge": _with(CUSTOMER, _scd2(CUSTOMER)),
    "scd2_merge_orders": _with(ORDERS, _scd2(ORDERS)),
    "scd2_merge_all_versions": _with(CUSTOMER, _scd2_all(CUSTOMER)),
    "scd2_merge_repeated_keys": _by_customer(
        """SELECT o_custkey, o_orderstatus, o_orderpriority, CASE WHEN hit THEN 'N' ELSE 'Y' END AS "current",
       effectiveDate, CASE WHEN hit THEN DATE '2024-01-31' END AS endDate, rowHash
FROM (SELECT *, o_custkey IN (SELECT o_custkey FROM classified WHERE rowType = 'CurrentRows') AS hit FROM stored)
UNION ALL SELECT * EXCLUDE (rowType) FROM classified"""
    ),
    "scd2_merge_partitioned": _with(CUSTOMER, _scd2(CUSTOMER)),
    "scd2_merge_partitioned_orders": _with(ORDERS, _scd2(ORDERS)),
    "scd2_merge_legacy_layout": _with(CUSTOMER, _scd2(CUSTOMER)),
    "scd2_merge_recovered": _with(CUSTOMER, _scd2(CUSTOMER)),
    "scd2_merge_renamed_keys": f"SELECT {RENAMED_NAMES}, {AUDIT}, partitionKey FROM ({_with(CUSTOMER, _scd2(CUSTOMER))})",
    "scd2_merge_table": _with(CUSTOMER, _scd2(CUSTOMER, partitioned=False)),
    "scd2_merge_bucketed": _with(CUSTOMER, _scd2(CUSTOMER, partitioned=False)),
    "scd2_merge_bucketed_partitioned": _with(CUSTOMER, _scd2(CUSTOMER)),
    "snapshot_scan": f"WITH {_fixture(CUSTOMER)} SELECT {', '.join(CUSTOMER.names)}, {AUDIT}, partitionKey FROM final0",
    "scd1_merge_snapshot": _with(CUSTOMER, _scd1(CUSTOMER, partitioned=False)),
    "scd2_merge_snapshot": _with(CUSTOMER, _scd2(CUSTOMER)),
    "scd2_merge_table_csv": _with(CUSTOMER, _scd2(CUSTOMER, partitioned=False)),
    "first_load": f"WITH {_base(CUSTOMER)} " + _audited(CUSTOMER, "2024-02-01", 20240201, "base"),
    "ingest_job": _ingest(),
    "ingest_job_incremental": _ingest(),
    "scd2_merge_added_column": _column_change(CUSTOMER.names[:-1], CUSTOMER.names),
    "scd2_merge_removed_column": _column_change(CUSTOMER.names, CUSTOMER.names[:-1]),
    "type0_append_incremental": f"WITH {_fixture(CUSTOMER)} "
    + _audited(CUSTOMER, "2024-01-01", 20240101, "base")
    + f" WHERE {CUSTOMER.key} % 10 <> 9 UNION ALL "
    + _audited(CUSTOMER, "2024-02-01", 20240201, "r0"),
    "type0_append": f"WITH {_fixture(CUSTOMER)} "
    + _audited(CUSTOMER, "2024-01-01", None, "base")
    + " UNION ALL "
    + _audited(CUSTOMER, "2024-02-01", None, "r0"),
    "type0_append_partitioned": f"WITH {_fixture(CUSTOMER)} "
    + _audited(CUSTOMER, "2024-01-01", 20240101, "base")
    + " UNION ALL "
    + _audited(CUSTOMER, "2024-02-01", 20240201, "r0"),
    "type0_ignore": f"WITH {_fixture(CUSTOMER)} " + _audited(CUSTOMER, "2024-01-01", 20240101, "base"),
    "type0_overwrite": f"WITH {_fixture(CUSTOMER)} "
    + _audited(CUSTOMER, "2024-01-01", 20240101, "base")
    + " UNION ALL "
    + _audited(CUSTOMER, "2024-02-01", 20240201, "r0"),
    "partition_overwrite": _whole(
        f"""SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN partitionKey = 20240101 THEN CAST(0 AS {MONEY}) ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       {AUDIT}, partitionKey FROM final0 WHERE partitionKey <> 20240102""",
    ),
}

NO_MONEY = (
    "landing_rejects",
    "row_hash",
    "row_hash_delimited",
    "row_hash_orders",
    "affected_partitions",
    "classify_changes_repeated_keys",
    "classify_changes_null_keys",
    "new_rows_null_keys",
    "scd1_merge_repeated_keys",
    "scd2_merge_repeated_keys",
)


def _shown(name: str, sql: str) -> str:
    """Money as text in the result, like the queries."""
    if name in NO_MONEY:
        return sql
    amount = ORDERS.amount if name.endswith("_orders") else CUSTOMER.amount
    if name == "dedupe_batch":
        amount = "l_extendedprice"
    if name in ("final_scan_typed", "scd2_merge_renamed_keys"):
        amount = "balance"
    return f"SELECT * REPLACE (CAST({amount} AS VARCHAR) AS {amount}) FROM ({sql})"


ORACLE_SQL: dict[str, str] = {name: _shown(name, sql) for name, sql in _RESULTS.items()}
