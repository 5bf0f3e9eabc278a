"""Declarative description of one dimension table and its load."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions import AUDIT_COLUMNS, CURRENT, EFFECTIVE, END, HASH, PARTITION, col
from tidemark.operators.changes import KNOWN, NULL_KEYS, ON_DUPLICATE, TAGS
from tidemark.operators.merge import CLOSE_SCOPES

DELTA = "delta"
FORMATS = ("csv", "txt", "parquet", "orc", DELTA)
TEXT_FORMATS = ("csv", "txt")
BUCKET_FORMATS = ("parquet", "orc")
SAVE_MODES = ("overwrite", "append", "ignore", "errorifexists", "error")
SCD_TYPES = (0, 1, 2)
DIALECTS = ("strict", "plain")
BAD_ROWS = ("error", "null", "quarantine")


def _one_of(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}, not {value!r}")


def _unbounded(schema: T.StructType) -> T.StructType:
    """Files know no length limits, so CHAR and VARCHAR are STRING."""
    bounded = T.CharType | T.VarcharType
    return T.StructType([T.StructField(f.name, T.StringType()) if isinstance(f.dataType, bounded) else f for f in schema])


@dataclass(frozen=True)
class TableSpec:
    """What to read, how to tell rows apart and how to keep them.

    ``raw_schema`` is the DDL of the landed files, by position for text files. Spark
    parses it, so a session must be there.
    ``columns`` are the business columns to keep (all of them by default): they
    make up the row hash, so adding one makes every row count as changed once, unless
    ``versioned_hash`` is set.
    """

    name: str
    keys: tuple[str, ...]
    raw_schema: str
    scd_type: int
    columns: tuple[str, ...] = ()
    # DDL of the stored business columns, where names or types differ from the landed
    # ones: by position, as many as ``columns``. Values are cast on the way in; the row
    # hash is of the landed ones, so it does not change with the stored types
    stored_schema: str = ""
    # the keys' names in the stored table, where they are not those of their position
    table_keys: tuple[str, ...] = ()
    partitioned: bool = False
    # how partition folders of a new table are named; existing ones keep their spelling
    partition_folder: str = PARTITION

    app_dir: str = ""
    table_dir: str = ""

    landing_pattern: str = "*"
    landing_format: str = "csv"
    landing_delimiter: str = ","
    landing_multiline: bool = False
    # a landed text that is no value of its column's type fails the load, or is NULL, or
    # sends its row to the table's reject folder
    bad_rows: str = "error"
    # the names in a file's header must be those of ``raw_schema``, in order
    check_header: bool = True

    table_format: str = "parquet"
    table_delimiter: str = ","
    table_multiline: bool = False
    # "strict" text tables read back exactly what was written; "plain" ones use
    # Spark's own CSV defaults, under which '' and NULL are one
    text_dialect: str = "strict"
    # keep bounds and bit maps of each partition's keys beside the table, so that a batch is
    # classified against the partitions that may hold its keys alone
    key_index: bool = False
    # cut the files of a new table into so many buckets by merge key, which spares the
    # stored side of large merges its shuffle; a table that is there keeps its own layout
    buckets: int | None = None
    # readers of a new table see whole publishes only, and so many of the last are kept
    snapshots: int | None = None
    # at most this many files per partition (per table when not partitioned)
    files_per_partition: int | None = None

    # Type 0 only: Type 1 and 2 always publish the whole new content
    save_mode: str = "append"

    hash_mode: str = "delimited"
    # name the column list of each hash, and compare a row with a stored one over the columns
    # that both have: columns may then come and go without changing every row
    versioned_hash: bool = False
    # remember which landed files the table holds, and load the others alone
    ledger: bool = False
    on_duplicate_keys: str = "error"
    dedupe_by: tuple[str, ...] = ()
    null_key_policy: str = "error"
    close_scope: str = "current"

    def __post_init__(self) -> None:
        raw = self.raw_struct.fieldNames()
        by_lower = {c.lower(): c for c in raw}
        for name in ("keys", "columns", "dedupe_by"):
            value = getattr(self, name)
            value = (value,) if isinstance(value, str) else value
            # names match in any case, as in Spark, and go by the raw schema's
            object.__setattr__(self, name, tuple(by_lower.get(c.lower(), c) for c in value))
        if not self.columns:
            object.__setattr__(self, "columns", tuple(raw))

        _one_of("scd_type", self.scd_type, SCD_TYPES)
        _one_of("landing_format", self.landing_format, FORMATS)
        _one_of("table_format", self.table_format, FORMATS)
        _one_of("save_mode", self.save_mode, SAVE_MODES)
        _one_of("hash_mode", self.hash_mode, ("delimited", "compat"))
        _one_of("on_duplicate_keys", self.on_duplicate_keys, ON_DUPLICATE)
        _one_of("null_key_policy", self.null_key_policy, NULL_KEYS)
        _one_of("close_scope", self.close_scope, CLOSE_SCOPES)
        _one_of("text_dialect", self.text_dialect, DIALECTS)
        _one_of("bad_rows", self.bad_rows, BAD_ROWS)
        if self.partition_folder.lower() != PARTITION.lower():
            raise ValueError(f"partition_folder must be a spelling of {PARTITION}")
        if self.bad_rows == "quarantine" and self.landing_format not in TEXT_FORMATS:
            raise ValueError("only landed text can hold rows for the quarantine")
        if self.on_duplicate_keys == "last" and not self.dedupe_by:
            raise ValueError("on_duplicate_keys='last' needs dedupe_by columns")
        if self.scd_type != 0 and not self.keys:
            raise ValueError("Type 1 and Type 2 need merge keys")
        if self.files_per_partition is not None and self.files_per_partition < 1:
            raise ValueError("files_per_partition must be at least 1")
        if self.buckets is not None:
            self._check_buckets()
        if self.snapshots is not None:
            self._check_snapshots()
        if self.versioned_hash:
            self._check_versioned()
        if self.ledger and DELTA in (self.table_format, self.landing_format):
            raise ValueError("a ledger is for plain landed files and tables")
        if self.ledger and self.scd_type == 0 and self.save_mode not in ("append", "overwrite"):
            raise ValueError("a ledger of a plain load goes with the save modes append and overwrite")

        for name in ("columns", "keys", "dedupe_by"):
            known = self.columns if name != "columns" else raw
            missing = [c for c in getattr(self, name) if c not in known]
            if missing:
                raise ValueError(f"{name}: {missing} are not among {list(known)}")
        if len({c.lower() for c in self.columns}) != len(self.columns):
            raise ValueError("columns repeat")
        self._match_stored()
        reserved = {c.lower() for c in (*AUDIT_COLUMNS, PARTITION, *TAGS, KNOWN)}
        clash = [c for c in (*self.columns, *self.stored_names) if c.lower() in reserved]
        if clash:
            raise ValueError(f"{clash} are names of audit columns")
        if self.table_format in TEXT_FORMATS:
            nested = [
                f.name
                for f in self.final_struct
                if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)
            ]
            if nested:
                raise ValueError(f"text tables cannot hold the nested columns {nested}")

    def _check_buckets(self) -> None:
        if self.buckets < 1:
            raise ValueError("buckets must be at least 1")
        if self.table_format not in BUCKET_FORMATS or self.scd_type == 0:
            raise ValueError(f"buckets are for Type 1 and Type 2 tables in one of {list(BUCKET_FORMATS)}")
        if self.files_per_partition is not None:
            raise ValueError("buckets settle the number of files; files_per_partition cannot")
        if self.may_repeat:
            raise ValueError("buckets need keys that do not repeat: 'keep' would put all rows of a key into one file")

    def _check_snapshots(self) -> None:
        if self.snapshots < 2:
            raise ValueError("snapshots must be at least 2: one to read while the next is written")
        if self.scd_type == 0 or self.table_format == DELTA:
            raise ValueError("snapshots are for Type 1 and Type 2 tables in plain files")
        if self.buckets is not None or self.key_index:
            raise ValueError("snapshots do not go with buckets or a key index")

    def _check_versioned(self) -> None:
        if self.scd_type == 0 or self.table_format not in BUCKET_FORMATS:
            raise ValueError(f"versioned_hash is for Type 1 and Type 2 tables in one of {list(BUCKET_FORMATS)}, read by name")
        if self.close_scope != "current":
            raise ValueError("versioned_hash goes with close_scope='current'")

    @property
    def may_repeat(self) -> bool:
        """Loads may leave a key, or no key, in any number of open rows."""
        return "keep" in (self.on_duplicate_keys, self.null_key_policy)

    def _match_stored(self) -> None:
        names = self.stored_names
        if len(names) != len(self.columns):
            raise ValueError(f"stored_schema has {len(names)} columns for {len(self.columns)}")
        if len({c.lower() for c in names}) != len(names):
            raise ValueError("columns of stored_schema repeat")
        by_lower = {c.lower(): c for c in names}
        given = (self.table_keys,) if isinstance(self.table_keys, str) else self.table_keys
        keys = tuple(by_lower.get(k.lower(), k) for k in given)
        own = tuple(names[self.columns.index(k)] for k in self.keys)
        if keys and keys != own:
            raise ValueError(f"table_keys {list(keys)} are not where the keys {list(self.keys)} are stored: {list(own)}")
        object.__setattr__(self, "table_keys", own)

    @property
    def stored_names(self) -> tuple[str, ...]:
        return tuple(T.StructType.fromDDL(self.stored_schema).fieldNames()) if self.stored_schema else self.columns

    def as_stored(self, audited: DataFrame) -> DataFrame:
        """Landed rows with audit columns, under the stored names and types."""
        if not self.stored_schema:
            return audited
        stored = T.StructType.fromDDL(self.stored_schema)
        business = [col(c).cast(f.dataType).alias(f.name) for c, f in zip(self.columns, stored, strict=True)]
        return audited.select(*business, *[col(c) for c in audited.columns[len(self.columns) :]])

    @property
    def raw_struct(self) -> T.StructType:
        """The landed schema."""
        return _unbounded(T.StructType.fromDDL(self.raw_schema))

    @property
    def final_struct(self) -> T.StructType:
        """Schema of the stored table: business columns, then audit columns."""
        if self.stored_schema:
            fields = list(_unbounded(T.StructType.fromDDL(self.stored_schema)))
        else:
            raw = {f.name: f for f in self.raw_struct}
            fields = [T.StructField(c, raw[c].dataType) for c in self.columns]
        fields += [
            T.StructField(CURRENT, T.StringType()),
            T.StructField(EFFECTIVE, T.DateType()),
            T.StructField(END, T.DateType()),
            T.StructField(HASH, T.StringType()),
        ]
        if self.partitioned:
            fields.append(T.StructField(PARTITION, T.IntegerType()))
        return T.StructType(fields)

    def _join(self, base: str, *parts: str) -> str:
        return "/".join([base.rstrip("/"), *[p.strip("/") for p in parts if p.strip("/")]])

    def landing_path(self, base: str) -> str:
        return self._join(base, self.app_dir, self.table_dir, self.landing_pattern)

    def table_path(self, base: str) -> str:
        return self._join(base, self.app_dir, self.table_dir or self.name)

    @classmethod
    def from_json(cls, text: str, **options) -> TableSpec:
        """Build a spec from a JSON load description of twenty string fields;
        ``options`` are further fields of the spec.

        Such tables were written as plain CSV with undelimited hashes under lower-case
        partition folders, and the spec keeps all three. ``sqlSelect`` names the landed
        columns to keep. ``finalFileSchema`` begins with as many stored ones, which
        take them by position under names and types of their own; its audit columns
        are read as this library's types.
        """
        conf = json.loads(text)
        if conf.get("sourceType", "file") != "file":
            raise ValueError(f"unknown sourceType {conf['sourceType']!r}")
        scd_type = conf["scdType"].lower()
        _one_of("scdType", scd_type, ("type0", "type1", "type2"))
        _one_of("isPartitioned", conf["isPartitioned"], ("Y", "N"))
        columns = tuple(c.strip() for c in conf["sqlSelect"].split(","))
        stored = T.StructType.fromDDL(conf["finalFileSchema"])
        audit = [f.name.lower() for f in stored[len(columns) :]]
        if audit[: len(AUDIT_COLUMNS)] != [c.lower() for c in AUDIT_COLUMNS]:
            raise ValueError("finalFileSchema must be a column for each of sqlSelect, then the audit columns")
        business = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored[: len(columns)])
        fields = {
            "name": conf["rawFileName"],
            "keys": (conf["rawFileMergeKey"].strip(),),
            "table_keys": (conf["currentTableMergeKey"].strip(),),
            "raw_schema": conf["rawFileSchema"],
            "scd_type": int(scd_type[-1]),
            "columns": columns,
            "stored_schema": business,
            "partitioned": conf["isPartitioned"] == "Y",
            "partition_folder": PARTITION.lower(),
            "app_dir": conf["appDir"],
            "table_dir": conf["tableDir"],
            "landing_pattern": conf["rawFilePattern"],
            "landing_format": conf["inFileType"].lower(),
            "landing_delimiter": conf["readDelim"],
            "table_format": conf["outFileType"].lower(),
            "table_delimiter": conf["writeDelim"],
            "text_dialect": "plain",
            "save_mode": conf["saveMode"].lower(),
            "hash_mode": "compat",
        }
        return cls(**(fields | options))
