"""Reader and writer options of the table formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import col
from tidemark.spec import TEXT_FORMATS, TableSpec

# Text tables that read back exactly as written
STRICT_TEXT = {
    "nullValue": "\\N",
    "lineSep": "\n",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

FILE, ROW_TEXT, REASONS = "landed_file", "landed_row", "landed_reasons"


def spark_format(name: str) -> str:
    """``txt`` is delimited text, which Spark calls csv."""
    return "csv" if name in TEXT_FORMATS else name


def table_options(spec: TableSpec) -> dict[str, str]:
    """Options of the stored table, the same for writing and for reading."""
    if spec.table_format not in TEXT_FORMATS:
        return {}
    options = {
        "header": "false",
        "sep": spec.table_delimiter,
        "multiLine": str(spec.table_multiline).lower(),
    }
    if spec.text_dialect == "strict":
        options |= STRICT_TEXT
    return options


def landing_options(spec: TableSpec) -> dict[str, str]:
    if spec.landing_format not in TEXT_FORMATS:
        return {}
    return {
        "header": "true",
        "sep": spec.landing_delimiter,
        "multiLine": str(spec.landing_multiline).lower(),
        # headers are compared with the schema's names, in order
        "enforceSchema": str(not spec.check_header).lower(),
    }


def landed_struct(spec: TableSpec) -> T.StructType:
    """What landed files are read as: text, where they are text."""
    if spec.landing_format not in TEXT_FORMATS:
        return spec.raw_struct
    return T.StructType([T.StructField(f.name, T.StringType()) for f in spec.raw_struct])


def typed_columns(schema: T.StructType, bad_rows: str) -> list[Column]:
    """Columns of text as the schema's types. Blank text is NULL. Text that is no value of
    the type fails the job, or with ``bad_rows="null"`` is NULL."""
    typed = []
    for field in schema:
        text = col(field.name)
        if isinstance(field.dataType, T.StringType):
            typed.append(text)
            continue
        value = text.try_cast(field.dataType)
        if bad_rows == "error":
            bad = value.isNull() & (F.trim(text) != "")
            refusal = F.raise_error(
                F.concat(F.lit(f"landed value of column {field.name} is no {field.dataType.simpleString()}: "), text)
            )
            value = F.when(bad, refusal.cast(field.dataType)).otherwise(value)
        typed.append(value.alias(field.name))
    return typed


def judged_columns(schema: T.StructType, delimiter: str) -> list[Column]:
    """Typed columns as `typed_columns` gives them with NULL for bad values, the row's file,
    its text, and why it is refused: a reason for each value that is none of its type."""
    reasons = []
    for field in schema:
        if not isinstance(field.dataType, T.StringType):
            text = col(field.name)
            bad = text.try_cast(field.dataType).isNull() & (F.trim(text) != "")
            said = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), text)
            reasons.append(F.when(bad, said))
    row = F.to_csv(F.struct(*[col(f.name) for f in schema]), {"sep": delimiter, "nullValue": ""})
    why = F.filter(F.array(*reasons), lambda r: r.isNotNull()) if reasons else F.array().cast("array<string>")
    return [
        *typed_columns(schema, "null"),
        F.col("_metadata.file_path").alias(FILE),
        row.alias(ROW_TEXT),
        why.alias(REASONS),
    ]


def rejects(judged: DataFrame) -> DataFrame:
    """The refused rows: their file, their text, and the reasons."""
    names = {FILE: "file", ROW_TEXT: "row", REASONS: "reasons"}
    return judged.where(F.size(REASONS) > 0).select(*[F.col(c).alias(n) for c, n in names.items()])


def writable(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df``, failing the job on a value the table's format would not give back.

    A text table is split at line ends unless it is read as multi-line, and its
    NULL marker cannot also be a value.
    """
    if spec.table_format not in TEXT_FORMATS:
        return df
    lost: list[Column] = []
    for field in df.schema:
        if not isinstance(field.dataType, T.StringType):
            continue
        value = col(field.name)
        if not spec.table_multiline:
            lost.append(value.contains("\n") | value.contains("\r"))
        if spec.text_dialect == "strict":
            lost.append(value == STRICT_TEXT["nullValue"])
    if not lost:
        return df
    message = (
        "a text value holds a line end or the NULL marker; "
        "set table_multiline or store the table as parquet or orc"
    )
    bad = F.coalesce(reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c in lost]), F.lit(False))
    return df.where(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))
