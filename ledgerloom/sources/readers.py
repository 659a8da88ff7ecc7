"""Raw inputs from distributed files (CSV or Parquet), conformed to the raw schema.

The source is a set of files per sheet (orders, people, returns). Header names
of the source sheets (with spaces, ``/`` and ``-``) are mapped to snake_case;
text cells equal to a missing marker become NULL; numbers written with a
locale (``'1 234,56'``) can be parsed; every column is cast to the declared
type so nothing is inferred.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import spread
from ..functions.columns import na_to_null, parse_locale_number, parse_timestamp
from ..schemas import (NA_MARKERS, RAW_ORDERS_SCHEMA, RAW_PEOPLE_SCHEMA, RAW_RETURNS_SCHEMA,
                       SOURCE_HEADERS)

OPTIONAL = ("row_id",)

# RFC 4180 text: quotes inside quoted cells are doubled, cells may hold line ends.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
CORRUPT = "_corrupt_record"

RAW_SCHEMAS = {
    "orders": RAW_ORDERS_SCHEMA,
    "people": RAW_PEOPLE_SCHEMA,
    "returns": RAW_RETURNS_SCHEMA,
}


def rename_headers(df: DataFrame, mapping: dict[str, str] = SOURCE_HEADERS) -> DataFrame:
    """Source header names → our column names; unknown columns keep their name."""
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def _columns(df: DataFrame, schema: T.StructType, locale_numbers: bool, strict: bool, na_markers: tuple[str, ...],
             date_formats: tuple[str, ...] | None) -> list[Column]:
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"missing columns {missing}; the sheet has {df.columns}")
    cols = []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        if isinstance(src, T.StringType):
            c = na_to_null(c, na_markers)
        if isinstance(f.dataType, T.StringType):
            out = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            out = parse_timestamp(c, date_formats, lenient=not strict)
        elif isinstance(src, T.StringType) and locale_numbers:
            out = parse_locale_number(c, strict=strict).cast(f.dataType)
        elif strict:
            out = c.cast(f.dataType)
        else:
            out = c.try_cast(f.dataType)
        cols.append(out.alias(f.name))
    return cols


def conform(df: DataFrame, schema: T.StructType, locale_numbers: bool = False,
            strict: bool = True, na_markers: tuple[str, ...] = NA_MARKERS,
            date_formats: tuple[str, ...] | None = None) -> DataFrame:
    """Cast ``df`` to ``schema`` column by column.

    Text columns: missing markers → NULL. Numeric columns read as text: markers
    → NULL, then either a locale parse (thousands ``' '``, decimal ``','``) or a
    plain cast. Dates are read as ISO text or by one of ``date_formats``
    (e.g. ``("M/d/yyyy",)``). ``strict`` raises on text that is not a number
    or date; otherwise such cells become NULL. ``row_id`` is optional; any other
    column of the schema that ``df`` lacks is an error (a misspelt header would
    otherwise load as NULL).
    """
    return df.select(*_columns(df, schema, locale_numbers, strict, na_markers, date_formats))


def files_with_open_lines(spark: SparkSession, path: str, quote: str = '"') -> tuple[list[str], list[str]]:
    """(files that may be split at any line end, files that hold one inside a cell).

    With doubled quotes a line of whole cells has an even number of quotes, and a cell
    that spans lines leaves an odd number in its first one. So a file whose lines all
    have an even number has no line end inside a cell. One split pass over the text
    decides it; the driver sees the names of the others.
    """
    text = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    odd = text.filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("file")).distinct()
    whole = {_path(r["file"]) for r in odd.toLocalIterator()}
    files = [_path(f) for f in text.inputFiles()]
    return [f for f in files if f not in whole], [f for f in files if f in whole]


def _path(uri: str) -> str:
    """The path of a file URI, which may have one or three slashes after its scheme."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


def _csv(spark: SparkSession, path: str, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """CSV as text columns under the header's names. Files that can be shown to hold no
    line end inside a cell are read split, the others whole; ``multiLine`` in the
    options decides for all files instead."""
    asked = {k.lower() for k in options}
    merged = {**CSV_OPTIONS, "inferSchema": "false", **options}

    def read(paths, multi: str) -> DataFrame:
        reader = spark.read.options(**{**merged, "multiLine": multi})
        return (reader.schema(schema) if schema else reader).csv(paths)
    doubled = merged["escape"] == merged["quote"] and not asked & {"linesep", "comment", "encoding", "charset"}
    if "multiline" in asked or not doubled:
        return read(path, next((v for k, v in options.items() if k.lower() == "multiline"), "true"))
    split, whole = files_with_open_lines(spark, path, merged["quote"])
    if not whole:
        return read(path, "false")
    if not split:
        return read(path, "true")
    return read(split, "false").unionByName(read(whole, "true"))


def read_sheet(spark: SparkSession, path: str, sheet: str, fmt: str = "csv",
               locale_numbers: bool = False, strict: bool = True,
               options: dict[str, str] | None = None,
               date_formats: tuple[str, ...] | None = None) -> DataFrame:
    """Read one sheet (``orders`` | ``people`` | ``returns``) from files.

    CSV is read as RFC 4180 text with the header row for names (no type inference)
    and conformed; ``strict`` fails on malformed rows; ``options`` override
    ``CSV_OPTIONS``. A large CSV file is split if no cell of it holds a line end,
    which one pass over its quotes proves (``multiLine`` in ``options`` skips it).
    Parquet keeps its types and is conformed the same way. A source
    of fewer splits than cores (one gzip file) is spread over the cores.
    """
    schema = RAW_SCHEMAS[sheet]
    if fmt == "csv":
        df = _csv(spark, path, {"mode": "FAILFAST" if strict else "PERMISSIVE", **(options or {})})
    else:
        df = spark.read.options(**(options or {})).format(fmt).load(path)
    df = spread(df)
    return conform(rename_headers(df), schema, locale_numbers=locale_numbers, strict=strict,
                   date_formats=date_formats)


def conform_with_rejects(df: DataFrame, schema: T.StructType, locale_numbers: bool = False,
                         na_markers: tuple[str, ...] = NA_MARKERS,
                         date_formats: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows in ``schema``, rejected rows): a row is rejected if a cell is no
    missing marker and yet no value of its column's type, or if ``df`` has the column
    ``_corrupt_record`` and it is set. Rejected rows keep every cell as text, with
    ``failed``, the names of the bad columns, and ``record``, the unreadable line.
    Good and rejected rows add up to the input."""
    cells = [f.name for f in schema.fields if f.name in df.columns]
    record = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    text = {c: F.col(c).cast("string") for c in cells}
    # both forms side by side in one row: expressions over the same scan
    typed = dict(zip(schema.names, _columns(df, schema, locale_numbers, False, na_markers, date_formats)))
    filled = {c: na_to_null(text[c], na_markers).isNotNull() for c in cells}
    failed = F.filter(F.array(*[F.when(filled[c] & typed[c].isNull(), F.lit(c)) for c in cells]), lambda x: x.isNotNull())
    both = df.select(F.struct(*typed.values()).alias("good"), F.struct(*[text[c].alias(c) for c in cells]).alias("raw"),
                     failed.alias("failed"), record.alias("record"))
    bad = (F.size("failed") > 0) | F.col("record").isNotNull()
    return both.filter(~bad).select("good.*"), both.filter(bad).select("raw.*", "failed", "record")


def read_sheet_with_rejects(spark: SparkSession, path: str, sheet: str, locale_numbers: bool = False,
                            options: dict[str, str] | None = None,
                            date_formats: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of one CSV sheet: ``read_sheet`` with nothing lost.
    A line with too few or too many cells is rejected whole (``record``)."""
    own = {"mode": "PERMISSIVE", **(options or {})}
    header = spark.read.options(**{**CSV_OPTIONS, **own}).csv(path).schema
    schema = T.StructType([*header.fields, T.StructField(CORRUPT, T.StringType())])
    df = spread(_csv(spark, path, {**own, "columnNameOfCorruptRecord": CORRUPT}, schema))
    return conform_with_rejects(rename_headers(df), RAW_SCHEMAS[sheet], locale_numbers, date_formats=date_formats)


def clean_raw_orders(df: DataFrame, strict: bool = True) -> DataFrame:
    """Raw orders already in our column names → declared raw schema."""
    return conform(df, RAW_ORDERS_SCHEMA, strict=strict)
