"""WARC archives: a distributed writer and a Python data source that reads them.

Writing is a DataFrame job: each record is one string column (header, HTTP
header, payload) and Spark's text writer puts ``\\r\\n\\r\\n`` behind each, which is
exactly a WARC file, on any file system Spark can write. Equal payloads are
stored once; the other records are ``revisit`` records that refer to it.

Reading is ``spark.read.format("warc")``. Partitions are planned from the file
sizes: small files share a partition, a file is never split (the writer bounds
its records). Predicates on record type and headers are pushed into the reader,
which parses a record's header first and seeks over the block of a record that
doesn't match, or whose payload the schema doesn't ask for. ``.gz`` files are
read as streams. Paths are opened through ``pyarrow.fs``, so local and remote
URIs work alike.

Defined results: null html is an empty payload; null url has no
WARC-Target-URI header, line ends in it are percent-encoded; null page_id is
written as an empty id, never holds other pages' payload and is a revisit if a
page with an id has its payload. Pages that repeat a page_id are records of their own, and
of equal ones all but those with the largest id are revisits. Spaces around a url are
kept; header bytes that aren't UTF-8 are read as ``\\xNN``. A file cut off in a record
raises. A very long payload is one record; a task holds 32 MB of payloads, or one. An
empty table gives no record. Other columns of the pages aren't looked at.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Scratch

# Column of the source -> header it comes from (fixed names of the WARC format).
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, content_type string, content_length long, headers map<string,string>, "
          "http_length long, payload binary")
END = "\r\n"


# --- writer ----------------------------------------------------------------

def _line(name: str, value) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def plan_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Pages with payload, its SHA-1 and length, and ``original``: the largest
    page_id with an equal payload of at least ``least_bytes``, else null."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("digest"),
                        F.octet_length(html).cast("long").alias("n_bytes"))
    scratch = Scratch(pages.sparkSession, "warc-plan")
    shared = scratch.table(
        rows.filter(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"), "shared")
    return rows.join(shared, ["digest", "n_bytes"], "left")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_warc(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z",
               records_per_file: int = 20_000, compression: str | None = None) -> None:
    """Write ``pages(page_id, url, html)`` as WARC/1.1 files under ``path``."""
    rows = plan_records(pages)
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
                    _line("Content-Length", F.col("n_bytes")), F.lit(END))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, F.concat(
            _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            _line("WARC-Refers-To", _urn(F.col("original"))))).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block)), F.lit(END))
    writer = (rows.select(F.concat(header, block).alias("value")).write
              .option("lineSep", END + END).option("maxRecordsPerFile", records_per_file))
    (writer.option("compression", compression) if compression else writer).text(path)


# --- reader ----------------------------------------------------------------

class Files(InputPartition):
    """Whole files that one task reads."""

    def __init__(self, paths: list[str]):
        self.paths = paths


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        parsed = urlparse(uri)
        if parsed.scheme == "file":
            return fs.LocalFileSystem(), parsed.path
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _test(f: Filter) -> tuple[str, Callable] | None:
    """(column, predicate) of a filter that a record header can answer."""
    column = ".".join(f.attribute) if hasattr(f, "attribute") else ""
    if column not in HEADERS and column != "content_length":
        return None
    value = getattr(f, "value", None)
    tests = {
        EqualTo: lambda x: x == value, In: lambda x: x in value,
        GreaterThan: lambda x: x > value, GreaterThanOrEqual: lambda x: x >= value,
        LessThan: lambda x: x < value, LessThanOrEqual: lambda x: x <= value,
        StringStartsWith: lambda x: x.startswith(value), StringEndsWith: lambda x: x.endswith(value),
        StringContains: lambda x: value in x, IsNotNull: lambda x: True,
    }
    if isinstance(f, IsNull):
        return column, lambda x: x is None
    test = tests.get(type(f))
    return None if test is None else (column, lambda x: x is not None and test(x))


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.bytes_per_partition = int(options.get("bytesPerPartition", 64 << 20))
        self.records_per_batch = int(options.get("recordsPerBatch", 512))
        self.tests: list[tuple[str, Callable]] = []
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Files]:
        store, path = _store(self.path)
        info = store.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(
            fs.FileSelector(path, recursive=True))
        found = [x for x in found if x.type == fs.FileType.File and x.size and x.base_name[0] not in "._"]
        out, size = [], 0
        for x in sorted(found, key=lambda x: x.path):
            if not out or size + x.size > self.bytes_per_partition:
                out.append([])
                size = 0
            out[-1].append(x.path)
            size += x.size
        return [Files(p) for p in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        names, schema = self.schema.names, to_arrow_schema(self.schema)
        tests = [_test(f) for f in self.filters]
        rows: list[dict] = []
        size = 0
        for path in partition.paths:
            for row in records(store, path, tests, "payload" in names, "http_length" in names):
                rows.append({k: row.get(k) for k in names})
                size += len(row.get("payload") or b"")
                if len(rows) >= self.records_per_batch or size > 32 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _head(f, what: str) -> dict[str, str]:
    """Header lines up to the empty one, names in lower case."""
    out = {}
    while True:
        line = f.readline()
        if not line.endswith(b"\n"):
            raise ValueError(f"{what}: cut off in a header")
        if line in (b"\r\n", b"\n"):
            return out
        name, _, value = line.rstrip(b"\r\n").decode("utf-8", "backslashreplace").partition(":")
        out[name.strip().lower()] = value.removeprefix(" ")  # as written: other spaces belong to the value


def records(store: fs.FileSystem, path: str, tests: list[tuple[str, Callable]],
            payload: bool = True, http: bool = True) -> Iterator[dict]:
    """Records of one file that pass all tests; blocks are skipped unless wanted."""
    raw = store.open_input_file(path)
    with (gzip.open(raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)) as f:
        while True:
            version = f.readline()
            while version in (b"\r\n", b"\n"):  # between records
                version = f.readline()
            if not version:
                return
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{path}: no record where one should start: {version[:40]!r}")
            head = _head(f, path)
            length = int(head["content-length"])
            row = {k: head.get(v) for k, v in HEADERS.items()}
            row |= {"content_length": length, "headers": head}
            wanted = all(test(row[c]) for c, test in tests)
            if not (wanted and (payload or http)):
                f.seek(length, 1)
            elif (row["content_type"] or "").startswith("application/http"):
                start = f.tell()
                f.readline()  # status line
                inner = _head(f, path)
                left = length - (f.tell() - start)
                row["http_length"] = int(inner["content-length"]) if "content-length" in inner else left
                row["payload"] = f.read(left) if payload else f.seek(left, 1) and None
                if payload and len(row["payload"]) != left:
                    raise ValueError(f"{path}: cut off in a payload")
            else:
                row["payload"] = f.read(length) if payload else f.seek(length, 1) and None
                row["http_length"] = length
            if wanted:
                yield row


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; ask for fewer columns with ``.schema(...)``:
    without ``payload`` the blocks are skipped."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA, **options) -> DataFrame:
    """Records under ``path``. Turns on Spark's filter push-down for Python data
    sources in this session."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: per page its payload size and
    digest (recomputed from stored payloads), record type and the page that a
    revisit refers to."""
    spark = pages.sparkSession
    path = Scratch(spark, "warc").root
    write_warc(pages, path)
    page = F.regexp_extract("record_id", "^<urn:page:(.+)>$", 1)
    number = lambda c: F.when(c != "", c).cast("long")
    responses = (read_warc(spark, path, "record_type string, record_id string, payload binary")
                 .filter("record_type = 'response'")
                 .select(number(page).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                         F.sha1("payload").alias("payload_digest"), "record_type",
                         F.lit(None).cast("long").alias("refers_to")))
    revisits = (read_warc(spark, path, "record_type string, record_id string, refers_to string, "
                                       "payload_digest string, http_length long")
                .filter("record_type = 'revisit'")
                .select(number(page).alias("page_id"), F.col("http_length").alias("payload_bytes"),
                        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
                        number(F.regexp_extract("refers_to", "^<urn:page:(.+)>$", 1)).alias("refers_to")))
    return responses.unionByName(revisits)
