"""Headers of many files as one data source: one plan node and one input partition for each group of files.

    spark.dataSource.register(HeaderSource)
    spark.read.format("table_headers").option("paths", json.dumps({"orders": "/data/orders.parquet"})).load()

Rows are (source_file, file, name, type, position, n_rows, encoding, warning): one for each usable column of each file. Parquet gives
its footer; of a CSV the header line is kept, and the bytes are read in blocks to tell the encoding (UTF-8, or Latin-1 if any byte
does not decode) and to count lines, so memory stays small. A file that cannot be read, or has no usable column, gives one row with a
`warning` and no name, and a folder gives the rows of all its files. Equality, IN and prefix filters on `source_file` are taken over:
files of other tables are not opened. Names of files are listed on the driver, as Spark's own readers do; contents are read by tasks.
"""

from __future__ import annotations

import codecs
import csv
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from tablescout.sources.schema_scan import usable_header

HEADER_ROW = ("source_file string, file string, name string, type string, position int, n_rows long, encoding string, warning string")
GROUP = 64  # files of one input partition
BLOCK = 1 << 20  # bytes of a CSV held at once
HEADER_LIMIT = 1 << 24  # a header line longer than this is no header


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, str]]):
        super().__init__(len(files))
        self.files = files


def _open(path: str):
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner


def _parquet(stream) -> tuple[list[tuple[str, str]], int]:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type
    file = pq.ParquetFile(stream)
    columns = []
    for f in file.schema_arrow:
        try:
            kind = from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString()
        except Exception:  # a type Spark has no name for keeps its own
            kind = str(f.type)
        columns.append((f.name, kind))
    return columns, file.metadata.num_rows


def _csv(stream) -> tuple[list[tuple[str, str]], int, str]:
    """Columns, data lines (line breaks inside quotes count as lines) and encoding."""
    decoder, fine, head, lines, last = codecs.getincrementaldecoder("utf-8")(), True, b"", 0, b"\n"
    while block := stream.read(BLOCK):
        if b"\n" not in head:
            head += block
            if len(head) > HEADER_LIMIT and b"\n" not in head:
                raise ValueError("no header line")
            head = head.split(b"\n", 1)[0] + b"\n" if b"\n" in head else head
        lines, last = lines + block.count(b"\n"), block
        if fine:
            try:
                decoder.decode(block)
            except UnicodeDecodeError:
                fine = False
    if fine:
        try:
            decoder.decode(b"", True)
        except UnicodeDecodeError:
            fine = False
    encoding = "UTF-8" if fine else "ISO-8859-1"
    first = head.decode(encoding).removeprefix("﻿").removeprefix("ï»¿").rstrip("\r\n")
    names = next(csv.reader([first]), [])
    return [(n, "string") for n in names], max(lines + (not last.endswith(b"\n")) - 1, 0), encoding


def read_header(source: str, file: str, fmt: str) -> Iterator[tuple]:
    try:
        system, inner = _open(file)
        with system.open_input_file(inner) as stream:
            columns, n_rows, encoding = (*_parquet(stream), None) if fmt == "parquet" else _csv(stream)
    except Exception as e:  # one bad file must not stop the scan
        yield source, file, None, None, None, None, None, type(e).__name__
        return
    usable = [(name.strip(), kind, at) for at, (name, kind) in enumerate(columns) if usable_header(name)]
    for name, kind, at in usable:
        yield source, file, name, kind, at, n_rows, encoding, None
    if not usable:
        yield source, file, None, None, None, n_rows, encoding, "no columns"


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths, self.fmt = json.loads(options["paths"]), options.get("fileformat", "parquet")
        self.group, self.tests = int(options.get("groupsize", GROUP)), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and f.attribute == ("source_file",):
                self.tests.append(f)
            else:
                yield f

    def wanted(self, source: str) -> bool:
        return all(source == t.value if isinstance(t, EqualTo) else source in t.value if isinstance(t, In) else source.startswith(t.value)
                   for t in self.tests)

    def partitions(self) -> list[Files]:
        from pyarrow import fs
        files = []
        for source, path in self.paths.items():
            if not self.wanted(source):
                continue
            found = [path]
            try:
                system, inner = _open(path)
                if system.get_file_info(inner).type == fs.FileType.Directory:
                    inside = system.get_file_info(fs.FileSelector(inner, recursive=True))
                    prefix = path.rstrip("/")
                    found = sorted(prefix + i.path[len(inner.rstrip("/")):] for i in inside if i.is_file and not i.base_name.startswith(("_", ".")))
            except Exception:  # the task that opens it gives the warning
                pass
            files += [(source, f) for f in found]
        return [Files(files[a:a + self.group]) for a in range(0, len(files), self.group)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for source, file in partition.files:
            yield from read_header(source, file, self.fmt)


class HeaderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "table_headers"

    def schema(self) -> str:
        return HEADER_ROW

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options)


def file_headers(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", group: int = GROUP) -> DataFrame:
    """HEADER_ROW of every file below the paths."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HeaderSource)
    return (spark.read.format("table_headers").option("paths", json.dumps(paths)).option("fileFormat", fmt)
            .option("groupSize", str(group)).load())


def scan_headers(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", group: int = GROUP) -> DataFrame:
    """(source_file, name, dataset, type, n_rows) per column, rows summed over the files of a table."""
    found = file_headers(spark, paths, fmt, group).filter("name IS NOT NULL")
    return (found.groupBy("source_file", "name", "type").agg(F.sum("n_rows").alias("n_rows"))
            .select("source_file", "name", F.col("source_file").alias("dataset"), "type", "n_rows"))


def scan_warnings(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", group: int = GROUP) -> DataFrame:
    """(source_file, file, warning) of files that gave no column."""
    return file_headers(spark, paths, fmt, group).filter("warning IS NOT NULL").select("source_file", "file", "warning")
