"""The elements of web pages as a data source: spark.read.format("elements").load(folder of Parquet files of pages).

The driver lists the files and cuts them into ranges of bytes, nothing else. A task takes the row groups whose middle
lies in its range, so each is read once. Comparisons of page_id and lists of types are pushed to the reader: row groups
whose statistics rule them out aren't read, pages that don't match aren't parsed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from leafworks.sources.html import BLOCK_TAG, SPACE_TAG, TAGS
from leafworks.sources.store import listing, opened, written_once

SCHEMA = "page_id long, seq int, type string, text string"
ARROW = pa.schema([("page_id", pa.int64()), ("seq", pa.int32()), ("type", pa.string()), ("text", pa.string())])
SPLIT_BYTES, BATCH_PAGES = 64 << 20, 256
#: Filters that the reader takes: the comparison, and whether a row group from low to high can hold a row.
COMPARED = {
    EqualTo: (pc.equal, lambda v, low, high: low <= v <= high), GreaterThan: (pc.greater, lambda v, low, high: high > v),
    GreaterThanOrEqual: (pc.greater_equal, lambda v, low, high: high >= v), LessThan: (pc.less, lambda v, low, high: low < v),
    LessThanOrEqual: (pc.less_equal, lambda v, low, high: low <= v),
}
#: The patterns of the column form; its classes are those of ASCII.
BLOCK, SPACE = (re.compile("(?a)" + p) for p in (BLOCK_TAG, SPACE_TAG))
NAME, TAG, BLANKS = re.compile("([A-Za-z0-9]+)\x02"), re.compile("<[^<>]*>"), re.compile("[ \t\r\n]+")


def elements(html: str | None) -> Iterator[tuple[int, str, str]]:
    """(seq, type, text) of the blocks of one page, as html.html_blocks() gives them."""
    if html is None:
        return
    for seq, part in enumerate(BLOCK.sub("\x01\\1\x02", html).split("\x01")):
        name = NAME.match(part)
        kind = TAGS.get(name[1].lower()) if name else None
        if kind and (text := BLANKS.sub(" ", TAG.sub("", SPACE.sub(" ", part[name.end() :]))).strip(" ")):
            yield seq, kind, text


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class ElementReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.report = options["path"], options.get("report")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.ids: list[Filter] = []
        self.types: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of page_id with a number, and equality of type and lists of types; returns the others."""
        for f in filters:
            if type(f) in COMPARED and f.attribute == ("page_id",) and f.value is not None:
                self.ids.append(f)
            elif isinstance(f, EqualTo | In) and f.attribute == ("type",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.types = wanted if self.types is None else self.types & wanted
            else:
                yield f

    def partitions(self) -> list[Range]:
        return [Range(path, at, at + self.split) for path, size in listing(self.path, ".parquet") for at in range(0, size, self.split)]

    def groups(self, file: pq.ParquetFile, part: Range) -> list[int]:
        """The row groups of the part that may hold a page that is asked for."""
        found, column = [], file.schema_arrow.names.index("page_id")
        for k in range(file.num_row_groups):
            group = file.metadata.row_group(k)
            chunks = [group.column(c) for c in range(group.num_columns)]
            begin = min(c.dictionary_page_offset or c.data_page_offset for c in chunks)
            middle, known = begin + sum(c.total_compressed_size for c in chunks) // 2, chunks[column].statistics
            ranged = known is not None and known.has_min_max
            if part.start <= middle < part.end and not (ranged and any(not COMPARED[type(f)][1](f.value, known.min, known.max) for f in self.ids)):
                found.append(k)
        return found

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there are no files
            return
        fs, _ = opened(self.path)
        pages = 0
        with pq.ParquetFile(fs.open_input_file(partition.path)) as file:
            groups = self.groups(file, partition)
            for b in file.iter_batches(BATCH_PAGES, row_groups=groups, columns=["page_id", "html"]) if groups else ():
                for f in self.ids:
                    b = b.filter(COMPARED[type(f)][0](b.column("page_id"), f.value))
                pages += len(b)
                rows = [(i, *e) for i, h in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist(), strict=True) for e in elements(h) if self.types is None or e[1] in self.types]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)
        if self.report:
            name = re.sub(r"\W+", "-", f"{partition.path}-{partition.start}")[-150:]
            out, folder = opened(self.report)
            out.create_dir(folder, recursive=True)
            written_once(out, f"{folder}/{name}.json", json.dumps({"path": partition.path, "start": partition.start, "row_groups": len(groups), "pages": pages}).encode())


class ElementSource(DataSource):
    """Options: path; split_bytes, the size of a task's range; report, a folder to which each task writes what it read."""

    @classmethod
    def name(cls) -> str:
        return "elements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ElementReader:
        return ElementReader(dict(self.options))


def read_elements(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(page_id, seq, type, text) of the pages in the Parquet files at path (page_id, html); filters reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ElementSource)
    return spark.read.format("elements").options(**options).load(path)
