"""A paged source: a long listing in pages of a fixed number of rows, read in parallel.

`spark.read.format("item_pages").option("rows", n).option("page", 1000).schema(...).load(folder)` reads pages `page-00000.jsonl`, `page-00001.jsonl` and so on, as an export writes them.
Each partition is a run of pages; the last page is short or, where rows are a multiple of the page, full, and nothing is asked for beyond it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

PAGE, WORKERS = 1000, 5


@dataclass
class PageRange(InputPartition):
    first: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = schema.fieldNames()
        self.path = options["path"].rstrip("/")
        self.rows, self.page = int(options["rows"]), int(options.get("page", PAGE))
        self.workers = int(options.get("workers", WORKERS))

    def partitions(self) -> list[PageRange]:
        pages = -(-self.rows // self.page)
        each = max(1, -(-pages // max(1, self.workers)))
        return [PageRange(k, min(pages, k + each)) for k in range(0, pages, each)] or [PageRange(0, 0)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        from pyarrow import fs

        where = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        for k in range(partition.first, partition.end):
            with where[0].open_input_stream(f"{where[1]}/page-{k:05d}.jsonl") as page:
                rows = [json.loads(line) for line in page.read().decode().splitlines() if line.strip()]
            wanted = min(self.page, self.rows - k * self.page)
            if len(rows) != wanted:
                raise ValueError(f"page {k} has {len(rows)} rows, {wanted} were promised")
            yield from (tuple(row.get(c) for c in self.names) for row in rows)


class ItemPages(DataSource):
    """Fields that a row lacks are null; a page that is missing or has another number of rows than promised raises."""

    @classmethod
    def name(cls) -> str:
        return "item_pages"

    def schema(self) -> str:
        return "id_item string"

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(schema, self.options)


def paged(spark: SparkSession, folder: str, schema: str, rows: int, page: int = PAGE, workers: int = WORKERS) -> DataFrame:
    """A listing of so many rows from a folder of page files that all executors reach, in as many partitions as workers at most."""
    spark.dataSource.register(ItemPages)
    return spark.read.format("item_pages").schema(schema).option("rows", str(rows)).option("page", str(page)).option("workers", str(workers)).load(folder)
