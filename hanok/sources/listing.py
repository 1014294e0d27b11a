"""The landing zone's files as rows, listed by tasks: one per region folder. Unlike a scan it sees files without a byte."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_PAGE = re.compile(r"LAWD_CD=([^/]+)/DEAL_YM=([^/]+)/page=([0-9]+)\.csv$")
SCHEMA = "lawd_cd STRING, deal_ym STRING, page_no INT, size BIGINT, path STRING"


@dataclass
class RegionFolder(InputPartition):
    path: str


class PageListingReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[InputPartition]:
        """The region folders: five-digit codes, so a bounded list, from one listing of the root."""
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.root)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [RegionFolder(f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.Directory]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        from pyarrow import fs

        if partition is None:  # a root without region folders
            return
        files, _ = fs.FileSystem.from_uri(self.root)
        for f in files.get_file_info(fs.FileSelector(partition.path, recursive=True)):
            page = _PAGE.search(f.path)
            if page and f.type == fs.FileType.File:
                yield page[1], page[2], int(page[3]), f.size, f.path


class PageListing(DataSource):
    """``spark.read.format("landed_pages").load(root)``; ``root`` is a URI or an absolute path that ``pyarrow.fs`` opens."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageListingReader(self.options["path"])


def listed_pages(spark: SparkSession, root: str) -> DataFrame:
    """Key, size and path of every page file below ``root``, empty ones too."""
    spark.dataSource.register(PageListing)
    return spark.read.format("landed_pages").load(root.rstrip("/"))
