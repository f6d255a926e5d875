"""Saved pages out: one file per page, named as ``read_pages`` reads them.

Spark's own writers choose the names of their files. This data source names each file after its row,
``<page_type>/<id>_<slug>.html``. Executors write side by side, each file under a hidden name first and then moved to its own,
so that a reader never finds half a page and a task that runs again leaves the same files.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "page_files"
FIELDS = ("college_id", "slug", "page_type", "html")

# the workers get this by value: they need not find the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Saved(WriterCommitMessage):
    pages: int


class PageFileWriter(DataSourceWriter):
    """Writes the rows of a task into a folder that every executor reaches, by path or address."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[Row]) -> Saved:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        folders, pages = set(), 0
        for row in iterator:
            folder = f"{root}/{row['page_type']}"
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            name = f"{row['college_id']}_{row['slug']}.html"
            hidden = f"{folder}/.{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out:
                out.write((row["html"] or "").encode())
            store.move(hidden, f"{folder}/{name}")
            pages += 1
        return Saved(pages)


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in FIELDS)

    def writer(self, schema: T.StructType, overwrite: bool) -> PageFileWriter:
        if overwrite:
            raise ValueError("pages are added; choose another folder to begin anew")
        return PageFileWriter(self.options["path"])


def write_pages(pages: DataFrame, path: str) -> None:
    """Save pages as files; a page saved before is replaced. Rows whose id is no number, or whose slug or type no file name, have no file."""
    named = F.col("college_id").rlike(r"^\d+$") & F.col("slug").rlike(r"^[^/\\]+$") & F.col("page_type").rlike(r"^\w+$")
    pages.sparkSession.dataSource.register(PageFiles)
    pages.select(*FIELDS).filter(named).write.format(FORMAT).mode("append").option("path", path).save()
