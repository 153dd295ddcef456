"""A data source of numbered pages of JSON: a cache first, then the site's folder.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").option("path", site).option("cache", folder).load()

Page 1 tells how many there are. Up to ``PARTITIONS`` pages are a partition each; more are dealt out in runs of up to ``RUN``
pages, as a task takes longer to begin than a page to be read. A page is read from the cache if that has it; a cached page that isn't JSON is as if it
weren't there. A page of the site is written to the cache, staged and renamed, so that a task that is run again finds the
same. A page that neither has, or that can't be parsed, is a row with its reason and no text. Options: ``refresh`` passes over
the cache and writes it anew; ``pages`` reads that many at most. Files are opened by Arrow's file systems.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _folder(uri: str) -> tuple[pa.fs.FileSystem, str]:
    system, path = pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"))
    return system, path.rstrip("/")


def _read(folder: tuple[pa.fs.FileSystem, str], page: int) -> str | None:
    """A page's text; None if there is none."""
    system, path = folder
    try:
        with system.open_input_stream(f"{path}/page_{page}.json") as f:
            return f.read().decode("utf-8", "replace")
    except FileNotFoundError:
        return None


def _parsed(text: str | None) -> object:
    try:
        return None if text is None else json.loads(text)
    except json.JSONDecodeError:
        return None


#: Partitions, as long as none of them has more than RUN pages.
PARTITIONS, RUN = 32, 1024


class Pages(InputPartition):
    """Pages ``first`` to ``last``."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.site, self.cache = options["path"], options.get("cache")
        self.refresh, self.most = options.get("refresh", "false").lower() == "true", int(options.get("pages", "0"))

    def fetch(self, page: int, site: tuple[pa.fs.FileSystem, str], cache: tuple[pa.fs.FileSystem, str] | None, store: bool = True) -> tuple[str, str | None]:
        """(where it is from, text); ``missing`` or ``corrupt`` without text. ``store``: into the cache."""
        if cache and not self.refresh:
            held = _read(cache, page)
            if _parsed(held) is not None:
                return "cache", held
        text = _read(site, page)
        if _parsed(text) is None:
            return "missing" if text is None else "corrupt", None
        if cache and store:
            system, path = cache
            staged = f"{path}/.page_{page}-{uuid.uuid4().hex}"
            with system.open_output_stream(staged) as f:
                f.write(text.encode())
            system.move(staged, f"{path}/page_{page}.json")
        return "site", text

    def folders(self) -> tuple[tuple[pa.fs.FileSystem, str], tuple[pa.fs.FileSystem, str] | None]:
        return _folder(self.site), _folder(self.cache) if self.cache else None

    def partitions(self) -> list[Pages]:
        first = _parsed(self.fetch(1, *self.folders(), store=False)[1])
        last = first.get("last_page") if isinstance(first, dict) else None
        last = last if isinstance(last, int) and last > 0 else 1
        last = min(last, self.most) if self.most else last
        run = min(RUN, -(-last // PARTITIONS))
        return [Pages(k, min(k + run - 1, last)) for k in range(1, last + 1, run)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        site, cache = self.folders()
        if cache:
            cache[0].create_dir(cache[1], recursive=True)
        for page in range(partition.first, partition.last + 1):
            yield (page, *self.fetch(page, site, cache))


def write_pages(pages: DataFrame, folder: str) -> None:
    """Pages (number, value) as files ``page_N.json``, each written by a task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _folder(folder)
        system.create_dir(path, recursive=True)
        for b in batches:
            for number, value in zip(*[c.to_pylist() for c in b.columns], strict=True):
                with system.open_output_stream(f"{path}/page_{number}.json") as f:
                    f.write(value.encode())
            yield b.select([0])

    pages.select("number", "value").mapInArrow(write, "number int").write.format("noop").mode("overwrite").save()


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "number int, origin string, raw string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)
