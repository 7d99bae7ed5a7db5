"""A paged source as a Spark data source: every page is a partition, so pages are read by tasks in parallel.

Pages come from ``<path>/<n>.json`` (an envelope with items and totalCount), which stands for a service here. A page
that is missing or says another total fails the read, so a partial answer never becomes a table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


def _body(path: str, number: int) -> dict:
    with open(f"{path}/{number}.json", encoding="utf-8") as f:
        answer = json.load(f)
    return answer.get("response", answer).get("body", answer)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.rows, self.columns = options["path"], int(options.get("rows", 100)), columns

    def partitions(self) -> list[Page]:
        self.total = int(_body(self.path, 1).get("totalCount", 0))
        return [Page(n) for n in range(1, max(1, math.ceil(self.total / self.rows)) + 1)]

    def read(self, page: Page) -> Iterator[tuple]:
        body = _body(self.path, page.number)
        items = body.get("items") or []
        items = items.get("item", []) if isinstance(items, dict) else items
        items = [items] if isinstance(items, dict) else items
        total = int(body.get("totalCount", 0))
        if len(items) != min(self.rows, max(0, total - self.rows * (page.number - 1))):
            raise ValueError(f"page {page.number} has {len(items)} of {total} rows")
        for at, item in enumerate(items):
            yield (self.rows * (page.number - 1) + at, *[None if item.get(c) is None else str(item[c]) for c in self.columns])


class PagedSource(DataSource):
    """``spark.read.format("paged").option("columns", "a,b").load(path)``; the first column is the place."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "_ingest_seq long, " + ", ".join(f"{c} string" for c in self.options["columns"].split(","))

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options, self.options["columns"].split(","))
