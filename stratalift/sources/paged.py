"""A paged API as a Spark data source: its pages are input partitions.

The caller brings two functions, which run on the cluster:

``count_rows(request) -> int``      the row count the service reports (the probe)
``fetch_page(request) -> rows``     rows ``offset .. offset + limit``: an iterable of
                                    value sequences, or Arrow record batches

A page that fails, or has another number of rows than the service's count leaves for
it, fails its task; Spark retries it a bounded number of times and then fails
the job. A cluster asks for as many pages at once as it has cores; ``concurrent``
bounds that, as one partition then asks for several pages, one after the other.
"""

from __future__ import annotations

import dataclasses
import json
import sys
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

PAGE_ROWS = 100_000
PAUSE_SECONDS = 0.5

# Executors need no copy of this package: its classes travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclasses.dataclass(frozen=True)
class PageRequest:
    """What the service is asked for: a page of a report.

    The report covers the days ``start_date`` to ``end_date``, both inclusive
    and None where open, and the rows whose dimensions are in their lists.
    """

    offset: int
    limit: int
    in_lists: Mapping[str, Sequence[str]]
    start_date: str | None = None
    end_date: str | None = None


class PageReader(DataSourceReader):
    def __init__(self, source: type[DataSource], columns: Sequence[str], options: Mapping[str, str]):
        self.source = source
        self.columns = columns
        self.limit = int(options.get("limit", PAGE_ROWS))
        self.offset = int(options.get("offset", 0))
        self.pause = float(options.get("pause", PAUSE_SECONDS))
        self.concurrent = int(options.get("concurrent", 0))
        self.require_rows = options.get("requireRows", "true") == "true"
        self.in_lists = json.loads(options.get("inLists", "{}"))
        self.days = options.get("startDate"), options.get("endDate")

    def partitions(self) -> list[InputPartition]:
        total = self.source.count_rows(PageRequest(0, 1, self.in_lists, *self.days))
        if total == 0 and self.require_rows:
            raise ValueError("no rows found")
        starts = list(range(self.offset, total, self.limit))
        pages = [(start, min(self.limit, total - start)) for start in starts]
        if not pages:
            # an empty table still needs a partition, or Spark asks for the whole in one
            return [InputPartition([])]
        bound = min(self.concurrent or len(pages), len(pages))
        return [InputPartition(pages[k::bound]) for k in range(bound)]

    def read(self, partition: InputPartition) -> Iterator[Any]:
        for start, expected in partition.value:
            time.sleep(self.pause)
            request = PageRequest(start, self.limit, self.in_lists, *self.days)
            rows = 0
            for item in self.source.fetch_page(request):
                if hasattr(item, "schema"):
                    rows += item.num_rows
                    yield item
                else:
                    rows += 1
                    yield tuple(None if value is None else str(value) for value in item)
            if rows != expected:
                raise ValueError(f"page at {start} has {rows} rows instead of {expected}")


class PushingPageReader(PageReader):
    """Takes equality and membership filters on columns into the request."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for wanted in filters:
            if isinstance(wanted, (EqualTo, In)) and len(wanted.attribute) == 1:
                values = wanted.value if isinstance(wanted, In) else [wanted.value]
                field = wanted.attribute[0]
                texts = {str(v) for v in values if v is not None}
                if field in self.in_lists:
                    texts &= set(self.in_lists[field])
                self.in_lists = {**self.in_lists, field: sorted(texts)}
            else:
                yield wanted


def paged_source(
    name: str,
    columns: Sequence[str],
    count_rows: Callable[[PageRequest], int],
    fetch_page: Callable[[PageRequest], Iterable[Any]],
) -> type[DataSource]:
    """A data source class to register; its columns are text, dimensions then metrics.

    Read options: ``limit`` rows per page, first ``offset``, ``pause`` seconds
    before each page, pages ``concurrent`` at most, ``inLists`` as JSON, ``startDate``, ``endDate``,
    ``requireRows``, and ``pushdown``, which needs the session setting
    ``spark.sql.python.filterPushdown.enabled``.
    """
    return type(
        "PagedSource",
        (_PagedSource,),
        {
            "source_name": name,
            "columns": tuple(columns),
            "count_rows": staticmethod(count_rows),
            "fetch_page": staticmethod(fetch_page),
        },
    )


class _PagedSource(DataSource):
    source_name: str
    columns: tuple[str, ...]

    @classmethod
    def name(cls) -> str:
        return cls.source_name

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        pushing = self.options.get("pushdown", "false") == "true"
        reader = PushingPageReader if pushing else PageReader
        return reader(type(self), self.columns, self.options)


def read_pages(
    spark: SparkSession,
    source: type[DataSource],
    limit: int = PAGE_ROWS,
    offset: int = 0,
    pause: float = PAUSE_SECONDS,
    in_lists: Mapping[str, Iterable[Any]] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    require_rows: bool = True,
    concurrent: int | None = None,
) -> DataFrame:
    """Register the source and read all its pages; fields must be in all their lists.

    At most ``concurrent`` pages are asked for at once, each after a pause, so that a service
    sees no more than ``concurrent / pause`` requests a second on a cluster of any size.
    """
    lists = {field: sorted(map(str, values)) for field, values in (in_lists or {}).items()}
    spark.dataSource.register(source)
    days = {"startDate": start_date, "endDate": end_date}
    return (
        spark.read.format(source.name())
        .option("limit", limit)
        .option("offset", offset)
        .option("pause", pause)
        .option("concurrent", concurrent or 0)
        .option("inLists", json.dumps(lists))
        .option("requireRows", str(require_rows).lower())
        .options(**{name: day for name, day in days.items() if day is not None})
        .load()
    )
