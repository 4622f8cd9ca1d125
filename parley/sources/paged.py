"""A REST service's pages as a data source, in batches and as a stream.

    spark.dataSource.register(Pages)
    spark.read.format("pages").option("url", ...).load()
    spark.readStream.format("pages").option("url", ...).option("pages", 10).load()

A page is {"results": [...], "next_cursor": ...}; a page without a next cursor is the last. A busy service (429 and 5xx) is asked again, ever more slowly, or when it says.

Batches: with ``ranges``, a comma-separated list of instants t0,t1,..tn, each task asks for one [t, t') by the parameters ``since`` and ``until``, and
follows that range's own cursors; without them a cursor can't be split and one task reads all.

Streams: the offset is the cursor up to which pages were read. A micro-batch follows at most ``pages`` cursors ahead, and its end is written to the checkpoint before its rows are
read, so after a failure the same cursors are read again: a sink that keeps a batch's number (K9) has each row once. At the last page the stream
waits there, and asks the same cursor again for rows that came since: ``seen`` rows of that page are behind it.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

BUSY = (429, 500, 502, 503, 504)


class Service:
    """What both readers ask: one page at a cursor."""

    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.tries, self.wait = options["url"], int(options.get("tries", "5")), float(options.get("wait", "1"))

    def page(self, cursor: str | None, **more: str) -> dict:
        asked = {k: v for k, v in {**more, "cursor": cursor}.items() if v}
        address = self.url + (("&" if "?" in self.url else "?") + urlencode(asked) if asked else "")
        for n in range(self.tries):
            try:
                with urllib.request.urlopen(address, timeout=60) as r:
                    return json.load(r)
            except urllib.error.HTTPError as e:
                if e.code not in BUSY or n + 1 == self.tries:
                    raise
                said = e.headers.get("Retry-After") or ""
                time.sleep(float(said) if said.replace(".", "", 1).isdigit() else self.wait * 2**n)
            except (urllib.error.URLError, TimeoutError):
                if n + 1 == self.tries:
                    raise
                time.sleep(self.wait * 2**n)
        raise RuntimeError("no tries")


def rows_of(page: dict, first: int = 0) -> Iterator[tuple]:
    for row in page.get("results", [])[first:]:
        yield str(row.get("id")), json.dumps(row, ensure_ascii=False)


@dataclass
class Slice(InputPartition):
    """Rows of a time range, or of the pages from one cursor on: ``most`` pages, the first without its first ``seen`` rows, of the last only up to ``until_row``."""

    since: str = ""
    until: str = ""
    cursor: str = ""
    seen: int = 0
    last: str | None = None
    until_row: int = 0


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.service = Service(options)
        self.edges = [x.strip() for x in options.get("ranges", "").split(",") if x.strip()]

    def partitions(self) -> list[InputPartition]:
        return [Slice(since=a, until=b) for a, b in zip(self.edges, self.edges[1:])] or [Slice()]

    def read(self, partition: Slice) -> Iterator[tuple]:
        cursor = None
        while True:
            page = self.service.page(cursor, since=partition.since, until=partition.until)
            yield from rows_of(page)
            cursor = page.get("next_cursor")
            if not cursor:
                return


class PageStream(DataSourceStreamReader):
    """Offsets are {"cursor": the page that is read next, "seen": its rows that are behind}. Where a batch ends is found by following
    cursors; rows are read by tasks."""

    def __init__(self, options: dict[str, str]) -> None:
        self.service, self.most = Service(options), int(options.get("pages", "10"))
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {"cursor": "", "seen": 0}

    def latestOffset(self) -> dict:
        at = dict(self.at or self.initialOffset())
        for _ in range(self.most):
            page = self.service.page(at["cursor"])
            if not page.get("next_cursor"):
                at["seen"] = max(at["seen"], len(page.get("results", [])))
                break
            at = {"cursor": page["next_cursor"], "seen": 0}
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.at is None:  # after a restart: go on behind what the checkpoint has
            self.at = end
        return [] if start == end else [Slice(cursor=start["cursor"], seen=start["seen"], last=end["cursor"], until_row=end["seen"])]

    def read(self, partition: Slice) -> Iterator[tuple]:
        cursor, seen = partition.cursor, partition.seen
        while True:
            page = self.service.page(cursor)
            if cursor == partition.last:
                page = {"results": page.get("results", [])[: partition.until_row]}
            yield from rows_of(page, seen)
            if cursor == partition.last or not page.get("next_cursor"):
                return
            cursor, seen = page["next_cursor"], 0

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "id string, body string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStream(self.options)
