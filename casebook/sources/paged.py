"""Cursor-paged record feed as a Python data source.

``spark.read.format("paged_feed")`` reads ``(id, data)`` documents from a
remote feed through an injected *fetcher* (``module:function`` option):

    fetch(entity, filters, cursor, limit) -> {"data": [record, ...],
                                              "cursors": {"next": str|None, "hasNext": bool}}

Parallelism: a cursor chain is sequential, so the feed is split into
*shards* - independent filters such as ``updatedAt`` sub-ranges - and each
shard is one input partition that follows its own cursor chain. A page loop
stops on an empty page, a missing cursor, or ``hasNext = false``. Each request
is retried in-task up to ``attempts`` times; Spark's task retry sits on top.

Filters (with ``spark.sql.python.filterPushdown.enabled``): an ``id = ...`` filter
becomes a point lookup. ``updatedAt`` bounds narrow the request to whole days and
are applied to the rows again by Spark. A record without an id has a NULL id.
"""

from __future__ import annotations

import datetime as _dt
import importlib
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, \
    GreaterThanOrEqual, InputPartition, LessThanOrEqual
from pyspark.sql.types import StructType

SCHEMA = "id string, updatedAt string, data string"


def load_fetcher(path: str):
    mod, _, fn = path.partition(":")
    return getattr(importlib.import_module(mod), fn)


def split_range(lo: str, hi: str, n: int) -> list[dict]:
    """``n`` contiguous, inclusive day ranges covering ``[lo, hi]``."""
    a, b = _dt.date.fromisoformat(lo), _dt.date.fromisoformat(hi)
    days = (b - a).days + 1
    n = max(1, min(n, days))
    out, start = [], a
    for i in range(n):
        size = days // n + (1 if i < days % n else 0)
        end = start + _dt.timedelta(days=size - 1)
        out.append({"modifiedAfter": start.isoformat(), "modifiedBefore": end.isoformat()})
        start = end + _dt.timedelta(days=1)
    return out


def split_hours(lo: str, hi: str, n: int) -> list[dict]:
    """``n`` contiguous, inclusive time ranges of whole hours covering the days ``[lo, hi]``."""
    start, hours = _dt.datetime.combine(_day(lo), _dt.time()), ((_day(hi) - _day(lo)).days + 1) * 24
    n = max(1, min(n, hours))
    edges = [start + _dt.timedelta(hours=hours * i // n) for i in range(n + 1)]
    return [{"modifiedAfter": a.isoformat(timespec="milliseconds") + "Z",
             "modifiedBefore": (b - _dt.timedelta(milliseconds=1)).isoformat(timespec="milliseconds") + "Z"}
            for a, b in zip(edges, edges[1:])]


def _day(text: str) -> _dt.date:
    return _dt.date.fromisoformat(text[:10])


class Shard(InputPartition):
    def __init__(self, filters: dict):
        super().__init__(json.dumps(filters, sort_keys=True))
        self.filters = filters


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}  # option names are case-insensitive
        self.options = options
        self.entity = options.get("entity", "conversations")
        self.limit = int(options.get("pagesize", "200"))
        self.attempts = int(options.get("attempts", "3"))
        self.fetcher = options["fetcher"]
        self.lo, self.hi = options.get("modifiedafter"), options.get("modifiedbefore")
        self.point: str | None = options.get("id")

    def pushFilters(self, filters):
        """Narrow the request; only an exact id lookup is taken off Spark's hands.

        Request ranges are whole days, so a pushed time bound still has to be applied to the rows, and it never
        widens a range that an option or another filter has set."""
        for f in filters:
            col = f.attribute[0] if getattr(f, "attribute", None) else None
            if isinstance(f, EqualTo) and col == "id" and self.point in (None, str(f.value)):
                self.point = str(f.value)
                continue
            if isinstance(f, GreaterThanOrEqual) and col == "updatedAt":
                self.lo = max(filter(None, (self.lo, str(f.value)[:10])))
            elif isinstance(f, LessThanOrEqual) and col == "updatedAt":
                self.hi = min(filter(None, (self.hi, str(f.value)[:10])))
            yield f

    def partitions(self):
        if self.point is not None:
            return [Shard({"id": self.point})]
        return [Shard(s) for s in self.shards(self.lo, self.hi)]

    def shards(self, lo: str | None, hi: str | None) -> list[dict]:
        """Independent filters that together cover the range, each once.

        A ``sharder`` option (``module:function``) is asked first; it gets (entity, filters, n). Else a range of days
        is split by day, or by hour where the feed takes times (``hours`` option) and days are too few. Open ends are
        split only for entities whose records all carry ``updatedAt`` (``timed`` option): the days since ``earliest`` in
        ranges, and all before and after by one shard each. Anything else is one cursor chain."""
        n = int(self.options.get("numpartitions", "1"))
        base = {k: v for k, v in (("modifiedAfter", lo), ("modifiedBefore", hi)) if v}
        if n <= 1 or (lo and hi and lo[:10] > hi[:10]):
            return [base]
        if self.options.get("sharder"):
            return load_fetcher(self.options["sharder"])(self.entity, base, n)
        if lo and hi:
            by_hour = self.options.get("hours") == "true"
            return split_hours(lo, hi, n) if by_hour and (_day(hi) - _day(lo)).days + 1 < n else split_range(lo, hi, n)
        if self.options.get("timed") != "true":
            return [base]
        today = _dt.date.today()
        first = _day(lo) if lo else min(_dt.date.fromisoformat(self.options.get("earliest", "2015-01-01")), _day(hi) if hi else today)
        last = _day(hi) if hi else max(today, first)
        out = split_range(first.isoformat(), last.isoformat(), n)
        if not lo:
            out.insert(0, {"modifiedBefore": (first - _dt.timedelta(days=1)).isoformat()})
        if not hi:
            out.append({"modifiedAfter": (last + _dt.timedelta(days=1)).isoformat()})
        return out

    def _request(self, fetch, filters, cursor):
        err = None
        for _ in range(self.attempts):
            try:
                return fetch(self.entity, filters, cursor, self.limit)
            except Exception as e:  # noqa: BLE001
                err = e
        raise err

    def read(self, partition: Shard) -> Iterator[tuple]:
        fetch = load_fetcher(self.fetcher)
        cursor = None
        while True:
            page = self._request(fetch, partition.filters, cursor) or {}
            data = page.get("data") or []
            for rec in data:
                key = rec.get("id")
                yield (None if key is None else str(key), rec.get("updatedAt"), json.dumps(rec))
            cur = page.get("cursors") or {}
            cursor = cur.get("next")
            if not data or not cursor or not cur.get("hasNext", False):
                return


class PagedStreamReader(DataSourceStreamReader):
    """Incremental sync (ST1): the offset is the time up to which records were read.

    Each micro-batch covers the days from the previous offset's to the current one, split into shards that the
    executors read in parallel (not a driver-side simple reader). The boundary day is read again by the next batch, so
    a record that arrives later on the same day is found; the downstream upsert makes the repeat harmless."""

    def __init__(self, options: dict):
        self.batch = PagedReader(options)
        self.start = self.batch.options.get("startingafter", "1970-01-01")

    def initialOffset(self) -> dict:
        return {"time": self.start}

    def latestOffset(self) -> dict:
        return {"time": _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")}

    def partitions(self, start: dict, end: dict):
        return [Shard(s) for s in self.batch.shards(start["time"][:10], end["time"][:10])]

    def read(self, partition: Shard) -> Iterator[tuple]:
        return self.batch.read(partition)

    def commit(self, end: dict) -> None:
        return None


class PagedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(PagedFeed)


DETAIL_SCHEMA = "id string, data string, error string"


def fetch_details(ids, fetcher: str, attempts: int = 3, partitions: int | None = None):
    """Per-id detail fetch (S3): ``ids`` (column ``id``) -> ``(id, data, error)``.

    Runs in Python tasks through ``mapInPandas``; an id that still fails after
    ``attempts`` tries keeps its error text instead of being dropped, so the
    caller can split good rows from a dead-letter set. ``partitions`` caps
    concurrent requests."""
    src = ids.select(ids["id"].cast("string").alias("id"))
    if partitions:
        src = src.repartition(partitions, "id")

    def run(batches):
        import pandas as pd

        fetch = load_fetcher(fetcher)
        for pdf in batches:
            data, errs = [], []
            for k in pdf["id"]:
                err, body = None, None
                for _ in range(attempts):
                    try:
                        got = fetch("conversation", {"id": k}, None, 1)
                        body, err = (json.dumps(got), None) if got else (None, "empty detail")
                        break
                    except Exception as e:  # noqa: BLE001
                        err = str(e) or type(e).__name__
                data.append(body)
                errs.append(err)
            yield pd.DataFrame({"id": pdf["id"], "data": data, "error": errs})

    return src.mapInPandas(run, DETAIL_SCHEMA)


PAGES_SCHEMA = "key string, id string, updatedAt string, data string, error string"


def fetch_pages_per_key(keys, fetcher: str, entity: str = "messages", key_filter: str = "conversationId",
                        page_size: int = 200, attempts: int = 3, partitions: int | None = None,
                        flush_rows: int = 2000):
    """Follow one cursor chain per key (S5: the messages of each conversation).

    ``keys`` has a ``key`` column; every key becomes the filter
    ``{key_filter: key}`` and its pages are read inside an executor task
    (``mapInPandas``), so millions of conversations spread over the cluster.
    Rows leave the task every ``flush_rows``, however long a chain is. A key whose
    chain fails after ``attempts`` tries keeps the records of the pages read and
    yields one more row with its error (dead letter) instead of failing the job."""
    src = keys.select(keys["key"].cast("string").alias("key"))
    if partitions:
        src = src.repartition(partitions, "key")
    opts = {"entity": entity, "pagesize": str(page_size), "attempts": str(attempts), "fetcher": fetcher}

    def run(batches):
        import pandas as pd

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["key", "id", "updatedAt", "data", "error"])

        reader = PagedReader(opts)
        for pdf in batches:
            out: list[tuple] = []
            for k in pdf["key"]:
                try:
                    for i, u, d in reader.read(Shard({key_filter: k})):
                        out.append((k, i, u, d, None))
                        if len(out) >= flush_rows:
                            yield frame(out)
                            out = []
                except Exception as e:  # noqa: BLE001
                    out.append((k, None, None, None, str(e) or type(e).__name__))
            yield frame(out)

    return src.mapInPandas(run, PAGES_SCHEMA)
