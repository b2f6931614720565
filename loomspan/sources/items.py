"""Items and their child lists as tables of a paged service: scans that take filters with them.

`found_items` asks a search for each kind of item. Filters on the kind leave out searches, filters on updated_at narrow the days that a search asks for, so fewer pages are read; Spark still
tests the exact times. It needs spark.sql.python.filterPushdown.enabled. A scan that can't be read whole is an error; snapshots of sources.rest keep failures as rows instead.

Read as a stream, `found_items` goes on from a cursor: each batch has what was updated after the last time of the one before, up to the latest that the service then has. A search gives a thousand
results at most, so a time span with more is halved until none has; an item that is updated again comes again, and keep_last takes its last copy.

`child_lists` reads a table of items (item_kind, repository, number, and the known counts comments and review_comments) from Parquet: its partitions are that table's row groups, which any number of tasks
take, and each list is asked for page by page. A list whose count is known to be 0 isn't asked for, nor is a row group that has no other; a list of which any page fails is one row with its error.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from loomspan.sources.rest import PAGE_SIZE, SEARCH_CAP, RequestError, Service, _client, _from_options
from loomspan.storage import file_system

FOUND = "item_kind string, ordinal long, page int, updated_at timestamp, raw string"
CHILDREN = "item_kind string, repository string, number long, kind string, ordinal long, raw string, error string, url string"
#: CHILDREN as Arrow has it: rows go to Spark in batches of about so many, or of so many characters of records.
CHILD_ROWS = pa.schema([(c.split()[0], pa.int64() if c.endswith(" long") else pa.string()) for c in CHILDREN.split(", ")])
BATCH_ROWS, BATCH_CHARS = 5_000, 4 << 20
KINDS = {"issue": "issue", "pull_request": "pr"}


def _utc(value: datetime) -> datetime:
    return value.astimezone(UTC) if value.tzinfo else value.replace(tzinfo=UTC)


@dataclass
class Search(InputPartition):
    kind: str
    first_day: str
    last_day: str


class FoundReader(DataSourceReader):
    def __init__(self, service: Service):
        self.service = service
        self.kinds, self.first, self.last = list(KINDS), service.first_day, service.last_day

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "item_kind" and isinstance(f, EqualTo | In):
                wanted = f.value if isinstance(f, In) else (f.value,)
                self.kinds = [k for k in self.kinds if k in wanted]
                continue
            if name == "updated_at" and isinstance(f, GreaterThan | GreaterThanOrEqual | EqualTo):
                self.first = max(self.first, _utc(f.value).date().isoformat())
            if name == "updated_at" and isinstance(f, LessThan | LessThanOrEqual | EqualTo):
                self.last = min(self.last, _utc(f.value).date().isoformat())
            yield f

    def partitions(self) -> list[Search]:
        return [Search(k, self.first, self.last) for k in self.kinds if self.first <= self.last] or [Search("", self.first, self.last)]

    def read(self, partition: Search) -> Iterator[tuple]:
        if not partition.kind:
            return
        client = _client(self.service, len(KINDS))
        items, _, _, ended = client.search(_query(self.service, partition.kind, partition.first_day, partition.last_day))
        if ended is not None:
            raise ended
        for ordinal, item in enumerate(items):
            at = item.get("updated_at")
            yield partition.kind, ordinal, ordinal // PAGE_SIZE + 1, datetime.fromisoformat(at) if at else None, json.dumps(item)


@dataclass
class Span(InputPartition):
    """Times after the first, up to and with the last, as ISO texts to the second."""

    kind: str
    after: str
    last: str


class FoundStreamReader(DataSourceStreamReader):
    def __init__(self, service: Service):
        self.service = service

    def initialOffset(self) -> dict:
        return {"after": _iso(datetime.fromisoformat(self.service.first_day + "T00:00:00Z") - timedelta(seconds=1))}

    def latestOffset(self) -> dict:
        client, latest = _client(self.service, 1), self.initialOffset()["after"]
        for kind in KINDS:
            value, _ = client.load("/search/issues", dict, q=_query(self.service, kind, self.service.first_day, self.service.last_day), sort="updated", order="desc", per_page=1, page=1)
            latest = max([latest, *(x["updated_at"] for x in value["items"])])
        return {"after": latest}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return [Span(kind, start["after"], end["after"]) for kind in KINDS]

    def read(self, span: Span) -> Iterator[tuple]:
        client = _client(self.service, len(KINDS))
        open_ = [(datetime.fromisoformat(span.after) + timedelta(seconds=1), datetime.fromisoformat(span.last))]
        ordinal = 0
        while open_:
            first, last = open_.pop()
            if first > last:
                continue
            query = _query(self.service, span.kind, _iso(first), _iso(last))
            value, _ = client.load("/search/issues", dict, q=query, sort="updated", order="desc", per_page=1, page=1)
            if int(value.get("total_count") or 0) > SEARCH_CAP and first < last:
                middle = first + (last - first) // 2
                middle = middle.replace(microsecond=0)
                open_ += [(middle + timedelta(seconds=1), last), (first, middle)]
                continue
            items, total, _, ended = client.search(query)
            if ended is not None or total > len(items):
                raise ended or RequestError(f"{total} items of one second, of which a search gives {len(items)}", self.service.base)
            for item in items:
                yield span.kind, ordinal, ordinal // PAGE_SIZE + 1, datetime.fromisoformat(item["updated_at"]), json.dumps(item)
                ordinal += 1


def _iso(at: datetime) -> str:
    return at.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _query(service: Service, kind: str, first: str, last: str) -> str:
    return f"org:{service.org} is:{KINDS[kind]} updated:{first}..{last}"


class FoundItems(DataSource):
    @classmethod
    def name(cls) -> str:
        return "found_items"

    def schema(self) -> str:
        return FOUND

    def reader(self, schema) -> DataSourceReader:
        return FoundReader(_from_options(dict(self.options)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FoundStreamReader(_from_options(dict(self.options)))


@dataclass
class RowGroup(InputPartition):
    file: str
    number: int


class ChildReader(DataSourceReader):
    def __init__(self, service: Service, items: str):
        self.service, self.items = service, items

    def partitions(self) -> list[RowGroup]:
        fs, root = file_system(self.items)
        files = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
        footers = ((file, pq.read_metadata(file, filesystem=fs)) for file in sorted(files))
        return [RowGroup(file, k) for file, footer in footers for k in range(footer.num_row_groups) if self._asked(footer.row_group(k))] or [RowGroup("", 0)]

    @staticmethod
    def _asked(group) -> bool:
        """Whether any list of a row group may have rows: reviews of pull requests have no count, and a null count is none."""
        stats = {c.path_in_schema: c.statistics for c in (group.column(i) for i in range(group.num_columns))}
        none = lambda s: s is not None and s.has_min_max and s.has_null_count and not s.null_count and s.max == 0
        kind = stats.get("item_kind")
        return not (kind is not None and kind.has_min_max and kind.min == kind.max == "issue" and none(stats.get("comments")))

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for row in self._rows(partition):
            held.append(row)
            chars += len(row[5] or "")
            if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield _batch(held)
                held, chars = [], 0
        if held:
            yield _batch(held)

    def _rows(self, partition: RowGroup) -> Iterator[tuple]:
        if not partition.file:
            return
        fs, _ = file_system(self.items)
        client = _client(self.service, self.service.workers)
        names = ["item_kind", "repository", "number", "comments", "review_comments"]
        for batch in pq.ParquetFile(partition.file, filesystem=fs).iter_batches(1000, [partition.number], names):
            for item in batch.to_pylist():
                yield from self._lists(client, item)

    def _lists(self, client, item: dict) -> Iterator[tuple]:
        at = f"/repos/{item['repository']}/{{}}/{item['number']}/"
        since = {"since": self.service.since}
        lists = [("comment", at.format("issues") + "comments", since, item["comments"])]
        if item["item_kind"] == "pull_request":
            lists += [("review", at.format("pulls") + "reviews", {}, None), ("review_comment", at.format("pulls") + "comments", since, item["review_comments"])]
        place = item["item_kind"], item["repository"], item["number"]
        for kind, path, params, known in lists:
            if known == 0:
                continue
            try:
                records = client.all_pages(path, **params)
            except RequestError as e:
                yield (*place, kind, None, None, str(e), e.url)
            else:
                yield from ((*place, kind, k, json.dumps(r), None, None) for k, r in enumerate(records))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHILD_ROWS, strict=True)], schema=CHILD_ROWS)


class ChildLists(DataSource):
    @classmethod
    def name(cls) -> str:
        return "child_lists"

    def schema(self) -> str:
        return CHILDREN

    def reader(self, schema) -> DataSourceReader:
        options = dict(self.options)
        return ChildReader(_from_options(options), options["items"])


def _options(service: Service) -> dict[str, str]:
    return {k: str(v) for k, v in asdict(service).items()}


def found_items(spark: SparkSession, service: Service) -> DataFrame:
    spark.dataSource.register(FoundItems)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("found_items").options(**_options(service)).load()


def streamed_items(spark: SparkSession, service: Service) -> DataFrame:
    """The same as a stream, from the service's first day on."""
    spark.dataSource.register(FoundItems)
    return spark.readStream.format("found_items").options(**_options(service)).load()


def child_lists(spark: SparkSession, service: Service, items: str) -> DataFrame:
    spark.dataSource.register(ChildLists)
    return spark.read.format("child_lists").options(**_options(service), items=items).load()
