"""A paged REST service as a source: a search, then a lookup of each item with its comments and reviews, kept as raw records.

Spark repeats lost tasks, and a lazy plan would ask the service again, so a snapshot writes what arrived as Parquet before anything uses it. Failures are rows, not exceptions.
The transport is a parameter: a function (url, headers, timeout) -> Answer, given to executors by its address "module:name".
"""

from __future__ import annotations

import importlib
import json
import os
import re
import secrets
import socket
import socketserver
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomspan.formats import DETAIL_FIELDS
from loomspan.operators.ingest import Raw, absent, typed_candidates
from loomspan.period import Period
from loomspan.storage import file_system

# What the service allows.
PAGE_SIZE = 100
SEARCH_CAP = 1000
ATTEMPTS = 4
TIMEOUT = 30.0

#: A header of kept answers: the least remaining number that the request's attempts saw.
LEAST = "loomspan-least-remaining"

SCHEMA = (
    "table string, item_kind string, repository string, number long, kind string, ordinal long, raw string, error string, url string, "
    "total_count long, incomplete boolean, partial_error string, failed boolean, remaining string"
)
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


@dataclass(frozen=True)
class Answer:
    status: int
    headers: dict[str, str]
    body: str


class RequestError(Exception):
    def __init__(self, message: str, url: str):
        super().__init__(message)
        self.url = url


@dataclass(frozen=True)
class Service:
    """Where and how to ask. The token stays in the environment of each process; rate is the starts a second of all tasks together, pace the address of their common schedule, ledger a shared folder of what was answered."""

    base: str
    org: str
    token_env: str
    since: str
    first_day: str
    last_day: str
    rate: float = 10.0
    workers: int = 8
    pace: str = ""
    ledger: str = ""
    transport: str = "loomspan.sources.rest:over_http"


def service_for(period: Period, base: str, org: str, token_env: str, **more) -> Service:
    return Service(base, org, token_env, period.utc_start.strftime("%Y-%m-%dT%H:%M:%SZ"), period.start_date, period.end_date, **more)


def over_http(url: str, headers: dict[str, str], timeout: float) -> Answer:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as got:
            return Answer(got.status, {k.lower(): v for k, v in got.headers.items()}, got.read().decode("utf-8"))
    except urllib.error.HTTPError as e:
        return Answer(e.code, {k.lower(): v for k, v in e.headers.items()}, e.read().decode("utf-8", "replace"))


class Schedule:
    """When requests may start: `rate` a second, later where a limit holds all back."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic):
        self.gap, self.clock, self.free_at, self.lock = 1.0 / rate, clock, float("-inf"), threading.Lock()

    def take(self) -> float:
        """Takes the next start and gives the seconds until then."""
        with self.lock:
            now = self.clock()
            at = max(self.free_at, now)
            self.free_at = at + self.gap
            return at - now

    def defer(self, pause: float) -> None:
        with self.lock:
            self.free_at = max(self.free_at, self.clock() + pause)


class SharedSchedule:
    """The schedule that the driver serves to all tasks, at host:port:secret. It takes part in a request's start alone, with a short exchange of one line."""

    def __init__(self, address: str):
        self.host, port, self.secret = address.rsplit(":", 2)
        self.port = int(port)

    def _ask(self, what: str) -> float:
        with socket.create_connection((self.host, self.port), timeout=TIMEOUT) as line:
            line.sendall(f"{self.secret} {what}\n".encode())
            return float(line.makefile().readline())

    def take(self) -> float:
        return self._ask("take")

    def defer(self, pause: float) -> None:
        self._ask(f"defer {pause}")


@contextmanager
def served(schedule: Schedule, host: str) -> Iterator[str]:
    """Serves a schedule while the block runs; gives its address."""
    secret = secrets.token_hex(16)

    class Handler(socketserver.StreamRequestHandler):
        def handle(self) -> None:
            given, what, *pause = self.rfile.readline(200).decode().split() or ["", ""]
            if not secrets.compare_digest(given, secret):
                return
            answer = schedule.take() if what == "take" else schedule.defer(float(pause[0])) or 0.0
            self.wfile.write(f"{answer}\n".encode())

    with socketserver.ThreadingTCPServer((host, 0), Handler) as server:
        server.daemon_threads = True
        threading.Thread(target=server.serve_forever, daemon=True).start()
        try:
            yield f"{host}:{server.server_address[1]}:{secret}"
        finally:
            server.shutdown()


class Ledger:
    """What a task's share of the service has answered, in a folder that all executors share: a repeated task reads it before it asks.

    Answers go to numbered files of lines (address, answer), each written under another name first and renamed when it is complete: after `most` answers or `seconds`, so a lost task loses these at most.
    In memory there are only the places of answers. Two runs of one task at once may keep an answer twice, which is no harm.
    """

    def __init__(self, folder: str, most: int = 50, seconds: float = 5.0, clock: Callable[[], float] = time.monotonic):
        self.fs, self.root = file_system(folder)
        self.most, self.seconds, self.clock, self.begun = most, seconds, clock, clock()
        self.fs.create_dir(self.root, recursive=True)
        self.held: list[str] = []
        self.places: dict[str, tuple[str, int, int]] = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root)):
            if info.path.endswith(".jsonl"):
                with self.fs.open_input_stream(info.path) as f:
                    at = 0
                    for line in f.read().splitlines(keepends=True):
                        self.places[json.loads(line)["url"]] = info.path, at, len(line)
                        at += len(line)

    def find(self, url: str) -> Answer | None:
        if (place := self.places.get(url)) is None:
            return None
        path, at, size = place
        with self.fs.open_input_file(path) as f:
            kept = json.loads(f.read_at(size, at))
        return Answer(kept["status"], kept["headers"], kept["body"])

    def keep(self, url: str, answer: Answer) -> None:
        self.held.append(json.dumps({"url": url, "status": answer.status, "headers": answer.headers, "body": answer.body}))
        if len(self.held) >= self.most or self.clock() - self.begun >= self.seconds:
            self.commit()

    def commit(self) -> None:
        if self.held:
            name = f"{self.root}/{uuid.uuid4().hex}"
            with self.fs.open_output_stream(f"{name}.partial", compression=None) as f:
                f.write("".join(x + "\n" for x in self.held).encode())
            self.fs.move(f"{name}.partial", f"{name}.jsonl")
        self.held, self.begun = [], self.clock()


class Client:
    """Paced requests with retries; `log` has one (failed, remaining) for each logical request. What a ledger has is not asked again, and counts as it did when it was."""

    def __init__(self, base: str, token: str, transport: Callable[..., Answer], rate: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, pace: SharedSchedule | None = None, ledger: Ledger | None = None):
        self.ledger = ledger
        self.base, self.transport, self.sleep = base.rstrip("/"), transport, sleep
        self.schedule = pace or Schedule(rate, clock)
        self.headers = {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {})
        self.log: list[tuple[bool, str | None]] = []

    def _wait(self) -> None:
        early = self.schedule.take()
        if early > 0:
            self.sleep(early)

    def get(self, path: str, **params) -> Answer:
        """Network errors, 429, 5xx and a 403 of the rate limit are tried again; a limit holds back the requests that follow too."""
        url = self.base + path + ("?" + urllib.parse.urlencode(params) if params else "")
        left: list[int] = []
        problem = ""
        if self.ledger and (kept := self.ledger.find(url)) is not None:
            self.log.append((False, kept.headers.get(LEAST)))
            return kept
        for attempt in range(ATTEMPTS):
            self._wait()
            pause, last = float(2**attempt), attempt == ATTEMPTS - 1
            try:
                answer = self.transport(url, self.headers, TIMEOUT)
            except OSError as e:
                problem = f"network error after {ATTEMPTS} attempts: {e}"
                if not last:
                    self.sleep(pause)
                continue
            remaining = answer.headers.get("x-ratelimit-remaining")
            if remaining is not None and re.fullmatch(r"-?\d+", remaining):
                left.append(int(remaining))
            after = answer.headers.get("retry-after")
            limited = answer.status == 429 or (answer.status == 403 and (remaining == "0" or after is not None))
            if answer.status < 400:
                self.log.append((False, str(min(left)) if left else None))
                if self.ledger:
                    self.ledger.keep(url, replace(answer, headers=answer.headers | ({LEAST: str(min(left))} if left else {})))
                return answer
            problem = f"GitHub API returned {answer.status}: " + ("GitHub API rate limit exhausted: " if answer.status == 403 and 0 in left else "") + _said(answer)
            if last or not (limited or answer.status >= 500):
                break
            pause = float(after) if after and after.isdigit() else pause
            if limited:
                self.schedule.defer(pause)
            else:
                self.sleep(pause)
        self.log.append((True, str(min(left)) if left else None))
        raise RequestError(problem, url)

    def load(self, path: str, shape: type, **params) -> tuple[object, Answer]:
        answer = self.get(path, **params)
        try:
            value = json.loads(answer.body)
        except ValueError:
            value = None
        if not isinstance(value, shape):
            self.log[-1] = (True, self.log[-1][1])
            raise RequestError(f"expected a JSON {'object' if shape is dict else 'array'}", self.base + path)
        return value, answer

    def all_pages(self, path: str, **params) -> list[dict]:
        """Every object of a list; a page that fails loses all of them."""
        out: list[dict] = []
        page, more = 1, True
        while more:
            items, answer = self.load(path, list, **params, per_page=PAGE_SIZE, page=page)
            out += [x for x in items if isinstance(x, dict)]
            more = len(items) == PAGE_SIZE and 'rel="next"' in answer.headers.get("link", "")
            page += 1
        return out

    def search(self, query: str) -> tuple[list[dict], int, bool, RequestError | None]:
        """Items, total, incomplete, and the error that ended the pages early. A request that fails later keeps the pages before it; what isn't a result list is an error at any page."""
        out: list[dict] = []
        total, incomplete, page = 0, False, 1
        while True:
            try:
                params = {"q": query, "sort": "updated", "order": "desc", "per_page": PAGE_SIZE, "page": page}
                before = len(self.log)
                value, _ = self.load("/search/issues", dict, **params)
            except RequestError as e:
                if page == 1 or str(e).startswith("expected") or len(self.log) == before:
                    raise
                return out, total, True, e
            items = value.get("items")
            if not isinstance(items, list):
                self.log[-1] = (True, self.log[-1][1])
                raise RequestError("expected a list of items", self.base + "/search/issues")
            total = int(value.get("total_count") or 0)
            incomplete |= bool(value.get("incomplete_results"))
            out += [x for x in items if isinstance(x, dict)]
            if len(items) < PAGE_SIZE or len(out) >= min(total, SEARCH_CAP):
                return out[:SEARCH_CAP], total, incomplete, None
            page += 1


def _said(answer: Answer) -> str:
    try:
        message = json.loads(answer.body).get("message")
    except (ValueError, AttributeError):
        message = answer.body[:500]
    return message or f"status {answer.status}"


def _client(service: Service, share: int, part: str = "") -> Client:
    module, name = service.transport.split(":")
    ledger = Ledger(f"{service.ledger}/{part}") if service.ledger else None
    return Client(service.base, os.environ.get(service.token_env, ""), getattr(importlib.import_module(module), name), service.rate / share, pace=SharedSchedule(service.pace) if service.pace else None, ledger=ledger)


def _row(table: str, **values) -> tuple:
    return tuple({"table": table, **values}.get(c) for c in COLUMNS)


def _requests(client: Client) -> Iterator[tuple]:
    yield from (_row("requests", failed=failed, remaining=remaining) for failed, remaining in client.log)


class _Kind(InputPartition):
    def __init__(self, kind: str):
        self.kind = kind


class _SearchReader(DataSourceReader):
    def __init__(self, service: Service):
        self.service = service

    def partitions(self) -> list[_Kind]:
        return [_Kind("issue"), _Kind("pull_request")]

    def read(self, partition: _Kind) -> Iterator[tuple]:
        s, kind = self.service, partition.kind
        client = _client(s, 2, kind)
        short = "pr" if kind == "pull_request" else "issue"
        try:
            items, total, incomplete, ended = client.search(f"org:{s.org} is:{short} updated:{s.first_day}..{s.last_day}")
        except RequestError as e:
            yield _row("searches", kind=kind, error=str(e), url=e.url)
        else:
            yield _row("searches", kind=kind, total_count=total, incomplete=incomplete, partial_error=str(ended) if ended else None, url=ended.url if ended else None)
            for ordinal, item in enumerate(items):
                yield _row("candidates", kind=kind, ordinal=ordinal, raw=json.dumps(item))
        if client.ledger:
            client.ledger.commit()
        yield from _requests(client)


class ItemSearch(DataSource):
    """Format item_search: one partition for each kind of item; options are the fields of Service."""

    @classmethod
    def name(cls) -> str:
        return "item_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(_from_options(dict(self.options)))


def _from_options(options: dict[str, str]) -> Service:
    names = {name.lower(): name for name in Service.__dataclass_fields__}
    given = {names[k.lower()]: v for k, v in options.items() if k.lower() in names}
    return Service(**given | {"rate": float(given["rate"]), "workers": int(given["workers"])})


def _look_up(client: Client, service: Service, kind: str, repository: str, number: int, covering: str | None) -> Iterator[tuple]:
    place = {"item_kind": kind, "repository": repository, "number": number}
    issue = f"/repos/{repository}/issues/{number}"
    base = issue if kind == "issue" else f"/repos/{repository}/pulls/{number}"
    if covering is not None:
        detail = json.loads(covering)
    else:
        try:
            detail, _ = client.load(base, dict)
        except RequestError as e:
            yield _row("details", **place, kind=kind, error=str(e), url=e.url)
            return
        yield _row("details", **place, kind=kind, raw=json.dumps(detail))
    since = {"since": service.since}
    reads = [("comment", f"{issue}/comments", since, detail.get("comments"))]
    if kind == "pull_request":
        reads += [("review", f"{base}/reviews", {}, None), ("review_comment", f"{base}/comments", since, detail.get("review_comments"))]
    for child, path, params, known in reads:
        if known == 0:
            continue
        try:
            records = client.all_pages(path, **params)
        except RequestError as e:
            yield _row("failures", **place, kind=child, error=str(e), url=e.url)
        else:
            for ordinal, record in enumerate(records):
                yield _row("children", **place, kind=child, ordinal=ordinal, raw=json.dumps(record))


def lookups(candidates: DataFrame, period: Period, service: Service) -> DataFrame:
    """Records of the candidates that the period doesn't rule out. All tasks keep to the common schedule; without one each of `workers` partitions has its share of the rate."""
    covering = (F.col("item_kind") == "issue") & (F.size(absent(F.col("raw"), (*DETAIL_FIELDS, "comments"))) == 0)
    asked = typed_candidates(candidates).where(~period.predates(F.col("seen_at"))).select("item_kind", "repository", "number", F.when(covering, F.col("raw")).alias("covering"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A repeated task has the number of the one before and, by its keys, the same share of the items.
        client = _client(service, service.workers, f"lookups-{TaskContext.get().partitionId()}")
        for batch in batches:
            for kind, repository, number, raw in batch.itertuples(index=False):
                rows = list(_look_up(client, service, kind, repository, int(number), raw if isinstance(raw, str) else None))
                rows += list(_requests(client))
                client.log.clear()
                yield pd.DataFrame(rows, columns=COLUMNS).astype(object)
        if client.ledger:
            client.ledger.commit()

    return asked.repartition(service.workers, "item_kind", "repository", "number").mapInPandas(read, SCHEMA)


def snapshot(spark: SparkSession, service: Service, period: Period, folder: str) -> Raw:
    """Ask the service once, write the raw zone to the folder, and return it as read from there. A ledger of the service's own is taken up again, as after a run that broke off."""
    host = spark.conf.get("spark.driver.host", "") or socket.gethostname()
    with served(Schedule(service.rate), host) as pace:
        return _snapshot(spark, replace(service, pace=pace, ledger=service.ledger or f"{folder}/ledger-{uuid.uuid4().hex}"), period, folder)


def _snapshot(spark: SparkSession, service: Service, period: Period, folder: str) -> Raw:
    spark.dataSource.register(ItemSearch)
    spark.read.format("item_search").options(**{k: str(v) for k, v in asdict(service).items()}).load().write.mode("overwrite").parquet(f"{folder}/search")
    found = spark.read.parquet(f"{folder}/search")
    candidates = found.where("table = 'candidates'").select("kind", "ordinal", "raw")
    lookups(candidates, period, service).write.mode("overwrite").parquet(f"{folder}/lookups")
    return from_snapshot(spark, folder)


def from_snapshot(spark: SparkSession, folder: str) -> Raw:
    found, read = spark.read.parquet(f"{folder}/search"), spark.read.parquet(f"{folder}/lookups")
    of = lambda df, table, *columns: df.where(F.col("table") == table).select(*columns)
    place = ["item_kind", "repository", "number", "kind"]
    return Raw(
        candidates=of(found, "candidates", "kind", "ordinal", "raw"),
        details=of(read, "details", "kind", "repository", "number", "raw", "error", "url"),
        children=of(read, "children", *place, "ordinal", "raw"),
        failures=of(read, "failures", *place, "error", "url"),
        searches=of(found, "searches", "kind", "total_count", "incomplete", "error", "partial_error", "url"),
        requests=of(found, "requests", "failed", "remaining").unionByName(of(read, "requests", "failed", "remaining")),
    )
