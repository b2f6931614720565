"""The paged source over a transport without a network."""

from __future__ import annotations

import json
import urllib.parse
from datetime import UTC, datetime

import pytest

from loomspan.operators.ingest import ingest
from loomspan.period import build_period
from loomspan.sources.rest import Answer, Client, Ledger, RequestError, Schedule, SharedSchedule, _client, _look_up, served, service_for, snapshot

PERIOD = build_period(7, now=datetime(2026, 7, 16, 12, tzinfo=UTC))
IN = "2026-07-12T01:02:03Z"


def ok(value, **headers):
    return Answer(200, headers, json.dumps(value))


def pretend(url, headers, timeout):
    parts = urllib.parse.urlsplit(url)
    query = dict(urllib.parse.parse_qsl(parts.query))
    item = {"title": "t", "html_url": "h", "state": "open", "user": {"login": "ann"}, "created_at": IN, "updated_at": IN}
    if parts.path == "/search/issues":
        assert "updated:2026-07-10..2026-07-16" in query["q"]
        found = [{"number": n, "repository_url": "https://x/repos/o/r", **item, **({"comments": 0} if n == 1 else {})} for n in (1, 2, 3)]
        return ok({"total_count": 3, "items": found if "is:issue" in query["q"] else found[2:]}, **{"x-ratelimit-remaining": "30"})
    if parts.path == "/repos/o/r/issues/2/comments":
        assert query["since"] == "2026-07-09T16:00:00Z"
        page = int(query["page"])
        body = [{"user": {"login": "bob"}, "created_at": IN, "body": str(i)} for i in range(100 if page == 1 else 5)]
        return Answer(200, {"link": '<u>; rel="next"'} if page == 1 else {}, json.dumps([*body[:-1], "text"]))
    if parts.path == "/repos/o/r/issues/3/comments":
        return Answer(404, {}, '{"message": "no such thing"}')
    if parts.path.endswith(("/reviews", "/comments")):
        return ok([])
    return ok({**item, "number": int(parts.path.split("/")[-1])})


def test_snapshot(spark, tmp_path):
    service = service_for(PERIOD, "https://api.test", "o", "NO_SUCH_TOKEN", rate=1e6, workers=2, transport="tests.test_rest:pretend")
    made = ingest(snapshot(spark, service, PERIOD, str(tmp_path)), PERIOD)
    rows = {(r.item_kind, r.number): r for r in made.items.collect()}
    assert set(rows) == {("issue", 1), ("issue", 2), ("issue", 3), ("pull_request", 3)}
    assert rows["issue", 2].n_human == 103 and rows["issue", 1].n_human == 0
    assert rows["issue", 3].data_gaps == ["Could not collect comment data: GitHub API returned 404: no such thing"]
    summary = made.summary.first()
    # Conversation comments of the pull request are at the failing address too.
    assert (summary.failed_requests, summary.rate_limit_remaining, summary.issues, summary.pull_requests) == (2, 30, 3, 1)


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def client(answers, rate=10.0):
    clock, left = Clock(), list(answers)

    def transport(url, headers, timeout):
        got = left.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    return Client("https://x", "t", transport, rate, clock.sleep, lambda: clock.now), clock


def test_retries_and_pacing():
    c, clock = client([Answer(500, {}, ""), OSError("down"), ok({"a": 1}, **{"x-ratelimit-remaining": "7"}), ok({})])
    assert c.load("/a", dict)[0] == {"a": 1} and clock.slept == [1.0, 2.0]
    c.load("/b", dict)
    assert clock.slept[-1] == pytest.approx(0.1) and c.log == [(False, "7"), (False, None)]
    c, clock = client([Answer(429, {"retry-after": "9"}, ""), ok({})])
    c.load("/a", dict)
    assert clock.slept == [9.0]
    c, clock = client([Answer(403, {"x-ratelimit-remaining": "0"}, '{"message": "slow"}')] * 4)
    with pytest.raises(RequestError, match="rate limit exhausted: slow"):
        c.get("/a")
    assert c.log == [(True, "0")]
    c, clock = client([Answer(403, {}, "{}")])
    with pytest.raises(RequestError, match="403"):
        c.get("/a")
    c, _ = client([ok([1])])
    with pytest.raises(RequestError, match="JSON object"):
        c.load("/a", dict)


def test_a_limit_holds_back_all_that_share_a_schedule():
    clock = Clock()
    with served(Schedule(10.0, lambda: clock.now), "127.0.0.1") as address:
        one, two = (Client("https://x", "", lambda *a, left=left: left.pop(0), 10.0, clock.sleep, pace=SharedSchedule(address)) for left in ([Answer(429, {"retry-after": "9"}, ""), ok({})], [ok({}), ok({})]))
        two.get("/a")
        one.get("/a")  # waits for its turn, is held back, asks again
        two.get("/b")
        assert clock.slept == [pytest.approx(0.1), pytest.approx(9.0), pytest.approx(0.1)]
        host, port, _ = address.rsplit(":", 2)
        with pytest.raises(ValueError):
            SharedSchedule(f"{host}:{port}:guess").take()


def test_search_pages():
    full = [{"number": i} for i in range(100)]
    c, _ = client([ok({"total_count": 5000, "items": full})] * 10)
    items, total, incomplete, ended = c.search("q")
    assert (len(items), total, incomplete, ended) == (1000, 5000, False, None)
    c, _ = client([ok({"total_count": 300, "items": full}), Answer(404, {}, "{}")])
    items, _, incomplete, ended = c.search("q")
    assert len(items) == 100 and incomplete and "404" in str(ended)
    c, _ = client([ok({"total_count": 300, "items": full}), Answer(200, {}, "[")])
    with pytest.raises(RequestError):
        c.search("q")


class Lost(BaseException):
    """What ends a task at once."""


def test_a_repeated_task_asks_only_for_what_was_not_answered(tmp_path):
    asked: list[str] = []

    def run(lost_at=None, **more):
        service = service_for(PERIOD, "https://api.test", "o", "NO_SUCH_TOKEN", rate=1e6, ledger=str(tmp_path), transport="tests.test_rest:pretend", **more)
        client = _client(service, 1, "lookups-3")
        client.ledger.most = 4
        answer = client.transport

        def counted(url, headers, timeout):
            if len(asked) == lost_at:
                raise Lost
            asked.append(url)
            return answer(url, headers, timeout)

        client.transport = counted
        rows = [row for n in range(1, 7) for row in _look_up(client, service, "issue", "o/r", n, None)]
        return rows, list(client.log)

    whole, log = run()
    n = len(asked)
    again, log_2 = run()
    # The last answers that no full file held are asked for again, as the failed list is.
    assert again == whole and log_2 == log and len(asked) - n <= 4
    other = tmp_path / "other"
    other.mkdir()
    asked.clear()
    tmp_path = other
    with pytest.raises(Lost):
        run(lost_at=9)
    assert len(asked) == 9
    got, log_3 = run()
    assert got == whole and log_3 == log and len(asked) == n + 9 - 8


def test_a_ledger_keeps_whole_files_alone(tmp_path):
    ledger = Ledger(str(tmp_path), most=2)
    for k in range(5):
        ledger.keep(f"u{k}", Answer(200, {"a": "b"}, f"body {k} 中文"))
    (tmp_path / "torn.partial").write_text('{"url": "u9')
    again = Ledger(str(tmp_path))
    assert [again.find(f"u{k}") for k in (0, 3, 4, 9)] == [Answer(200, {"a": "b"}, "body 0 中文"), Answer(200, {"a": "b"}, "body 3 中文"), None, None]
    ledger.commit()
    assert Ledger(str(tmp_path)).find("u4") == Answer(200, {"a": "b"}, "body 4 中文")
