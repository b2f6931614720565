"""Filters that reach the service, and child lists as partitions of a table of items."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThanOrEqual

from loomspan.plans.service import service
from loomspan.sources import recorded
from loomspan.sources.items import ChildReader, FoundReader, child_lists, found_items


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("recorded"))
    rows = [("issue" if k % 2 else "pr", f"1997-0{1 + k % 3}-{1 + k % 28:02d}T00:00:0{k % 10}Z", k) for k in range(900)]
    frame = spark.createDataFrame(rows, "kind string, updated_at string, number long")
    recorded.record(folder, found=frame.withColumn("raw", F.to_json(F.struct("number", "updated_at"))))
    return folder, rows


def test_a_narrow_scan_asks_for_fewer_pages(spark, found, monkeypatch):
    folder, rows = found
    whole = found_items(spark, service(folder))
    assert {(r.item_kind, r.page) for r in whole.collect()} == {(k, p) for k in ("issue", "pull_request") for p in range(1, 6)}
    narrow = whole.where("item_kind = 'issue' and updated_at >= timestamp '1997-02-10 00:00:00Z' and updated_at < timestamp '1997-02-20 12:00:00Z'")
    got = narrow.collect()
    want = {n for kind, at, n in rows if kind == "issue" and "1997-02-10T00:00:00Z" <= at < "1997-02-20T12:00:00Z"}
    assert {json.loads(r.raw)["number"] for r in got} == want and {r.page for r in got} == {1}
    assert narrow.rdd.getNumPartitions() == 1 and whole.rdd.getNumPartitions() == 2
    # The times are tested once more above the scan, as the service knows days alone; the kind is not.
    above = narrow._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert "updated_at" in above and "= issue" not in above


def test_filters_that_are_taken(found):
    at = lambda day: datetime(1997, 2, day, 5, tzinfo=UTC)
    reader = FoundReader(service(found[0]))
    kind, first, last, other = EqualTo(("item_kind",), "issue"), GreaterThan(("updated_at",), at(3)), LessThanOrEqual(("updated_at",), at(9)), GreaterThanOrEqual(("page",), 2)
    assert list(reader.pushFilters([kind, first, last, other])) == [first, last, other]
    assert [(p.kind, p.first_day, p.last_day) for p in reader.partitions()] == [("issue", "1997-02-03", "1997-02-09")]
    reader = FoundReader(service(found[0]))
    assert list(reader.pushFilters([In(("item_kind",), ("other",))])) == [] and [p.kind for p in reader.partitions()] == [""]


def test_a_scan_that_breaks_off_is_an_error(spark, found):
    with pytest.raises(Exception, match="nothing-here"):
        found_items(spark, service(found[0] + "/nothing-here")).collect()


def test_child_lists(spark, tmp_path):
    lists = [(path, k, f"1996-01-{1 + k % 28:02d}T00:00:00Z", json.dumps({"k": k}), fails) for path, n, fails in (("/repos/o/r/issues/1/comments", 250, None), ("/repos/o/r/pulls/2/reviews", 101, 2), ("/repos/o/r/pulls/2/comments", 3, None), ("/repos/o/r/issues/2/comments", 5, None), ("/repos/o/r/issues/3/comments", 4, None)) for k in range(n)]
    recorded.record(str(tmp_path), lists=spark.createDataFrame(lists, "path string, ordinal long, updated_at string, raw string, fails_at int"))
    items = [("issue", 1, None, None), ("pull_request", 2, 5, None), ("issue", 3, 0, None), ("pull_request", 4, None, 0)]
    spark.createDataFrame(items, "item_kind string, number long, comments long, review_comments long").withColumn("repository", F.lit("o/r")).write.parquet(str(tmp_path / "items"))
    got = child_lists(spark, service(str(tmp_path)), str(tmp_path / "items")).collect()
    counts = {}
    for r in got:
        counts.setdefault((r.number, r.kind), []).append((r.ordinal, r.error))
    assert {k: len(v) for k, v in counts.items()} == {(1, "comment"): 250, (2, "review"): 1, (2, "review_comment"): 3, (2, "comment"): 5}
    assert counts[2, "review"] == [(None, "GitHub API returned 404: gone")] and [o for o, _ in counts[1, "comment"]] == list(range(250))


def test_row_groups_without_lists_are_no_partitions(tmp_path):
    schema = pa.schema([("item_kind", pa.string()), ("repository", pa.string()), ("number", pa.int64()), ("comments", pa.int64()), ("review_comments", pa.int64())])
    groups = ([("issue", 0), ("issue", 0)], [("issue", 0), ("issue", None)], [("pull_request", 0)], [("issue", 3)])
    with pq.ParquetWriter(tmp_path / "a.parquet", schema) as out:
        for group in groups:
            out.write_table(pa.Table.from_pylist([{"item_kind": k, "repository": "o/r", "number": 1, "comments": n, "review_comments": 0} for k, n in group], schema))
    assert [p.number for p in ChildReader(service("x"), str(tmp_path)).partitions()] == [1, 2, 3]


def test_a_recording_is_answered_from_small_row_groups(spark, tmp_path, monkeypatch):
    """A process that answers never holds a bucket: lists lie by item in row groups of bounded size, and a list across two of them is whole."""
    monkeypatch.setattr(recorded, "GROUP_ROWS", 500)
    rows = spark.range(20_000).selectExpr("concat('/repos/o/r/issues/', id % 40, '/comments') as path", "id as ordinal", "'1996-01-01T00:00:00Z' as updated_at", "to_json(struct(id as k)) as raw", "cast(null as int) as fails_at")
    recorded.record(str(tmp_path), lists=rows)
    groups = [pq.read_metadata(f).row_group(k).num_rows for f in tmp_path.glob("lists/*/*.parquet") for k in range(pq.read_metadata(f).num_row_groups)]
    assert sum(groups) == 20_000 and max(groups) <= 500
    for number in range(40):
        pages = [json.loads(recorded.answer(f"{tmp_path}/repos/o/r/issues/{number}/comments?per_page=100&page={p}", {}, 1.0).body) for p in range(1, 7)]
        assert [x["k"] for page in pages for x in page] == list(range(number, 20_000, 40))
    assert json.loads(recorded.answer(f"{tmp_path}/repos/o/r/issues/999/comments", {}, 1.0).body) == []
    assert recorded._group.cache_info().maxsize <= 4
