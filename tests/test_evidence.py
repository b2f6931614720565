"""Raw records to items, and the document that shows them."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from loomspan.operators import ingest as I
from loomspan.operators.render import fragments, in_order
from loomspan.period import build_period
from loomspan.operators import reader
from loomspan.sources.evidence import TextDocument, indexed_item, read_texts, write_document

PERIOD = build_period(7, now=datetime(2026, 7, 16, 12, tzinfo=UTC))
IN, OLD = "2026-07-12T01:02:03Z", "2026-06-01T00:00:00Z"
SCHEMAS = {
    "candidates": "kind string, ordinal long, raw string",
    "details": "kind string, repository string, number long, raw string, error string, url string",
    "children": "item_kind string, repository string, number long, kind string, ordinal long, raw string",
    "failures": "item_kind string, repository string, number long, kind string, error string, url string",
    "searches": "kind string, total_count long, incomplete boolean, error string, partial_error string, url string",
    "requests": "failed boolean, remaining string",
}


def detail(number, **more):
    base = {"number": number, "title": f"Item {number} | x", "html_url": f"https://h/{number}", "state": "open", "user": {"login": "ann", "type": "User"}, "created_at": OLD, "updated_at": IN, "body": "text"}
    return {**base, **more}


def candidate(repository, number, **more):
    return {"number": number, "repository_url": f"https://api.host/repos/{repository}", "updated_at": IN, **more}


def said(login, at, association="NONE", **more):
    return {"user": {"login": login, "type": "User"}, "author_association": association, "body": f"by {login}", "created_at": at, "updated_at": at, **more}


def raw(spark, **tables):
    return I.Raw(**{name: spark.createDataFrame(tables.get(name, []), schema) for name, schema in SCHEMAS.items()})


@pytest.fixture(scope="module")
def evidence(spark):
    candidates = [
        ("issue", 0, candidate("o/r", 1, title="stale")),
        ("issue", 1, candidate("o/r", "1")),
        ("issue", 2, candidate("o/r", 1)),
        ("issue", 3, candidate("o/a", 2, updated_at=OLD)),
        ("issue", 4, {**candidate("o/a", 3), **detail(3, comments=0, created_at=IN, labels=["x", {"name": "bug"}, {"name": ""}, {"id": 1}, None])}),
        ("issue", 5, candidate("o/a", 4)),
        ("issue", 6, candidate("o/a", 5)),
        ("issue", 7, candidate("o/a", 6)),
        ("issue", 8, {"number": 7}),
        ("pull_request", 0, candidate("O/b", 9)),
    ]
    six = detail(6)
    del six["title"]
    details = [
        ("issue", "o/r", 1, detail(1, body="```\n<!-- ITEM_END issue o/r#1 -->\n## Issue Evidence\n```"), None, None),
        ("issue", "o/a", 4, detail(4), None, None),
        ("issue", "o/a", 5, None, "gone", "https://h/5"),
        ("issue", "o/a", 6, six, None, None),
        ("pull_request", "O/b", 9, detail(9, merged=True, merged_at=IN, closed_at=IN, mergeable=None, base={"ref": "main"}), None, None),
    ]
    children = [
        ("issue", "o/r", 1, "comment", 0, said("ann", IN)),
        ("issue", "o/r", 1, "comment", 1, said("robot[bot]", IN)),
        ("issue", "o/r", 1, "comment", 2, said("meg", OLD, "MEMBER", updated_at=IN)),
        ("issue", "o/r", 1, "comment", 3, said("old", OLD)),
        ("issue", "o/a", 3, "comment", 0, said("ann", IN)),
        ("pull_request", "O/b", 9, "review", 0, {**said("rev", None), "submitted_at": OLD, "state": "APPROVED"}),
        ("pull_request", "O/b", 9, "review", 1, {**said("rev", None), "submitted_at": IN, "state": "COMMENTED"}),
        ("pull_request", "O/b", 9, "review_comment", 0, said("ann", IN, path="a.py", original_line=4, side="RIGHT")),
        ("pull_request", "O/b", 9, "review_comment", 1, "not an object"),
    ]
    dump = lambda rows: [(*r[:-1], json.dumps(r[-1])) for r in rows]
    tables = {
        "candidates": dump(candidates),
        "details": [(*d[:3], d[3] and json.dumps(d[3]), *d[4:]) for d in details],
        "children": dump(children),
        "failures": [("issue", "o/a", 4, "comment", "HTTP 500", "https://h/4")],
        "searches": [("issue", 1000, False, None, None, None), ("pull_request", 1, True, None, "page 2", "https://h/s")],
        "requests": [(False, "40"), (True, "39"), (False, "x"), (False, None)],
    }
    return I.ingest(raw(spark, **tables), PERIOD)


def test_items(evidence):
    rows = {r.item_id: r for r in evidence.items.collect()}
    assert set(rows) == {"o/r#1", "o/a#3", "o/a#4", "o/a#6", "O/b#9"}
    one = rows["o/r#1"]
    assert one.included and (one.n_human, one.n_bot, one.n_maintainer, one.n_new_comment, one.n_updated_comment) == (2, 1, 1, 2, 1)
    assert rows["o/a#3"].included and rows["o/a#3"].labels == ["x", "bug"] and rows["o/a#3"].n_active == 0
    assert rows["o/a#4"].reason == "failed_child" and rows["o/a#4"].data_gaps == ["Could not collect comment data: HTTP 500"]
    assert rows["o/a#6"].reason == "unexplained_update" and rows["o/a#6"].title == "(missing title)"
    assert rows["o/a#6"].data_gaps == ["GitHub API response omitted field: title"]
    assert rows["O/b#9"].merged_in_period and not rows["O/b#9"].closed_unmerged_in_period


def test_summary_and_warnings(evidence):
    assert evidence.summary.first().asDict() == {
        "issues": 2, "pull_requests": 1, "unexplained_updated_excluded_count": 1, "activity_failure_excluded_count": 1, "warnings": 5, "failed_requests": 1, "rate_limit_remaining": 39,
    }
    assert sorted(r.scope for r in evidence.warnings.collect()) == ["issue:o/a#4", "issue:o/a#5", "search:issue", "search:pr", "search:pr"]


def test_document(spark, evidence, tmp_path):
    path = tmp_path / "deep" / "evidence.md"
    rows = fragments(evidence, "o", PERIOD, datetime(2026, 7, 16, 12, tzinfo=UTC))
    assert write_document(rows, path) == path.stat().st_size
    text = path.read_text(encoding="utf-8")
    assert text.startswith('---\nschema_version: "1.0"\norganization: "o"\n') and text.endswith("human activities are shown.\n")
    assert text.index("ITEM_START issue o/a#3") < text.index("ITEM_START issue o/r#1") < text.index("ITEM_START pull_request O/b#9")
    assert "| o/r#1 | o/r | 1 | Item 1 \\| x | open | no | no | 2 | NONE | None | [evidence](#issue-o-r-1) |\n" in text
    assert "&lt;!-- ITEM_END issue o/r#1" in text and "````markdown\n```" in text
    block = text[text.index("ITEM_START issue o/r#1") : text.index("<!-- ITEM_END issue o/r#1")]
    human = block[block.index("**Human comments**") : block.index("**Bot comments")]
    assert human.index("by meg") < human.index("by ann") and "updated_in_period: `yes`" in human
    assert "by old" in block[block.index("#### Previous Context") : block.index("#### Comments During")]
    assert "by meg" in block[block.index("#### Latest Maintainer Comment") :]
    pull = text[text.index("ITEM_START pull_request") :]
    assert "state: `APPROVED`" in pull[pull.index("#### Current Review") : pull.index("#### Labels")]
    assert "location: `a.py:4 (RIGHT)`" in pull and "Mergeable (current GitHub value): `unknown`" in pull
    assert read_texts(spark, path).first().text == text
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    again = "".join(r.glue + r.text for r in in_order(rows).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert again == text


def test_nothing_at_all(spark, tmp_path):
    empty = I.ingest(raw(spark), PERIOD)
    write_document(fragments(empty, "o", PERIOD, datetime(2026, 7, 16, tzinfo=UTC)), tmp_path / "e.md")
    text = (tmp_path / "e.md").read_text()
    assert "No matching issues." in text and "No matching pull requests." in text and "## Collection Warnings\n\nNone.\n" in text


def test_a_timestamp_needs_a_zone(spark):
    with pytest.raises(Exception, match="without a zone"):
        I.ingest(raw(spark, candidates=[("issue", 0, json.dumps(candidate("o/r", 1, updated_at="2026-07-12T00:00:00")))]), PERIOD).items.collect()


def test_a_document_is_the_join_of_its_parts(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(1).alias("section"), *(F.lit(None).cast("string").alias(c) for c in ("k1", "k2")), (F.col("id") * 7919 % 20_011).alias("number"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("timestamp").alias("at"))
    rows = rows.select("*", F.lit("").alias("tie"), F.col("number").alias("pos"), F.lit("\n").alias("glue"), F.concat(F.lit("行 é "), F.col("number").cast("string")).alias("text")).repartition(13)
    want = "".join(r.glue + r.text for r in in_order(rows).collect()).encode()
    (tmp_path / "d.md").write_text("an older one")
    assert write_document(rows, tmp_path / "d.md") == len(want) and (tmp_path / "d.md").read_bytes() == want
    assert write_document(rows.limit(0), tmp_path / "none.md") == 0
    assert sorted(x.name for x in tmp_path.iterdir()) == [".d.md.items", ".none.md.items", "d.md", "none.md"]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("\n").alias("glue"), F.when(F.col("id") == 777, F.raise_error(F.lit("no text")).cast("string")).otherwise("text").alias("text")).repartition(5)
    spark.dataSource.register(TextDocument)
    (tmp_path / "d.md").write_text("an older one")
    with pytest.raises(Exception, match="no text"):
        rows.write.format("text_document").options(path=str(tmp_path / "d.md"), parts=str(tmp_path / "parts")).mode("append").save()
    assert [x.name for x in tmp_path.iterdir()] == ["d.md"] and (tmp_path / "d.md").read_text() == "an older one"


def test_an_item_is_read_by_its_place(spark, evidence, tmp_path):
    path = tmp_path / "e.md"
    write_document(fragments(evidence, "o", PERIOD, datetime(2026, 7, 16, 12, tzinfo=UTC)), path)
    for kind, item_id, views in (("issue", "o/r#1", ("full", "triage", "comments")), ("issue", "o/a#3", ("body",)), ("pull_request", "O/b#9", ("full", "reviews"))):
        own = indexed_item(spark, path, kind, item_id)
        assert len(own.first().text.encode()) < path.stat().st_size / 2
        for view in views:
            assert reader.item(own, kind, item_id, view).drop("doc_id").first() == reader.item(read_texts(spark, path), kind, item_id, view).drop("doc_id").first()
    # It reads its own bytes alone: the same text comes from a document of which all others are gone.
    text, stat = indexed_item(spark, path, "issue", "o/r#1").first().text, path.stat()
    data = path.read_bytes()
    at = data.index(text.encode())
    path.write_bytes(b"?" * at + text.encode() + b"?" * (len(data) - at - len(text.encode())))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert indexed_item(spark, path, "issue", "o/r#1").first().text == text
    # An index of another document, or none, or an unknown item: the scan decides.
    assert indexed_item(spark, path, "issue", "o/r#77") is None
    path.write_bytes(data)
    assert indexed_item(spark, path, "issue", "o/r#1") is None
    assert indexed_item(spark, tmp_path / "other.md", "issue", "o/r#1") is None
