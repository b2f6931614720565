"""Views of evidence documents and rules of reports, over texts made of whole tables by SQL that both engines read.

Each supplier gives an evidence document, each part a report with the fault that its size picks. What a view or rule must say is composed, not parsed, in the expected rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan import formats as K
from loomspan.operators import reader, report_rules
from loomspan.plans.registry import query, table
from loomspan.sources.split_lines import split_lines
from loomspan.storage import scratch

NAME = "s_name"


def text_of(*lines: str) -> str:
    """SQL of the lines' text, each with its end; {} stands for the supplier's name."""
    parts = [" || ".join(x for k, piece in enumerate(line.split("{}")) for x in ([NAME] if k else []) + ([f"'{piece}'"] if piece else [])) or "''" for line in lines]
    return " || ".join(f"{p} || chr(10)" for p in parts)


FRONT = ("---", 'organization: "{}"', "---")
MAP = (K.TOP_SECTIONS[0], "", "Read {}.", "````markdown", K.TOP_SECTIONS[1], "````")
SUMMARY = (K.TOP_SECTIONS[1], "", "- Organization: {}")
ISSUES = (K.TOP_SECTIONS[2], "")
HEAD = ("| ID | Title |", "| --- | --- |")
ROWS = ("| o/r#1 | {} |", "| o/r#2 | second of {} |", "| o/r#3 | third |")
PULLS = (K.TOP_SECTIONS[3], "", *HEAD, "| No matching pull requests. | |", "")
WARNINGS = (K.TOP_SECTIONS[6], "", "- **search:issue**: {}")
LIMITS = (K.TOP_SECTIONS[7], "", "- None of {}.")


def block(kind: str, number: int, sections: tuple[str, ...]) -> list[tuple[str, tuple[str, ...]]]:
    """(section or empty, lines) of an item's block. Bodies quote headings and markers, which do not count there."""
    out: list[tuple[str, tuple[str, ...]]] = [("", (f"<!-- ITEM_START {kind} o/r#{number} -->", "", f"### Item {number} of {{}}", ""))]
    for s in sections:
        quoted = ("````markdown", sections[-1], f"<!-- ITEM_END {kind} o/r#{number} -->", "said by {}", "````") if s == "#### Body" else ("{} in " + s.strip("# "),)
        out.append((s, (s, "", *quoted, "")))
    return [*out, ("end", (f"<!-- ITEM_END {kind} o/r#{number} -->", ""))]


ISSUE, PULL = block("issue", 1, K.ISSUE_SECTIONS), block("pull_request", 9, K.PULL_SECTIONS)
WHOLE = text_of(
    *FRONT, "", "# Evidence of {}", "", *MAP, "", *SUMMARY, "", *ISSUES, *HEAD, *ROWS, "", *PULLS, K.TOP_SECTIONS[4], "", *[x for _, lines in ISSUE for x in lines], "", K.TOP_SECTIONS[5], "", *[x for _, lines in PULL for x in lines], *WARNINGS, "", *LIMITS
)
OVERVIEW = " || chr(10) || ".join(text_of(*part) for part in (FRONT, MAP, SUMMARY, WARNINGS, LIMITS))


def evidence_docs(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.expr(WHOLE).alias("text"))


def lines_of(parts: list[tuple[str, tuple[str, ...]]], *wanted: str) -> str:
    return text_of(*[x for name, lines in parts for x in (lines[:1] if name == "end" else lines) if name in wanted])


def item_sql(text: str) -> str:
    return f"SELECT s_suppkey AS doc_id, x AS text, 1 AS chunk, 1 AS chunks, strlen(x)::INT AS view_bytes FROM (SELECT s_suppkey, {text} AS x FROM supplier)"


def page_sql(text: str, first: int, last: int, after: str) -> str:
    return f'SELECT s_suppkey AS doc_id, {text} AS text, {first} AS "first", {last}::BIGINT AS "last", 3::BIGINT AS total, {after}::BIGINT AS next_offset FROM supplier'


@query(f"SELECT s_suppkey AS doc_id, x AS text, strlen(x)::INT AS bytes FROM (SELECT s_suppkey, {OVERVIEW} AS x FROM supplier)")
def reader_overview(spark, d):
    return reader.overview(evidence_docs(spark, d))


@query(page_sql(text_of(*HEAD, *ROWS), 1, 3, "NULL"))
def reader_index(spark, d):
    return reader.index(evidence_docs(spark, d), "issue")


@query(page_sql(text_of(*HEAD, ROWS[1]), 2, 2, "2"))
def reader_index_page(spark, d):
    return reader.index(evidence_docs(spark, d), "issue", offset=1, limit=1)


@query(f'SELECT s_suppkey AS doc_id, {text_of(*HEAD)} AS text, 0 AS "first", 0::BIGINT AS "last", 0::BIGINT AS total, NULL::BIGINT AS next_offset FROM supplier')
def reader_index_empty(spark, d):
    return reader.index(evidence_docs(spark, d), "pull_request")


@query(item_sql(lines_of(ISSUE, "", *K.ISSUE_TRIAGE, "end")))
def reader_issue_triage(spark, d):
    return reader.item(evidence_docs(spark, d), "issue", "o/r#1", "triage")


@query(item_sql(lines_of(ISSUE, "#### Body")))
def reader_issue_body(spark, d):
    return reader.item(evidence_docs(spark, d), "issue", "o/r#1", "body")


@query(item_sql(lines_of(PULL, "", *K.PULL_TRIAGE, "end")))
def reader_pull_triage(spark, d):
    return reader.item(evidence_docs(spark, d), "pull_request", "o/r#9", "triage")


@query(item_sql(lines_of(PULL, "#### Review Comments During Scan Period")))
def reader_pull_review_comments(spark, d):
    return reader.item(evidence_docs(spark, d), "pull_request", "o/r#9", "review_comments")


@query(f"SELECT s_suppkey AS doc_id, substring(x, 257, 256) AS text, 2 AS chunk, ((strlen(x) + 255) // 256)::INT AS chunks, strlen(x)::INT AS view_bytes FROM (SELECT s_suppkey, {lines_of(PULL, '', *K.PULL_SECTIONS, 'end')} AS x FROM supplier)")
def reader_pull_chunk(spark, d):
    return reader.item(evidence_docs(spark, d), "pull_request", "o/r#9", "full", chunk=2, max_bytes=256)


# Reports: a valid one and, for each rule, one with a fault.
STYLE = report_rules.Style("Some-Org", "# Weekly")
LINK = "[Some-Org/tool#7](https://github.com/Some-Org/tool/issues/7)"
FORM = "[Some-Org/REPO#NUMBER](GitHub URL) form"


def valid() -> list[str]:
    out = [STYLE.title, "", "Intro for C#11 readers of {}.", "", "~~~", "## quoted, tool#8", "~~~", ""]
    for section in STYLE.sections:
        body = [STYLE.empty_message]
        if section == "Worth Engineering Investment":
            body = [f"1. See {LINK}", "", "   - 建议投入类型：`quick review`", "", "2. More of {}"]
        elif section == STYLE.allocation:
            body = ["1. One", "", STYLE.week_heading, "", "A conclusion on {}.", "", "A reason."]
        out += [f"## {section}", "", *body, ""]
    return out


def fault(old: str, *new: str) -> list[str]:
    return [y for x in valid() for y in (new if x == old else [x])]


def reports() -> list[tuple[list[str], list[tuple[int, str, str | None, str]]]]:
    """(lines, findings as rank, rule, the line found (None: no line), message) for each case."""
    see, more, field = f"1. See {LINK}", "2. More of {}", "   - 建议投入类型：`quick review`"
    wrong_order = "required report sections must appear exactly once in this order: " + ", ".join(STYLE.sections)
    priority = f"{STYLE.week_heading!r}"
    numbers = "section 'Worth Engineering Investment': ordered items must be sequential; expected [1, 2], found [1, 3]"
    return [
        (valid(), []),
        ([*valid(), "~~~~ {}", "~~~"], [(0, "V01", "~~~~ {}", "unterminated fenced code block")]),
        (fault("# Weekly", "# Monthly"), [(1, "V02", None, "required report title is '# Weekly'")]),
        (fault("## Must Pay Attention", "## Must Pay"), [(1, "V03", None, wrong_order), (3, "V13", None, "section 'Must Pay Attention': expected an ordered list starting with '1. '")]),
        (fault(see, see.replace("[Some-Org/tool#7]", "[the tool]")), [(2, "V04", see.replace("[Some-Org/tool#7]", "[the tool]"), f"issue or pull request links must use the canonical {FORM}")]),
        (fault(see, see.replace("issues/7", "issues/8")), [(2, "V05", see.replace("issues/7", "issues/8"), "'Some-Org/tool#7' does not match its GitHub URL 'https://github.com/Some-Org/tool/issues/8'")]),
        (fault(more, "2. https://github.com/Some-Org/tool/pull/7"), [(2, "V06", "2. https://github.com/Some-Org/tool/pull/7", f"GitHub item URLs require the canonical {FORM}")]),
        (fault(more, "2. More on tool#9 of {}"), [(2, "V07", "2. More on tool#9 of {}", "unlinked issue or pull request reference 'tool#9'")]),
        (fault(more, more, "", "### 3. {}"), [(3, "V08", "### 3. {}", "numbered headings are not report entries; use '1. '")]),
        (fault(more, more, "", "* {}"), [(3, "V09", "* {}", "top-level entries must use an ordered list; indent field bullets under the numbered item")]),
        (fault(field, field[1:]), [(3, "V10", field[1:], "field bullets must use exactly three leading spaces and '-'")]),
        (fault(more, more, "   - {}"), [(3, "V11", "   - {}", "add a blank line before the nested fields")]),
        (fault("1. One", "### Entries", "1. One"), [(3, "V12", "1. One", "add a blank line before the ordered list in 'Recommended Resource Allocation'")]),
        (fault("1. One", "One"), [(3, "V13", None, "section 'Recommended Resource Allocation': expected an ordered list starting with '1. '")]),
        (fault(more, "3. More of {}"), [(3, "V14", None, numbers)]),
        (fault(STYLE.week_heading, "### {}"), [(4, "V15", None, f"required {priority} heading must appear exactly once")]),
        (fault("Intro for C#11 readers of {}.", STYLE.week_heading, "", "One.", "", "Two."), [(4, "V15", None, f"required {priority} heading must appear exactly once")]),
        (
            [*fault(STYLE.week_heading, "### {}"), STYLE.week_heading, "", "One.", "", "Two."],
            [(4, "V16", STYLE.week_heading, f"{priority} must be in 'Recommended Resource Allocation'")],
        ),
        (
            fault("A reason.", "10. Point of {}"),
            [
                (4, "V17", "10. Point of {}", "one engineer-week priority must contain prose, not list items"),
                (4, "V18", STYLE.week_heading, "one engineer-week priority requires exactly a conclusion paragraph and a reason paragraph"),
                (3, "V14", None, "section 'Recommended Resource Allocation': ordered items must be sequential; expected [1, 2], found [1, 10]"),
            ],
        ),
        (fault("A reason.", "A reason.", "", "More of {}."), [(4, "V18", STYLE.week_heading, "one engineer-week priority requires exactly a conclusion paragraph and a reason paragraph")]),
        (fault(field, "   - 建议投入：`quick review`"), [(5, "V19", "   - 建议投入：`quick review`", "use the exact investment field name '建议投入类型' or '投入规模'")]),
        (fault(field, "   - 投入规模：`{}`"), [(5, "V20", "   - 投入规模：`{}`", "invalid investment scale '{}'")]),
        (fault(field, "   - 投入规模：much"), [(5, "V20", "   - 投入规模：much", "invalid investment scale '(missing exact backtick value)'")]),
    ]


CASES = reports()


def _named(text: str) -> str:
    quoted = text.replace("'", "''")
    return " || ".join(x for k, piece in enumerate(quoted.split("{}")) for x in (["p_name"] if k else []) + ([f"'{piece}'"] if piece else []))


def _report(lines: list[str]) -> str:
    return " || chr(10) || ".join(_named(x) or "''" for x in lines)


def _expected() -> str:
    """Rows of the findings of each case; a line found is numbered by its last place."""
    rows = []
    for case, (lines, found) in enumerate(CASES):
        for rank, rule, line, message in found:
            number = "NULL" if line is None else max(i for i, x in enumerate(lines) if x == line) + 1
            rows.append(f"SELECT p_partkey AS doc_id, {rank} AS rank, '{rule}' AS rule, {number}::INT AS line_no, {_named(message)} AS message FROM p WHERE fault = {case}")
    return f"WITH p AS (SELECT p_partkey, p_name, p_size % {len(CASES)} AS fault FROM part) " + " UNION ALL ".join(rows)


@query(_expected())
def report_findings(spark, d):
    text = "case p_size % {} {} end".format(len(CASES), " ".join(f"when {k} then {_report(lines)}" for k, (lines, _) in enumerate(CASES)))
    docs = table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.expr(text).alias("text"))
    return report_rules.findings(docs, STYLE)


# One document of all texts, written in parts. Every fourth text opens a fence that the next but one closes, if it is there.
FENCED = "CASE WHEN doc_id % 2 = 0 AND doc_id - doc_id % 4 + 2 <= {} THEN '```' || chr(10) ELSE '' END || text"


@query(
    f"""WITH d AS (SELECT doc_id, {FENCED.format("(SELECT max(doc_id) FROM documents)")} AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(generate_series(1, len(string_split(t, chr(10))))) AS pos FROM d),
n AS (SELECT line, row_number() OVER (ORDER BY doc_id, pos) - 1 AS line_no, sum((line = '```')::INT) OVER (ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS fences FROM l)
SELECT line_no, md5(line) AS line_md5, line <> '```' AND fences % 2 = 0 AS visible FROM n UNION ALL SELECT count(*), md5(''), true FROM n"""
)
def split_document(spark, d):
    docs = table(spark, d, "documents")
    last = docs.agg(F.max("doc_id")).first()[0]
    folder = scratch(spark, "document")
    text = docs.select("doc_id", F.expr(FENCED.format(-1 if last is None else last)).alias("t"))
    text.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("t").write.text(folder)
    return split_lines(spark, folder, parts=True).select("line_no", F.md5("line").alias("line_md5"), "visible")
