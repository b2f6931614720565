"""Rules of written reports as findings: docs has doc_id and text; a report without findings is valid.

Lines carry what precedes them (section, last visible text, the priority's paragraphs), by windows that are partitioned by report and share one sort. A line's findings are an array on its
row; one aggregation by report gathers these and what the rules of whole reports need, so all is one pass. Titles, vocabulary and the organisation belong to a Style.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.operators.lines import visible

#: Every line end that counts, after carriage returns are gone.
LINE_END = "[\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


@dataclass(frozen=True)
class Style:
    org: str
    title: str
    # Sections in order, field names and vocabulary; below, the forms of addresses, links and mentions; and the messages of findings.
    sections: tuple[str, ...] = (
        "Executive Summary",
        "Must Pay Attention",
        "Worth Engineering Investment",
        "Pull Requests Requiring Action",
        "Important Resolutions",
        "Emerging Engineering Themes",
        "Recommended Resource Allocation",
        "Active but Not Worth Investing This Week",
    )
    allocation: str = "Recommended Resource Allocation"
    week_heading: str = "### One engineer-week priority"
    empty_message: str = "本周未发现"
    fields: tuple[str, ...] = ("建议投入类型", "投入规模")
    alias: str = "建议投入"
    scales: tuple[str, ...] = ("quick review", "several engineer-hours", "one engineer-day", "multi-day investigation", "requires technical owner")

    @property
    def item(self) -> str:
        """Pattern of an item's address: repository, number."""
        return rf"https://github\.com/{self.org}/([A-Za-z0-9_.-]+)/(?:issues|pull)/(\d+)"

    @property
    def link(self) -> str:
        return rf"(?<!!)\[[^\]]+\]\({self.item}\)"

    @property
    def reference(self) -> str:
        """A mention of an item by name or number; C#1 and F#1 are languages."""
        return rf"(?<![A-Za-z0-9_./]){self.org}/[A-Za-z0-9_.-]+#\d+|(?<![A-Za-z0-9_./])(?![CF]#\d+\b)[A-Za-z0-9_.-]+#\d+|(?<![A-Za-z0-9_/#])#\d+"


def report_lines(docs: DataFrame, style: Style) -> DataFrame:
    """doc_id, line_no from 1, line, shown, section, head (a section's heading), before (last visible line with text), gap (the line just above is blank)."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), LINE_END, "\n")
    base = docs.select("doc_id", text.alias("text"))
    rows = base.select("doc_id", F.posexplode(F.arrays_zip(F.split("text", "\n").alias("line"), visible(F.col("text"), tilde=True).alias("shown"))).alias("line_no", "x"))
    rows = rows.select("doc_id", (F.col("line_no") + 1).alias("line_no"), "x.line", "x.shown")
    order = W.partitionBy("doc_id").orderBy("line_no")
    head = F.col("shown") & F.col("line").startswith("## ")
    filled = ~F.col("line").rlike(r"(?U)^\s*$")
    above = order.rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumns(
        {
            "head": head,
            "section": F.last(F.when(head, F.expr("substring(line, 4)")), True).over(order),
            "before": F.last(F.when(F.col("shown") & filled, F.col("line")), True).over(above),
            "gap": ~F.coalesce(F.lag(filled).over(order), F.lit(True)),
        }
    )


def _quoted(value: Column) -> Column:
    return F.concat(F.lit("'"), value, F.lit("'"))


#: A finding: rank (the group of rules), rule, line_no (null: the whole report), message.
FINDING = "struct<rank:int,rule:string,line_no:int,message:string>"


def _finding(rank: int, rule: str, message: Column | str, line_no: Column | None) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    number = F.lit(None) if line_no is None else line_no
    return F.struct(F.lit(rank).alias("rank"), F.lit(rule).alias("rule"), number.cast("int").alias("line_no"), message.alias("message")).cast(FINDING)


def _where(*rules: tuple[Column, Column]) -> Column:
    """The findings whose condition holds."""
    return F.array_compact(F.array(*(F.when(F.coalesce(condition, F.lit(False)), finding) for condition, finding in rules)))


ORDERED = r"(?U)^\d+\.\s+"


def findings(docs: DataFrame, style: Style) -> DataFrame:
    """doc_id, rank (the group of rules), rule, line_no (null: the whole report), message."""
    doc = W.partitionBy("doc_id")
    order = doc.orderBy("line_no")
    heading = F.col("shown") & (F.col("line") == style.week_heading)
    # Without exactly one heading of the priority nothing is in it; a section's heading ends it, a blank line, and that alone, a paragraph.
    after = F.col("shown") & (F.col("weeks") == 1) & (F.col("line_no") > F.col("start"))
    lines = report_lines(docs, style).withColumns({"weeks": F.count_if(heading).over(doc), "start": F.min(F.when(heading, F.col("line_no"))).over(doc)})
    lines = lines.withColumn("in_week", after & (F.count_if(after & F.col("head")).over(order) == 0))
    lines = lines.withColumn("island", F.count_if(F.col("in_week") & (F.col("line") == "")).over(order))
    line, well = F.col("line"), F.col("shown") & ~F.col("head") & F.coalesce(F.col("section").isin(*style.sections), F.lit(False))
    ordered = well & line.rlike(ORDERED)
    item = line.rlike(r"(?U)^\s*(?:\d+\.\s+|[-*+]\s+)")
    first = F.min(F.when(F.col("shown") & (line != ""), F.struct("line_no", "line")))["line"]
    heads = F.transform(F.array_sort(F.collect_list(F.when(F.col("head"), F.struct("line_no", "section")))), lambda h: h["section"])
    number = F.regexp_extract("line", r"(?U)^(\d+)\.", 1).cast("decimal(38,0)")
    gathered = lines.groupBy("doc_id").agg(
        F.flatten(F.collect_list(F.when(F.col("shown"), _line_rules(style, well, ordered, item)))).alias("of_lines"),
        F.array_sort(F.collect_list(F.when(~F.col("shown"), _mark()))).alias("marks"),
        first.alias("first"),
        heads.alias("heads"),
        F.array_sort(F.collect_list(F.when(ordered, F.struct("line_no", "section", number.alias("number"))))).alias("entries"),
        F.collect_set(F.when(well & line.contains(style.empty_message), F.col("section"))).alias("excused"),
        F.max("weeks").alias("weeks"),
        F.max("start").alias("start"),
        F.max(F.when(heading, F.col("section"))).alias("home"),
        F.size(F.collect_set(F.when(F.col("in_week") & (line != ""), F.col("island")))).alias("paragraphs"),
        F.bool_or(F.col("in_week") & (item | line.rlike(r"(?U)^#{1,6}\s+"))).alias("other"),
    )
    found = F.concat("of_lines", _report_rules(style))
    return gathered.select("doc_id", F.inline(found))


def _mark() -> Column:
    """What may open or close a fence: the run, and the run if nothing follows it."""
    run = F.regexp_extract("line", r"^ {0,3}(`{3,}|~{3,})", 1)
    alone = F.regexp_extract("line", r"^ {0,3}(`{3,}|~{3,})[ \t]*$", 1)
    return F.when(run != "", F.struct("line_no", run.alias("run"), alone.alias("alone")))


def _line_rules(style: Style, body: Column, ordered: Column, item: Column) -> Column:
    """Findings of a shown line.

    What isn't a link must hold neither an item's address nor a mention of an item; the kind in the address isn't compared. Entries are ordered lists from 1; fields are bullets under them,
    three blanks in. A field's value is one of the scales in backticks; the field has its full name.
    """
    line, at = F.col("line"), F.col("line_no")
    form = f"[{style.org}/REPO#NUMBER](GitHub URL) form"
    canonical = rf"^{style.org}/([A-Za-z0-9_.-]+)#(\d+)$"

    def of_link(link: Column) -> Column:
        label, url = F.regexp_extract(link, r"^\[([^\]]+)\]", 1), F.regexp_extract(link, r"\]\((.*)\)$", 1)
        same = (F.regexp_extract(label, canonical, 1) == F.regexp_extract(url, style.item, 1)) & (F.regexp_extract(label, canonical, 2) == F.regexp_extract(url, style.item, 2))
        unlike = _finding(2, "V05", F.concat(_quoted(label), F.lit(" does not match its GitHub URL "), _quoted(url)), at)
        return F.when(~label.rlike(canonical), _finding(2, "V04", f"issue or pull request links must use the canonical {form}", at)).when(~same, unlike)

    links = F.array_compact(F.transform(F.regexp_extract_all("line", F.lit(f"({style.link})"), F.lit(1)), of_link))
    rest = F.regexp_replace("line", style.link, "")
    mention = F.regexp_extract(rest, f"({style.reference})", 1)
    nested = body & line.rlike(r"(?U)^[ \t]+[-*+]\s+")
    tight = ~F.col("gap")
    single = _where(
        (rest.rlike(style.item), _finding(2, "V06", f"GitHub item URLs require the canonical {form}", at)),
        (mention != "", _finding(2, "V07", F.concat(F.lit("unlinked issue or pull request reference "), _quoted(mention)), at)),
        (body & line.rlike(r"(?U)^###\s+\d+\."), _finding(3, "V08", "numbered headings are not report entries; use '1. '", at)),
        (body & line.rlike(r"(?U)^[-*+]\s+"), _finding(3, "V09", "top-level entries must use an ordered list; indent field bullets under the numbered item", at)),
        (nested & ~line.rlike(r"(?U)^   -\s+"), _finding(3, "V10", "field bullets must use exactly three leading spaces and '-'", at)),
        (nested & F.col("before").rlike(ORDERED) & tight, _finding(3, "V11", "add a blank line before the nested fields", at)),
        (ordered & F.col("before").startswith("##") & tight, _finding(3, "V12", F.concat(F.lit("add a blank line before the ordered list in "), _quoted(F.col("section"))), at)),
        (F.col("in_week") & item, _finding(4, "V17", "one engineer-week priority must contain prose, not list items", at)),
    )
    names = "|".join([style.fields[0], style.alias, *style.fields[1:]])
    exact = " or ".join(map(repr, style.fields))

    def of_field(entry: Column) -> Column:
        value = F.regexp_extract(entry, "`([^`]+)`$", 1)
        value = F.when(value == "", "(missing exact backtick value)").otherwise(value)
        return _where(
            (F.regexp_extract(entry, f"^({names})", 1) == style.alias, _finding(5, "V19", f"use the exact investment field name {exact}", at)),
            (~value.isin(*style.scales), _finding(5, "V20", F.concat(F.lit("invalid investment scale "), _quoted(value)), at)),
        )

    entries = F.flatten(F.transform(F.regexp_extract_all("line", F.lit(rf"(?U)((?:{names})\s*[：:](?:\s*`[^`\r\n]+`)?)"), F.lit(1)), of_field))
    return F.concat(F.when(line.contains("](https://github.com/"), links).otherwise(F.array_compact(F.array(F.lit(None).cast(FINDING)))), single, entries)


def _report_rules(style: Style) -> Column:
    """Findings of a whole report: its fences, title, sections, lists, and the one heading of the priority with two paragraphs of prose, a conclusion and a reason."""
    closed = F.struct(F.lit(0).alias("line_no"), F.lit("").alias("run"))

    def step(state: Column, mark: Column) -> Column:
        closes = (F.length(mark["alone"]) >= F.length(state["run"])) & (F.substring(mark["alone"], 1, 1) == F.substring(state["run"], 1, 1))
        opened = F.struct(mark["line_no"].alias("line_no"), mark["run"].alias("run"))
        return F.when(state["run"] == "", opened).when(closes, closed).otherwise(state)

    last = F.aggregate("marks", closed, step)
    shown = lambda a: F.concat(F.lit("["), F.array_join(a.cast("array<string>"), ", "), F.lit("]"))

    def of_section(section: Column) -> Column:
        numbers = F.transform(F.filter("entries", lambda e: e["section"] == section), lambda e: e["number"])
        expected = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)))
        label = F.concat(F.lit("section "), _quoted(section))
        wrong = F.concat(label, F.lit(": ordered items must be sequential; expected "), shown(expected), F.lit(", found "), shown(numbers))
        missing = F.concat(label, F.lit(": expected an ordered list starting with '1. '"))
        return _where(
            ((F.size(numbers) == 0) & ~F.array_contains("excused", section), _finding(3, "V13", missing, None)),
            ((F.size(numbers) > 0) & (numbers.cast("array<string>") != expected.cast("array<string>")), _finding(3, "V14", wrong, None)),
        )

    one = F.col("weeks") == 1
    week = f"{style.week_heading!r}"
    own = _where(
        (last["run"] != "", _finding(0, "V01", "unterminated fenced code block", last["line_no"])),
        (~F.col("first").eqNullSafe(F.lit(style.title)), _finding(1, "V02", f"required report title is {style.title!r}", None)),
        (F.col("heads") != F.array(*map(F.lit, style.sections)), _finding(1, "V03", "required report sections must appear exactly once in this order: " + ", ".join(style.sections), None)),
        (~one, _finding(4, "V15", f"required {week} heading must appear exactly once", None)),
        (one & ~F.col("home").eqNullSafe(F.lit(style.allocation)), _finding(4, "V16", f"{week} must be in {style.allocation!r}", F.col("start"))),
        (one & ((F.col("paragraphs") != 2) | F.col("other")), _finding(4, "V18", "one engineer-week priority requires exactly a conclusion paragraph and a reason paragraph", F.col("start"))),
    )
    return F.concat(own, F.flatten(F.transform(F.array(*map(F.lit, style.sections)), of_section)))


def in_order(found: DataFrame) -> DataFrame:
    return found.orderBy("doc_id", "rank", F.asc_nulls_last("line_no"), "rule", "message")
