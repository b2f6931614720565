"""The evidence document as ordered fragments.

A document is never one value: each fragment is a row with its place and the text that separates it from the one before, so an item with very many activities is many rows and
the sort is a range sort. sources/evidence.py writes the rows to a file.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan import formats as K
from loomspan.functions.text import cell, fenced, iso, list_text, slug, yes_no
from loomspan.operators import ranking
from loomspan.operators.ingest import KEYS, Evidence
from loomspan.period import TIMEZONE, Period

#: A fragment's place: section of the document, item, part of the item, then the order within the part.
PLACE = ["section", "k1", "k2", "number", "part", "at", "tie", "pos"]
TIES = ["source_rank", "ordinal"]


def _code(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"- {label}: `"), value.cast("string"), F.lit("`"))


def _plain(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"- {label}: "), value)


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(default))


def _flag(name: str) -> Column:
    return yes_no(F.col(name))


def _lines(*lines: Column) -> Column:
    return F.concat_ws("\n", *lines)


def anchor(prefix: str) -> Column:
    return F.concat(F.lit(f"{prefix}-"), slug(F.col("item_id")))


def activity_text() -> Column:
    """One activity: its facts, then its body."""
    line = F.coalesce("line", "original_line").cast("string")
    place = F.concat("path", F.coalesce(F.concat(F.lit(":"), line), F.lit("")), F.coalesce(F.concat(F.lit(" ("), F.nullif("side", F.lit("")), F.lit(")")), F.lit("")))
    given = lambda name: F.length(name) > 0
    edited = F.col("updated_at").isNotNull() & ~F.col("updated_at").eqNullSafe(F.col("occurred_at"))
    fact = lambda name, value: F.concat(F.lit(f"{name}: `"), value, F.lit("`"))
    facts = F.concat_ws(
        "; ",
        fact("author", F.col("author")),
        fact("association", _or("author_association", "NONE")),
        fact("bot", _flag("bot")),
        fact("occurred_at", iso(F.col("occurred_at"))),
        fact("in_period", _flag("in_period")),
        F.when(edited, fact("updated_at", iso(F.col("updated_at")))),
        F.when(edited, fact("updated_in_period", _flag("updated_in_period"))),
        F.when(given("state"), fact("state", F.col("state"))),
        F.when(given("path"), fact("location", place)),
        F.when(given("url"), F.concat(F.lit("[source]("), "url", F.lit(")"))),
    )
    return F.concat(F.lit("- "), facts, F.lit("\n\n"), fenced(F.col("body"), K.ACTIVITY_BODY_LIMIT))


def _gaps() -> Column:
    gaps = F.concat(F.when(F.col("exact_activity_unknown"), F.array(F.lit(K.UNKNOWN_ACTIVITY))).otherwise(F.array().cast("array<string>")), F.col("data_gaps"))
    return F.when(F.size(gaps) == 0, "None.").otherwise(F.array_join(F.transform(gaps, lambda g: F.concat(F.lit("- "), g)), "\n"))


def _groups(title: str, kind: str, noun: str) -> list:
    return [title, f"**Human {noun}**", ("human_" + kind,), f"**Bot {noun} (lower-salience evidence)**", ("bot_" + kind,)]


def issue_layout() -> list:
    """Paragraphs of an issue's block: text, a column, or the name of a group of activities in a tuple."""
    S = K.ISSUE_SECTIONS
    return [
        F.concat(F.lit("<!-- ITEM_START issue "), "item_id", F.lit(" -->")),
        F.concat(F.lit('<a id="'), anchor("issue"), F.lit('"></a>')),
        F.concat(F.lit("### Issue: "), "item_id"),
        S[0],
        _lines(
            _plain("Title", F.col("title")),
            _plain("URL", F.col("url")),
            _code("State", F.col("state")),
            _code("State reason", _or("state_reason", "Not provided")),
            _code("Author", F.col("author")),
            _code("Author association", _or("author_association", "NONE")),
            _code("Created at", iso(F.col("created_at"))),
            _code("Updated at", iso(F.col("updated_at"))),
            _code("Closed at", iso(F.col("closed_at"))),
        ),
        S[1],
        _lines(
            _code("Created in period", _flag("created_in_period")),
            _code("Closed in period", _flag("closed_in_period")),
            _code("New comments", F.col("n_new_comment")),
            _code("Updated existing comments", F.col("n_updated_comment")),
            _code("Human comment activity", F.col("n_human")),
            _code("Bot comment activity", F.col("n_bot")),
            _code("Maintainer/member/collaborator comment activity", F.col("n_maintainer")),
        ),
        S[2],
        _lines(_plain("Labels", list_text(F.col("labels"))), _plain("Assignees", list_text(F.col("assignees"))), _plain("Milestone", _or("milestone", "None"))),
        S[3],
        fenced(F.col("body"), K.BODY_LIMIT),
        S[4],
        ("previous",),
        *_groups(S[5], "comment", "comments"),
        S[6],
        ("latest_human",),
        S[7],
        ("latest_maintainer",),
        S[8],
        _gaps(),
        F.concat(F.lit("<!-- ITEM_END issue "), "item_id", F.lit(" -->")),
    ]


def pull_layout() -> list:
    S = K.PULL_SECTIONS
    mergeable = F.when(F.col("mergeable"), "True").when(~F.col("mergeable"), "False").otherwise("unknown")
    return [
        F.concat(F.lit("<!-- ITEM_START pull_request "), "item_id", F.lit(" -->")),
        F.concat(F.lit('<a id="'), anchor("pull-request"), F.lit('"></a>')),
        F.concat(F.lit("### Pull Request: "), "item_id"),
        S[0],
        _lines(
            _plain("Title", F.col("title")),
            _plain("URL", F.col("url")),
            _code("State", F.col("state")),
            _code("Draft", _flag("draft")),
            _code("Merged", _flag("merged")),
            _code("Merged at", iso(F.col("merged_at"))),
            _code("Closed at", iso(F.col("closed_at"))),
            _code("Author", F.col("author")),
            _code("Author association", _or("author_association", "NONE")),
            _code("Created at", iso(F.col("created_at"))),
            _code("Updated at", iso(F.col("updated_at"))),
            _code("Base branch", _or("base_branch", "Not provided")),
            _code("Head branch", _or("head_branch", "Not provided")),
        ),
        S[1],
        _lines(
            _code("Created in period", _flag("created_in_period")),
            _code("Merged in period", _flag("merged_in_period")),
            _code("Closed without merge in period", _flag("closed_unmerged_in_period")),
            _code("New conversation comments", F.col("n_new_comment")),
            _code("Updated existing conversation comments", F.col("n_updated_comment")),
            _code("New reviews", F.col("n_new_review")),
            _code("New review comments", F.col("n_new_review_comment")),
            _code("Updated existing review comments", F.col("n_updated_review_comment")),
            _code("Human activity", F.col("n_human")),
            _code("Bot activity", F.col("n_bot")),
            _code("Maintainer/member/collaborator activity", F.col("n_maintainer")),
        ),
        S[2],
        _lines(
            _code("Mergeable (current GitHub value)", mergeable),
            F.lit("- Latest available decisive review state per reviewer follows. If none exists, the latest review record is shown. This is evidence, not a merge-readiness conclusion."),
        ),
        ("current_review",),
        S[3],
        _lines(
            _plain("Labels", list_text(F.col("labels"))),
            _plain("Assignees", list_text(F.col("assignees"))),
            _plain("Requested reviewers", list_text(F.col("requested_reviewers"))),
            _plain("Milestone", _or("milestone", "None")),
        ),
        S[4],
        _lines(*(_code(label, _or(name, "Not provided")) for label, name in (("Additions", "additions"), ("Deletions", "deletions"), ("Changed files", "changed_files")))),
        S[5],
        fenced(F.col("body"), K.BODY_LIMIT),
        S[6],
        ("previous",),
        *_groups(S[7], "comment", "comments"),
        *_groups(S[8], "review", "reviews"),
        *_groups(S[9], "review_comment", "review comments"),
        S[10],
        ("latest_human",),
        S[11],
        ("latest_maintainer",),
        S[12],
        _gaps(),
        F.concat(F.lit("<!-- ITEM_END pull_request "), "item_id", F.lit(" -->")),
    ]


#: Groups that show an activity for its place among others, and how many of them.
MOST_SHOWN = {"latest_human": 1, "latest_maintainer": 1, "previous": 3, "current_review": 1}


def shown_activities(activities: DataFrame) -> DataFrame:
    """Activities with the groups that show them, one row for each showing, with their order in it.

    Rows of a group come by time, null first; equal times keep the order of arrival, but those of previous context turn it round. One scan and one ranking: each activity asks for its groups at once,
    newest first in each; Spark keeps three of a group in each task before the shuffle, so an item of very many activities is no hot key. Active ones are shown all, each in a group of its own.
    """
    human, active = ~F.col("bot"), F.col("active")
    by_arrival = F.col("source_rank") * F.lit(1 << 40) + F.col("ordinal")
    none = F.lit(None).cast("long")
    ask = lambda rule, group, own=none, who="", first=False: F.when(rule, F.struct(group.alias("group"), own.alias("own"), F.col(who).alias("who") if who else F.lit(None).cast("string").alias("who"), F.lit(first).alias("first") if first is False else first.alias("first")))
    decisive = F.coalesce(F.upper("state").isin(list(K.DECISIVE)), F.lit(False))
    asked = F.array(
        ask(active, F.concat(F.when(F.col("bot"), "bot_").otherwise("human_"), "kind"), by_arrival),
        ask(human, F.lit("latest_human")),
        ask(human & F.col("maintainer"), F.lit("latest_maintainer")),
        ask(human & ~active, F.lit("previous")),
        ask(F.col("kind") == "review", F.lit("current_review"), none, "author", decisive),
    )
    rows = activities.select("*", F.explode(F.array_compact(asked)).alias("ask")).select(*activities.columns, "ask.*")
    order = [F.desc("first"), F.desc_nulls_last("occurred_at"), *map(F.asc, TIES)]
    most = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in MOST_SHOWN.items() for x in pair)), F.col("group")), F.lit(1))
    best = ranking.ranked(rows, [*KEYS, "group", "own", "who"], order).where(F.col("rank") <= max(MOST_SHOWN.values())).where(F.col("rank") <= most)
    pos = F.when(F.col("group") == "previous", -F.col("rank")).otherwise(by_arrival)
    return best.select(*KEYS, "group", F.col("occurred_at").alias("at"), F.coalesce(F.lower("who"), F.lit("")).alias("tie"), pos.cast("long").alias("pos"), activity_text().alias("text"))


def _fragment(df: DataFrame, section: int | Column, text: Column, glue: str = "\n\n", **place: Column) -> DataFrame:
    """Rows of the document; a place that isn't given is the same for all."""
    types = {"k1": "string", "k2": "string", "number": "long", "part": "int", "at": "timestamp", "tie": "string", "pos": "long"}
    places = [place.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in types.items()]
    return df.select((F.lit(section) if isinstance(section, int) else section).alias("section"), *places, F.lit(glue).alias("glue"), text.alias("text"))


def _item_place() -> dict[str, Column]:
    return {"k1": F.lower("repository"), "k2": F.col("repository"), "number": F.col("number")}


def own_fragments(items: DataFrame, layout: list, section: int) -> DataFrame:
    """Blocks of one kind of item without their activities; an empty group of these is a paragraph that says so."""
    own = []
    for part, entry in enumerate(layout):
        text = F.when(F.col(f"n_{entry[0]}") == 0, "None.") if isinstance(entry, tuple) else F.lit(entry) if isinstance(entry, str) else entry
        own.append(F.struct(F.lit(part).alias("part"), text.alias("text")))
    rows = items.select("repository", "number", F.inline(F.filter(F.array(*own), lambda x: x["text"].isNotNull())))
    return _fragment(rows, section, F.col("text"), part=F.col("part"), **_item_place())


def shown_fragments(items: DataFrame, shown: DataFrame, layouts: dict[str, tuple[int, list]]) -> DataFrame:
    """Activities of all kinds of items at the places of their groups, from one scan. layouts: the section and layout of each kind."""
    places = [x for kind, (section, layout) in layouts.items() for part, entry in enumerate(layout) if isinstance(entry, tuple) for x in (F.lit(f"{kind} {entry[0]}"), F.struct(F.lit(section).alias("section"), F.lit(part).alias("part")))]
    place = F.try_element_at(F.create_map(*places), F.concat_ws(" ", "item_kind", "group"))
    acts = shown.join(items.select(*KEYS), KEYS, "left_semi").withColumn("place", place).where("place is not null")
    return _fragment(acts, F.col("place.section"), F.col("text"), part=F.col("place.part"), at=F.col("at"), tie=F.col("tie"), pos=F.col("pos"), **_item_place())


def index_row(kind: str) -> Column:
    flags = ["created_in_period", "closed_in_period"] if kind == "issue" else ["created_in_period", "closed_unmerged_in_period", "merged_in_period"]
    state = F.col("state") if kind == "issue" else F.when(F.col("merged"), "merged").otherwise(F.col("state"))
    link = F.concat(F.lit("[evidence](#"), anchor(kind.replace("_", "-")), F.lit(")"))
    cells = [cell(F.col("item_id")), cell(F.col("repository")), F.col("number").cast("string"), cell(F.col("title")), cell(state), *map(_flag, flags)]
    cells += [F.col("n_human").cast("string"), cell(_or("author_association", "NONE")), cell(list_text(F.col("labels"))), link]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _head(org: str, period: Period, generated_at: datetime) -> Column:
    start, end = period.local_start.isoformat(), period.local_end.isoformat()
    utc_start, utc_end = period.utc_start.isoformat(), period.utc_end.isoformat()
    front = f'---\nschema_version: "1.0"\norganization: "{org}"\ngenerated_at: "{generated_at.astimezone(UTC).isoformat()}"\ntimezone: "{TIMEZONE}"\nlocal_start: "{start}"\nlocal_end: "{end}"\nutc_start: "{utc_start}"\nutc_end: "{utc_end}"\n'
    count = lambda label, name: F.concat(F.lit(f"{label}: "), F.col(name).cast("string"))
    return F.concat(
        F.lit(front),
        _lines(count("issue_count", "issues"), count("pull_request_count", "pull_requests"), count("collection_warning_count", "warnings")),
        F.lit(f"\n---\n\n# {org} GitHub Activity Evidence\n\n{K.TOP_SECTIONS[0]}\n\n{K.DOCUMENT_MAP}\n\n{K.TOP_SECTIONS[1]}\n\n"),
        _lines(
            F.lit(f"- Organization: `{org}`\n- Local scan period: `{start}` through `{end}`\n- UTC scan period: `{utc_start}` through `{utc_end}`"),
            F.lit(f"- UTC+8 Search API date window: `{period.start_date}` through `{period.end_date}`"),
            _code("Issues retained after exact local filtering", F.col("issues")),
            _code("Pull requests retained after exact local filtering", F.col("pull_requests")),
            _code("Items excluded because `updated_at` was the only period match", F.col("unexplained_updated_excluded_count")),
            _code("Items excluded after activity endpoint failures", F.col("activity_failure_excluded_count")),
            _code("Failed API requests", F.coalesce("failed_requests", F.lit(0))),
            _code("GitHub API rate limit remaining", F.coalesce(F.col("rate_limit_remaining").cast("string"), F.lit("unknown"))),
        ),
    )


def fragments(evidence: Evidence, org: str, period: Period, generated_at: datetime) -> DataFrame:
    """The whole document; sort by PLACE (nulls first) and join each row's glue and text."""
    kept = evidence.items.where("included")
    shown = shown_activities(evidence.activities)
    one = evidence.summary
    parts = [_fragment(one, 0, _head(org, period, generated_at), glue="")]
    kinds = (("issue", "issues", K.ISSUE_COLUMNS, issue_layout(), "No matching issues."), ("pull_request", "pull_requests", K.PULL_COLUMNS, pull_layout(), "No matching pull requests."))
    layouts = {}
    for i, (kind, total, columns, layout, nothing) in enumerate(kinds):
        items = kept.where(F.col("item_kind") == kind)
        none = F.col(total) == 0
        parts.append(_fragment(one, 1 + 2 * i, F.concat(F.lit(f"{K.TOP_SECTIONS[2 + i]}\n\n{columns}"), F.when(none, "\n").otherwise(""))))
        parts.append(_fragment(items, 2 + 2 * i, index_row(kind), glue="\n", **_item_place()))
        parts.append(_fragment(one, 5 + 2 * i, F.concat(F.lit(K.TOP_SECTIONS[4 + i]), F.when(none, f"\n\n{nothing}").otherwise(""))))
        parts.append(own_fragments(items, layout, 6 + 2 * i))
        layouts[kind] = (6 + 2 * i, layout)
    parts.append(shown_fragments(kept, shown, layouts))
    noted = F.concat(F.lit("- **"), "scope", F.lit("**: "), "message", F.coalesce(F.concat(F.lit(" ([request]("), F.nullif("url", F.lit("")), F.lit("))")), F.lit("")))
    parts.append(_fragment(one, 9, F.concat(F.lit(K.TOP_SECTIONS[6] + "\n"), F.when(F.col("warnings") == 0, "\nNone.").otherwise(""))))
    parts.append(_fragment(evidence.warnings, 10, noted, glue="\n", k1=F.col("scope"), k2=F.col("message"), tie=F.coalesce("url", F.lit(""))))
    parts.append(_fragment(one, 11, F.lit(f"{K.TOP_SECTIONS[7]}\n\n{K.LIMITATIONS}\n")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*(F.asc_nulls_first(name) for name in PLACE)).select("glue", "text")
