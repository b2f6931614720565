"""Raw records to typed items, their activities, warnings and a run summary.

The raw zone keeps each record as the JSON text that arrived, as the absence of a key and a null differ. Its tables:

    candidates(kind, ordinal, raw)                              kind: issue or pull_request; ordinal: place of arrival
    details(kind, repository, number, raw, error, url)          at most one row for each item; raw is null where the read failed
    children(item_kind, repository, number, kind, ordinal, raw) kind: comment, review or review_comment
    failures(item_kind, repository, number, kind, error, url)   child reads that failed, one row each
    searches(kind, total_count, incomplete, error, partial_error, url)
    requests(failed, remaining)                                 one row for each logical request

Timestamps are instants; the session's time zone must be UTC. A timestamp without a zone, or malformed, is an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.formats import CHILD_KINDS, DETAIL_FIELDS, FAILED_CHILD
from loomspan.functions.flags import is_active, is_bot, is_maintainer, login_of
from loomspan.functions.text import after_first
from loomspan.operators.ranking import keep_last
from loomspan.period import Period
from loomspan.storage import keeper

KEYS = ["item_kind", "repository", "number"]


@dataclass(frozen=True)
class Raw:
    candidates: DataFrame
    details: DataFrame
    children: DataFrame
    failures: DataFrame
    searches: DataFrame
    requests: DataFrame


@dataclass(frozen=True)
class Evidence:
    """items has every item that was read, with included and reason; activities those of all of them."""

    items: DataFrame
    activities: DataFrame
    warnings: DataFrame
    summary: DataFrame


def field(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def parsed(rows: DataFrame, text: str) -> DataFrame:
    """rows with the JSON text as _v. A generated column, as filters on its fields would else be pushed below with a copy of the parser each."""
    return rows.select("*", F.explode(F.array(F.try_parse_json(text))).alias("_v"))


def key_names(raw: Column) -> Column:
    return F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))


def absent(raw: Column, names: tuple[str, ...]) -> Column:
    """The names that aren't keys of a JSON object; a key with a null isn't absent."""
    return F.array_except(F.array(*map(F.lit, names)), key_names(raw))


def instant(text: Column) -> Column:
    """Null or empty: null."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    wrong = F.raise_error(F.concat(F.lit("a timestamp without a zone: "), text)).cast("timestamp")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(None).cast("timestamp")).when(zoned, text.cast("timestamp")).otherwise(wrong)


def label_names(v: Column) -> Column:
    """Texts as they are, even empty; the names of objects that have one; nothing else."""
    name = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.nullif(F.try_variant_get(x, "$.name", "string"), F.lit("")))
    found = F.transform(field(v, "labels", "array<variant>"), name)
    return F.coalesce(F.array_compact(found), F.array().cast("array<string>"))


def logins(v: Column, path: str) -> Column:
    found = F.transform(field(v, path, "array<variant>"), lambda x: login_of(F.try_variant_get(x, "$.login", "string")))
    return F.coalesce(found, F.array().cast("array<string>"))


def candidate_id(repository: Column, number: Column) -> Column:
    """How messages name a candidate, also one that lacks its place."""
    return F.concat(F.coalesce(F.nullif(repository, F.lit("")), F.lit("unknown-repository")), F.lit("#"), F.coalesce(number.cast("string"), F.lit("unknown")))


def typed_candidates(raw: DataFrame) -> DataFrame:
    """One row for each (kind, repository, number): the last copy that arrived, at the first one's position. Candidates without a repository or an integer number go."""
    v = F.col("_v")
    number = F.when(F.schema_of_variant(field(v, "number", "variant")) == "BIGINT", field(v, "number", "bigint"))
    rows = parsed(raw, "raw").select(
        F.col("kind").alias("item_kind"),
        "ordinal",
        "raw",
        after_first(field(v, "repository_url"), "/repos/").alias("repository"),
        number.alias("number"),
        instant(field(v, "updated_at")).alias("seen_at"),
        field(v, "html_url").alias("seen_url"),
    )
    return keep_last(rows.where("length(repository) > 0 and number is not null"), KEYS, "ordinal")


def looked_up(candidates: DataFrame, details: DataFrame, period: Period) -> DataFrame:
    """Candidates that don't predate the period, with their detail record in source; an issue whose candidate has all fields needs no detail."""
    covering = (F.col("item_kind") == "issue") & (F.size(absent(F.col("raw"), (*DETAIL_FIELDS, "comments"))) == 0)
    found = details.select(F.col("kind").alias("item_kind"), "repository", "number", F.col("raw").alias("detail"), "error", "url")
    rows = candidates.where(~period.predates(F.col("seen_at"))).join(found, KEYS, "left")
    return rows.withColumn("source", F.when(covering, F.col("raw")).otherwise(F.col("detail")))


def typed_items(rows: DataFrame, period: Period) -> DataFrame:
    v = F.col("_v")
    text = lambda path, default: F.coalesce(F.nullif(field(v, path), F.lit("")), F.lit(default))
    at = lambda path: instant(field(v, path)).alias(path)
    truth = lambda path: F.coalesce(field(v, path, "boolean"), F.lit(False))
    gaps = F.transform(absent(F.col("source"), DETAIL_FIELDS), lambda name: F.concat(F.lit("GitHub API response omitted field: "), name))
    out = parsed(rows.where("source is not null"), "source").select(
        *KEYS,
        F.concat_ws("#", "repository", F.col("number").cast("string")).alias("item_id"),
        text("title", "(missing title)").alias("title"),
        F.coalesce(F.nullif(field(v, "html_url"), F.lit("")), F.col("seen_url"), F.lit("")).alias("url"),
        text("state", "unknown").alias("state"),
        field(v, "state_reason").alias("state_reason"),
        truth("draft").alias("draft"),
        truth("merged").alias("merged"),
        login_of(field(v, "user.login")).alias("author"),
        field(v, "author_association").alias("author_association"),
        *map(at, ("created_at", "updated_at", "closed_at", "merged_at")),
        field(v, "base.ref").alias("base_branch"),
        field(v, "head.ref").alias("head_branch"),
        label_names(v).alias("labels"),
        logins(v, "assignees").alias("assignees"),
        logins(v, "requested_reviewers").alias("requested_reviewers"),
        field(v, "milestone.title").alias("milestone"),
        text("body", "").alias("body"),
        field(v, "mergeable", "boolean").alias("mergeable"),
        *(field(v, name, "bigint").alias(name) for name in ("additions", "deletions", "changed_files", "comments", "review_comments")),
        gaps.alias("data_gaps"),
    )
    pull = F.col("item_kind") == "pull_request"
    closed = period.contains(F.col("closed_at"))
    return out.withColumns(
        {
            "created_in_period": period.contains(F.col("created_at")),
            "closed_in_period": ~pull & closed,
            "merged_in_period": pull & F.col("merged") & period.contains(F.col("merged_at")),
            "closed_unmerged_in_period": pull & ~F.col("merged") & closed,
        }
    )


def _read(children: DataFrame, items: DataFrame) -> DataFrame:
    """Child rows of items that were read, without those that the item's own count says are none."""
    known = items.select(*KEYS, F.col("comments").alias("_comments"), F.col("review_comments").alias("_review_comments"))
    none = F.when(F.col("kind") == "comment", F.col("_comments") == 0).when(F.col("kind") == "review_comment", F.col("_review_comments") == 0)
    return children.join(known, KEYS).where(~F.coalesce(none, F.lit(False))).drop("_comments", "_review_comments")


def source_rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CHILD_KINDS)), kind).cast("int") - 1


def typed_activities(children: DataFrame, items: DataFrame, period: Period) -> DataFrame:
    """Elements that aren't JSON objects go. A review happens when it is submitted, a comment when it is created."""
    v = F.col("_v")
    rows = parsed(_read(children, items).where(F.col("raw").rlike(r"^\s*\{")), "raw").where("_v is not null")
    occurred = F.when(F.col("kind") == "review", field(v, "submitted_at")).otherwise(field(v, "created_at"))
    out = rows.select(
        *KEYS,
        "kind",
        source_rank(F.col("kind")).alias("source_rank"),
        "ordinal",
        login_of(field(v, "user.login")).alias("author"),
        field(v, "author_association").alias("author_association"),
        F.coalesce(field(v, "body"), F.lit("")).alias("body"),
        instant(occurred).alias("occurred_at"),
        instant(field(v, "updated_at")).alias("updated_at"),
        field(v, "html_url").alias("url"),
        is_bot(field(v, "user.login"), field(v, "user.type")).alias("bot"),
        is_maintainer(field(v, "author_association")).alias("maintainer"),
        *(field(v, name).alias(name) for name in ("state", "path", "side")),
        *(field(v, name, "int").alias(name) for name in ("line", "original_line")),
    )
    out = out.withColumns({"in_period": period.contains(F.col("occurred_at")), "updated_in_period": period.contains(F.col("updated_at"))})
    return out.withColumn("active", is_active(F.col("in_period"), F.col("updated_in_period")))


def activity_totals(activities: DataFrame) -> DataFrame:
    """All counts of each item in one aggregation, combined before the shuffle."""
    active, bot, new = F.col("active"), F.col("bot"), F.col("in_period")
    human = ~bot
    counts = {"n_active": active, "n_human": active & human, "n_bot": active & bot, "n_maintainer": active & human & F.col("maintainer")}
    for kind in CHILD_KINDS:
        of = F.col("kind") == kind
        counts |= {f"n_new_{kind}": of & new, f"n_updated_{kind}": of & F.col("updated_in_period") & ~new, f"n_human_{kind}": of & active & human, f"n_bot_{kind}": of & active & bot}
    counts |= {"n_previous": human & ~active, "n_latest_human": human, "n_latest_maintainer": human & F.col("maintainer"), "n_current_review": F.col("kind") == "review"}
    return activities.groupBy(*KEYS).agg(*(F.count_if(rule).alias(name) for name, rule in counts.items()))


def judged(items: DataFrame, totals: DataFrame, failures: DataFrame) -> DataFrame:
    """Items with their counts, gaps, included, exact_activity_unknown and the reason of a reject."""
    names = [c for c in totals.columns if c not in KEYS]
    message = F.concat(F.lit(FAILED_CHILD), "kind", F.lit(" data: "), "error")
    # At most three child reads for each item.
    failed = _read(failures, items).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(source_rank(F.col("kind")).alias("rank"), message.alias("message")))).alias("_failed"))
    rows = items.join(totals, KEYS, "left").join(failed, KEYS, "left").fillna(0, names)
    included = F.col("created_in_period") | F.col("closed_in_period") | F.col("merged_in_period") | F.col("closed_unmerged_in_period") | (F.col("n_active") > 0)
    late = F.transform(F.coalesce("_failed", F.array().cast("array<struct<rank:int,message:string>>")), lambda x: x["message"])
    return rows.withColumn("included", included).withColumn("data_gaps", F.concat("data_gaps", late)).withColumn("_any_failed", F.size(late) > 0).drop("_failed")


def ingest(raw: Raw, period: Period, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> Evidence:
    """keep may store a step and return it as read back. By default the two steps that all others read are stored in the shared folder, so that no raw record of an item is parsed twice."""
    store = keep or keeper(raw.candidates.sparkSession)
    keep = keep or (lambda name, df: df)
    rows = store("looked_up", looked_up(typed_candidates(raw.candidates), raw.details, period))
    items = store("typed_items", typed_items(rows, period))
    activities = keep("activities", typed_activities(raw.children, items, period))
    unknown = period.contains(F.col("updated_at")) & ~F.col("included")
    reason = F.when(F.col("included"), None).when(F.col("_any_failed"), "failed_child").when(unknown, "unexplained_update").otherwise("out_of_period")
    result = judged(items, activity_totals(activities), raw.failures).withColumns({"exact_activity_unknown": unknown, "reason": reason}).drop("_any_failed")
    result = keep("items", result)

    scope = F.concat("item_kind", F.lit(":"), "repository", F.lit("#"), F.col("number").cast("string")).alias("scope")
    lost = rows.where("source is null").select(scope, F.coalesce("error", F.lit("The detail record is missing.")).alias("message"), "url")
    missed = _read(raw.failures, items).select(scope, F.concat(F.lit(FAILED_CHILD), "kind", F.lit(" data: "), "error").alias("message"), "url")
    warnings = keep("warnings", search_warnings(raw.searches).unionByName(lost).unionByName(missed))
    return Evidence(result, activities, warnings, run_summary(result, warnings, raw.requests))


def search_warnings(searches: DataFrame) -> DataFrame:
    """What a search left out. A failed first page has an error and nothing else."""
    short = F.when(F.col("kind") == "pull_request", "pr").otherwise(F.col("kind"))
    no_url = F.lit(None).cast("string")
    none = F.lit(None).cast("struct<message:string,url:string>")
    warning = lambda rule, message, url: F.when(F.coalesce(rule, F.lit(False)), F.struct(message.alias("message"), url.alias("url"))).otherwise(none)
    well = F.col("error").isNull()
    found = F.array_compact(
        F.array(
            warning(~well, F.col("error"), F.col("url")),
            warning(well & (F.col("total_count") >= 1000), F.concat(F.lit("Search API reported "), F.col("total_count").cast("string"), F.lit(" results; only the first 1000 are available.")), no_url),
            warning(well & F.col("incomplete"), F.lit("GitHub Search reported incomplete or partially collected results."), no_url),
            warning(well & F.col("partial_error").isNotNull(), F.concat(F.lit("Pagination stopped after partial success: "), "partial_error"), F.col("url")),
        )
    )
    return searches.select(F.concat(F.lit("search:"), short).alias("scope"), F.explode(found).alias("w")).select("scope", "w.message", "w.url")


def run_summary(items: DataFrame, warnings: DataFrame, requests: DataFrame) -> DataFrame:
    """One row, also for no items at all."""
    kept = F.col("included")
    counts = items.agg(
        F.count_if(kept & (F.col("item_kind") == "issue")).alias("issues"),
        F.count_if(kept & (F.col("item_kind") == "pull_request")).alias("pull_requests"),
        F.count_if(F.col("reason") == "unexplained_update").alias("unexplained_updated_excluded_count"),
        F.count_if(F.col("reason") == "failed_child").alias("activity_failure_excluded_count"),
    )
    noted = warnings.agg(F.count(F.lit(1)).alias("warnings"))
    asked = requests.agg(F.count_if("failed").alias("failed_requests"), F.min(F.expr("try_cast(remaining as int)")).alias("rate_limit_remaining"))
    # Three aggregates of one row each.
    return counts.join(noted, F.lit(True)).join(asked, F.lit(True))


