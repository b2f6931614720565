"""Pull requests, failures and warnings as the service would send them, ingested, each with SQL for the same rows.

Orders are the pull requests: status F is merged, P closed without merge; priority 5 lost its detail record, priority 4 came without a title. Line items are their children:
returnflag A a comment, N a review, R a review comment. Nations are searches, events requests, customers candidates that are none.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import text as T
from loomspan.operators import ingest, ranking, render
from loomspan.plans.catalogue import ORDINAL, QUARTER, updated_at
from loomspan.plans.registry import query, table

_Q = "BETWEEN TIMESTAMP '1996-12-31 16:00:00' AND TIMESTAMP '1997-03-31 15:59:59.999999'"

#: Items and activities as ingestion types them.
TYPED = f"""items AS (SELECT o_orderkey AS number, CASE WHEN o_orderpriority LIKE '4%' THEN '(missing title)' ELSE 'pull ' || o_orderkey END AS title, o_orderstatus AS status, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
o_orderstatus = 'F' AS merged, o_orderdate AS created_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 20 DAY END AS closed_at, o_orderdate + INTERVAL 60 DAY AS touched, o_orderpriority AS priority
FROM orders WHERE o_orderdate + INTERVAL 60 DAY >= TIMESTAMP '1996-12-31 16:00:00' AND o_orderpriority NOT LIKE '5%'),
acts AS (SELECT l_orderkey AS number, CASE l_returnflag WHEN 'A' THEN 'comment' WHEN 'N' THEN 'review' ELSE 'review_comment' END AS kind, ({ORDINAL})::BIGINT AS ordinal, 'p' || (l_suppkey % 4) AS author, l_quantity < 10 AS bot, l_linestatus = 'F' AS maintainer,
l_shipdate AS occurred_at, l_shipdate + INTERVAL 30 DAY AS updated_at, l_shipdate {_Q} AS n, l_shipdate + INTERVAL 30 DAY {_Q} AS u, CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_discount > 0.05 THEN 'APPROVED' ELSE 'COMMENTED' END END AS state
FROM lineitem JOIN items ON l_orderkey = items.number WHERE NOT (l_returnflag = 'R' AND status = 'O')),
totals AS (SELECT number, count(*) FILTER (WHERE n OR u) AS n_active, count(*) FILTER (WHERE (n OR u) AND NOT bot) AS n_human, count(*) FILTER (WHERE (n OR u) AND bot) AS n_bot, count(*) FILTER (WHERE (n OR u) AND NOT bot AND maintainer) AS n_maintainer,
count(*) FILTER (WHERE kind = 'comment' AND n) AS n_new_comment, count(*) FILTER (WHERE kind = 'comment' AND u AND NOT n) AS n_updated_comment, count(*) FILTER (WHERE kind = 'review' AND n) AS n_new_review,
count(*) FILTER (WHERE kind = 'review_comment' AND n) AS n_new_review_comment, count(*) FILTER (WHERE kind = 'review_comment' AND u AND NOT n) AS n_updated_review_comment, count(*) FILTER (WHERE NOT bot AND NOT (n OR u)) AS n_previous
FROM acts GROUP BY number),
flagged AS (SELECT items.*, created_at {_Q} AS created_in_period, coalesce(merged AND closed_at {_Q}, false) AS merged_in_period, coalesce(NOT merged AND closed_at {_Q}, false) AS closed_unmerged_in_period, touched {_Q} AS touched_in_period,
status = 'P' AND priority LIKE '1%' AS failed, coalesce(n_active, 0) AS n_active, coalesce(n_human, 0) AS n_human, coalesce(n_bot, 0) AS n_bot, coalesce(n_maintainer, 0) AS n_maintainer, coalesce(n_new_comment, 0) AS n_new_comment,
coalesce(n_updated_comment, 0) AS n_updated_comment, coalesce(n_new_review, 0) AS n_new_review, coalesce(n_new_review_comment, 0) AS n_new_review_comment, coalesce(n_updated_review_comment, 0) AS n_updated_review_comment, coalesce(n_previous, 0) AS n_previous
FROM items LEFT JOIN totals USING (number)),
judged AS (SELECT *, created_in_period OR merged_in_period OR closed_unmerged_in_period OR n_active > 0 AS included FROM flagged),
warned AS (SELECT 'search:' || kind AS scope, unnest(list_filter([CASE WHEN error IS NOT NULL THEN {{'m': error, 'u': n_name}} END, CASE WHEN error IS NULL AND total >= 1000 THEN {{'m': 'Search API reported ' || total || ' results; only the first 1000 are available.', 'u': NULL}} END,
CASE WHEN error IS NULL AND short THEN {{'m': 'GitHub Search reported incomplete or partially collected results.', 'u': NULL}} END, CASE WHEN error IS NULL AND partial IS NOT NULL THEN {{'m': 'Pagination stopped after partial success: ' || partial, 'u': n_name}} END], lambda x: x IS NOT NULL)) AS w
FROM (SELECT n_name, CASE WHEN n_nationkey < 10 THEN 'issue' ELSE 'pr' END AS kind, n_nationkey * 100 AS total, n_regionkey = 1 AS short, CASE WHEN n_regionkey = 2 THEN 'HTTP 403' END AS error, CASE WHEN n_regionkey = 3 THEN 'HTTP 500' END AS partial FROM nation)),
warnings AS (SELECT scope, w.m AS message, w.u AS url FROM warned
UNION ALL SELECT 'pull_request:o/r#' || o_orderkey, 'HTTP 410', 'https://api.host/' || o_orderkey FROM orders WHERE o_orderpriority LIKE '5%' AND o_orderdate + INTERVAL 60 DAY >= TIMESTAMP '1996-12-31 16:00:00'
UNION ALL SELECT 'pull_request:o/r#' || number, 'Could not collect review data: HTTP 502', 'https://api.host/reviews/' || number FROM judged WHERE failed)"""

_FLAGS = "created_in_period, merged_in_period, closed_unmerged_in_period, included"
_TOTALS = "n_active, n_human, n_bot, n_maintainer, n_new_comment, n_updated_comment, n_new_review, n_new_review_comment, n_updated_review_comment"


def as_received(spark, d) -> ingest.Raw:
    json = lambda **fields: F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))
    place = [F.lit("pull_request").alias("kind"), F.lit("o/r").alias("repository"), F.col("o_orderkey").alias("number")]
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    found = json(number=F.col("o_orderkey"), repository_url=F.lit("https://api.host/repos/o/r"), updated_at=T.iso(updated_at("o_orderdate", 60)), html_url=F.lit("seen"))
    none = json(number=F.col("c_name"), repository_url=F.lit("https://api.host/repos/o/r"), updated_at=F.lit("1997-02-01T00:00:00Z"))
    nowhere = json(number=F.col("c_custkey"), repository_url=F.lit("https://api.host/o/r"), updated_at=F.lit("1997-02-01T00:00:00Z"))
    pull = lambda ordinal, raw: [F.lit("pull_request").alias("kind"), ordinal.alias("ordinal"), raw.alias("raw")]
    customers = table(spark, d, "customer")
    candidates = orders.select(*pull(F.col("o_orderkey"), found)).unionByName(customers.select(*pull(F.col("c_custkey"), none))).unionByName(customers.select(*pull(F.col("c_custkey"), nowhere)))
    lost, ended = F.col("o_orderpriority").startswith("5"), F.when(F.col("o_orderstatus") != "O", T.iso(updated_at("o_orderdate", 20)))
    number = F.col("o_orderkey").cast("string")
    detail = json(
        title=F.when(~F.col("o_orderpriority").startswith("4"), F.concat(F.lit("pull "), number)),
        html_url=F.concat(F.lit("https://host/"), number),
        state=F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed"),
        merged=F.col("o_orderstatus") == "F",
        user=F.struct(F.col("o_custkey").cast("string").alias("login")),
        created_at=T.iso(F.col("o_orderdate")),
        updated_at=T.iso(updated_at("o_orderdate", 60)),
        closed_at=ended,
        merged_at=F.when(F.col("o_orderstatus") == "F", ended),
        comments=F.lit(3),
        review_comments=F.when(F.col("o_orderstatus") == "O", 0).otherwise(2),
        labels=F.array(F.struct(F.col("o_orderpriority").alias("name"))),
    )
    details = orders.select(*place, F.when(~lost, detail).alias("raw"), F.when(lost, "HTTP 410").alias("error"), F.when(lost, F.concat(F.lit("https://api.host/"), number)).alias("url"))
    kind = F.expr("case l_returnflag when 'A' then 'comment' when 'N' then 'review' else 'review_comment' end")
    late = T.iso(updated_at("l_shipdate", 5000))  # a review happens when it is submitted
    said = json(
        user=F.struct(F.concat(F.lit("p"), (F.col("l_suppkey") % 4).cast("string")).alias("login"), F.when(F.col("l_quantity") < 10, "Bot").otherwise("User").alias("type")),
        author_association=F.when(F.col("l_linestatus") == "F", "COLLABORATOR").otherwise("NONE"),
        created_at=F.when(F.col("l_returnflag") == "N", late).otherwise(T.iso(F.col("l_shipdate"))),
        submitted_at=F.when(F.col("l_returnflag") == "N", T.iso(F.col("l_shipdate"))),
        updated_at=T.iso(updated_at("l_shipdate", 30)),
        state=F.when(F.col("l_returnflag") == "N", F.when(F.col("l_discount") > 0.05, "APPROVED").otherwise("COMMENTED")),
    )
    children = lines.select(F.lit("pull_request").alias("item_kind"), F.lit("o/r").alias("repository"), F.col("l_orderkey").alias("number"), kind.alias("kind"), F.expr(ORDINAL).cast("long").alias("ordinal"), said.alias("raw"))
    failed = orders.where("o_orderstatus = 'P' and o_orderpriority like '1%'")
    failures = failed.select(F.lit("pull_request").alias("item_kind"), *place[1:], F.lit("review").alias("kind"), F.lit("HTTP 502").alias("error"), F.concat(F.lit("https://api.host/reviews/"), number).alias("url"))
    region = lambda k, text: F.when(F.col("n_regionkey") == k, text)
    searches = table(spark, d, "nation").select(
        F.when(F.col("n_nationkey") < 10, "issue").otherwise("pull_request").alias("kind"),
        (F.col("n_nationkey") * 100).cast("long").alias("total_count"),
        (F.col("n_regionkey") == 1).alias("incomplete"),
        region(2, "HTTP 403").alias("error"),
        region(3, "HTTP 500").alias("partial_error"),
        F.col("n_name").alias("url"),
    )
    requests = table(spark, d, "events").select((F.col("event_type") == "error").alias("failed"), F.when(F.col("event_type") == "view", "none").otherwise((F.col("user_id") + 10).cast("string")).alias("remaining"))
    return ingest.Raw(candidates, details, children, failures, searches, requests)


@query(f"""WITH {TYPED} SELECT number, title, state, merged, {_FLAGS}, {_TOTALS}, CASE WHEN included THEN NULL WHEN failed THEN 'failed_child' WHEN touched_in_period THEN 'unexplained_update' ELSE 'out_of_period' END AS reason,
touched_in_period AND NOT included AS unknown, priority AS labels, array_to_string(list_filter([CASE WHEN priority LIKE '4%' THEN 'GitHub API response omitted field: title' END, CASE WHEN failed THEN 'Could not collect review data: HTTP 502' END], lambda x: x IS NOT NULL), '; ') AS gaps FROM judged""")
def ingested_pulls(spark, d):
    items = ingest.ingest(as_received(spark, d), QUARTER).items
    names = ["number", "title", "state", "merged", *_FLAGS.split(", "), *_TOTALS.split(", "), "reason"]
    return items.select(*names, F.col("exact_activity_unknown").alias("unknown"), T.list_text(F.col("labels")).alias("labels"), F.array_join("data_gaps", "; ").alias("gaps"))


@query(f"""WITH {TYPED} SELECT number, '| o/r#' || number || ' | o/r | ' || number || ' | ' || title || ' | ' || CASE WHEN merged THEN 'merged' ELSE state END || ' | ' || CASE WHEN created_in_period THEN 'yes' ELSE 'no' END || ' | '
|| CASE WHEN closed_unmerged_in_period THEN 'yes' ELSE 'no' END || ' | ' || CASE WHEN merged_in_period THEN 'yes' ELSE 'no' END || ' | ' || n_human || ' | NONE | ' || priority || ' | [evidence](#pull-request-o-r-' || number || ') |' AS row FROM judged WHERE included""")
def evidence_index_pulls(spark, d):
    items = ingest.ingest(as_received(spark, d), QUARTER).items
    return items.where("included").select("number", render.index_row("pull_request").alias("row"))


@query(f"WITH {TYPED} SELECT scope, message, url FROM warnings")
def ingest_warnings(spark, d):
    return ingest.ingest(as_received(spark, d), QUARTER).warnings


@query(f"""WITH {TYPED} SELECT 0::BIGINT AS issues, count(*) FILTER (WHERE included) AS pull_requests, count(*) FILTER (WHERE NOT included AND NOT failed AND touched_in_period) AS unexplained_updated_excluded_count,
count(*) FILTER (WHERE NOT included AND failed) AS activity_failure_excluded_count, (SELECT count(*) FROM warnings) AS warnings, (SELECT count(*) FROM events WHERE event_type = 'error') AS failed_requests,
(SELECT min(user_id + 10)::INT FROM events WHERE event_type <> 'view') AS rate_limit_remaining FROM judged""")
def ingest_summary_pulls(spark, d):
    return ingest.ingest(as_received(spark, d), QUARTER).summary


@query(f"""WITH {TYPED} SELECT number, author, state, occurred_at FROM (SELECT *, row_number() OVER (PARTITION BY number, author ORDER BY state IN ('APPROVED', 'CHANGES_REQUESTED', 'DISMISSED') DESC, occurred_at DESC NULLS LAST, ordinal) AS k FROM acts WHERE kind = 'review') WHERE k = 1""")
def pull_reviews(spark, d):
    reviews = ingest.ingest(as_received(spark, d), QUARTER).activities.where("kind = 'review'")
    out = ranking.current_review(reviews, [*ingest.KEYS, "author"], "state", "occurred_at", render.TIES, list(render.K.DECISIVE))
    return out.select("number", "author", "state", F.col("occurred_at").cast("timestamp_ntz").alias("occurred_at"))


_RANK = "CASE kind WHEN 'comment' THEN 0 WHEN 'review' THEN 1 ELSE 2 END"


@query(f"""WITH {TYPED}, ranked AS (SELECT *, n OR u AS active, {_RANK} AS source, row_number() OVER (PARTITION BY number, bot ORDER BY occurred_at DESC NULLS LAST, {_RANK}, ordinal) AS latest,
row_number() OVER (PARTITION BY number, bot, maintainer ORDER BY occurred_at DESC NULLS LAST, {_RANK}, ordinal) AS own, row_number() OVER (PARTITION BY number, bot, n OR u ORDER BY occurred_at DESC NULLS LAST, {_RANK}, ordinal) AS before,
row_number() OVER (PARTITION BY number, kind, author ORDER BY coalesce(state IN ('APPROVED', 'CHANGES_REQUESTED', 'DISMISSED'), false) DESC, occurred_at DESC NULLS LAST, ordinal) AS review FROM acts)
SELECT number, g AS "group", occurred_at AS at, CASE g WHEN 'previous' THEN -before ELSE source * 1099511627776 + ordinal END AS pos, CASE g WHEN 'current_review' THEN author ELSE '' END AS tie FROM (SELECT *, unnest(list_filter([CASE WHEN active THEN CASE WHEN bot THEN 'bot_' ELSE 'human_' END || kind END,
CASE WHEN NOT bot AND latest = 1 THEN 'latest_human' END, CASE WHEN NOT bot AND maintainer AND own = 1 THEN 'latest_maintainer' END, CASE WHEN NOT bot AND NOT active AND before <= 3 THEN 'previous' END, CASE WHEN kind = 'review' AND review = 1 THEN 'current_review' END], lambda x: x IS NOT NULL)) AS g FROM ranked)""")
def shown_pull_activities(spark, d):
    shown = render.shown_activities(ingest.ingest(as_received(spark, d), QUARTER).activities)
    return shown.select("number", "group", F.col("at").cast("timestamp_ntz").alias("at"), "pos", "tie")


@query("SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'unknown-repository' ELSE c_mktsegment END || '#' || CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_custkey::VARCHAR END AS name FROM customer")
def candidate_names(spark, d):
    rows = table(spark, d, "customer")
    name = ingest.candidate_id(F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment")), F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")))
    return rows.select("c_custkey", name.alias("name"))


# Every field of an item: even orders are issues, odd ones pull requests; priorities of 3 and more have milestones.
_ALL_TOUCHED = "o_orderdate + INTERVAL 40 DAY >= TIMESTAMP '1996-12-31 16:00:00'"


@query(f"""WITH i AS (SELECT *, o_orderkey % 2 = 0 AS issue, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 20 DAY END AS closed FROM orders WHERE {_ALL_TOUCHED})
SELECT CASE WHEN issue THEN 'issue' ELSE 'pull_request' END AS item_kind, o_orderkey AS number, issue AND coalesce(closed {_Q}, false) AS closed_in_period, NOT issue AND o_orderstatus = 'F' AND coalesce(closed {_Q}, false) AS merged_in_period,
NOT issue AND o_orderstatus <> 'F' AND coalesce(closed {_Q}, false) AS closed_unmerged_in_period, o_orderdate {_Q} AS created_in_period, coalesce(o_orderdate {_Q} OR closed {_Q}, false) AS included,
CASE WHEN o_orderstatus = 'F' AND issue THEN 'completed' END AS state_reason, CASE WHEN o_orderpriority > '3' THEN 'm' || substr(o_orderpriority, 1, 1) END AS milestone, CASE WHEN NOT issue THEN 'main' END AS base_branch, CASE WHEN NOT issue THEN 'b' || o_custkey END AS head_branch,
NOT issue AND o_orderkey % 3 = 0 AS draft, CASE WHEN NOT issue AND o_orderkey % 5 > 0 THEN o_orderkey % 5 = 1 END AS mergeable, CASE WHEN NOT issue THEN o_orderkey END AS additions, CASE WHEN NOT issue THEN o_custkey END AS deletions, CASE WHEN NOT issue THEN o_orderkey % 7 END AS changed_files,
CASE WHEN o_orderkey % 4 < 2 THEN 'a' || o_custkey || ', unknown' ELSE 'None' END AS assignees, CASE WHEN NOT issue THEN 'r' || o_custkey ELSE 'None' END AS reviewers FROM i""")
def ingested_fields(spark, d):
    orders = table(spark, d, "orders")
    issue, number = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")
    only = lambda value: F.when(~issue, value)
    ended = F.when(F.col("o_orderstatus") != "O", T.iso(updated_at("o_orderdate", 20)))
    login = lambda letter: F.struct(F.concat(F.lit(letter), F.col("o_custkey").cast("string")).alias("login"))
    fields = dict(
        number=number,
        repository_url=F.lit("https://api.host/repos/o/r"),
        title=F.lit("t"),
        html_url=F.lit("h"),
        state=F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed"),
        state_reason=F.when(issue & (F.col("o_orderstatus") == "F"), "completed"),
        user=login("u"),
        created_at=T.iso(F.col("o_orderdate")),
        updated_at=T.iso(updated_at("o_orderdate", 40)),
        closed_at=ended,
        merged=only(F.col("o_orderstatus") == "F"),
        merged_at=only(F.when(F.col("o_orderstatus") == "F", ended)),
        draft=only(number % 3 == 0),
        mergeable=only(F.when(number % 5 > 0, number % 5 == 1)),
        additions=only(number),
        deletions=only(F.col("o_custkey")),
        changed_files=only(number % 7),
        base=only(F.struct(F.lit("main").alias("ref"))),
        head=only(F.struct(F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("ref"))),
        assignees=F.when(number % 4 < 2, F.array(login("a"), F.struct(F.lit("").alias("login")))),
        requested_reviewers=only(F.array(login("r"))),
        milestone=F.when(F.col("o_orderpriority") >= "3", F.struct(F.concat(F.lit("m"), F.substring("o_orderpriority", 1, 1)).alias("title"))),
        comments=F.lit(0),
    )
    raw = F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))
    kind = F.when(issue, "issue").otherwise("pull_request")
    none = lambda schema: spark.createDataFrame([], schema)
    made = ingest.Raw(
        candidates=orders.select(kind.alias("kind"), number.alias("ordinal"), raw.alias("raw")),
        details=orders.where(~issue).select(kind.alias("kind"), F.lit("o/r").alias("repository"), number.alias("number"), raw.alias("raw"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("url")),
        children=none("item_kind string, repository string, number long, kind string, ordinal long, raw string"),
        failures=none("item_kind string, repository string, number long, kind string, error string, url string"),
        searches=none("kind string, total_count long, incomplete boolean, error string, partial_error string, url string"),
        requests=none("failed boolean, remaining string"),
    )
    names = ["item_kind", "number", "closed_in_period", "merged_in_period", "closed_unmerged_in_period", "created_in_period", "included", "state_reason", "milestone", "base_branch", "head_branch", "draft", "mergeable", "additions", "deletions", "changed_files"]
    return ingest.ingest(made, QUARTER).items.select(*names, T.list_text(F.col("assignees")).alias("assignees"), T.list_text(F.col("requested_reviewers")).alias("reviewers"))
