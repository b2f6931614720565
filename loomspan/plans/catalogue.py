"""Named queries over the driver's tables, each with its SQL equivalent.

The tables stand in for the domain's: orders are items, lineitem their activities (returnflag R: a robot's), events reviews, documents bodies, conversations threads.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan import formats as K
from loomspan.functions import text as T
from loomspan.operators import activity, ingest, lines, ranking, render
from loomspan.period import build_period, within
from loomspan.plans.registry import query, table
from loomspan.storage import keeper

START, END = "1997-01-01 00:00:00", "1997-03-31 23:59:59.999999"
TIES = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

def in_period(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return within(ts, F.lit(START).cast("timestamp_ntz"), F.lit(END).cast("timestamp_ntz"))


def updated_at(ts: str, days: int) -> Column:
    return F.col(ts) + F.expr(f"interval {days} days")


_P = f"BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
_ITEMS = "o_orderkey, o_custkey, o_orderstatus, o_orderdate"
_ACTIVE = f"EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate {_P})"


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def _included(spark, d, negate=False):
    active = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate").where(in_period("l_shipdate"))
    return activity.included(_orders(spark, d), active, "o_orderkey", "l_orderkey", in_period("o_orderdate"), negate)


@query(f"SELECT {_ITEMS} FROM orders WHERE o_orderdate {_P} OR {_ACTIVE}")
def period_include(spark, d):
    return _included(spark, d)


@query(f"SELECT {_ITEMS} FROM orders WHERE NOT (o_orderdate {_P} OR {_ACTIVE})")
def period_rejects(spark, d):
    return _included(spark, d, True)


@query(f"""SELECT CASE WHEN o_orderstatus = 'P' THEN 'failed_child' WHEN o_orderdate + INTERVAL 60 DAY {_P} THEN 'unexplained_update' ELSE 'out_of_period' END AS reason, count(*) AS n
FROM orders WHERE NOT (o_orderdate {_P} OR {_ACTIVE}) GROUP BY 1""")
def reject_reasons(spark, d):
    return activity.reasons(_included(spark, d, True), F.col("o_orderstatus") == "P", in_period(updated_at("o_orderdate", 60)))


@query("""SELECT user_id, event_type, event_id, value, position FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k, min(event_id) OVER (PARTITION BY user_id, event_type) AS position FROM events) WHERE k = 1""")
def dedup_keep_last(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return ranking.keep_last(events, ["user_id", "event_type"], "event_id")


_COUNTS = f"""count(*) FILTER (WHERE n) AS new_count, count(*) FILTER (WHERE u AND NOT n) AS updated_count, count(*) FILTER (WHERE (n OR u) AND NOT b) AS human_count,
count(*) FILTER (WHERE (n OR u) AND b) AS bot_count, count(*) FILTER (WHERE (n OR u) AND m AND NOT b) AS maintainer_count
FROM (SELECT l_orderkey, l_returnflag, l_shipdate {_P} AS n, l_shipdate + INTERVAL 30 DAY {_P} AS u, l_returnflag = 'R' AS b, l_linestatus = 'F' AS m FROM lineitem)"""


def _counts(spark, d, keys):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate")
    return activity.counts(rows, keys, in_period("l_shipdate"), in_period(updated_at("l_shipdate", 30)), F.col("l_returnflag") == "R", F.col("l_linestatus") == "F")


@query(f"SELECT l_orderkey, {_COUNTS} GROUP BY l_orderkey")
def activity_counts(spark, d):
    return _counts(spark, d, ["l_orderkey"])


@query(f"SELECT l_orderkey, l_returnflag, {_COUNTS} GROUP BY l_orderkey, l_returnflag")
def activity_counts_by_kind(spark, d):
    return _counts(spark, d, ["l_orderkey", "l_returnflag"])


@query(f"SELECT l_returnflag, coalesce(bool_or(l_shipdate {_P}), false) AS any_active FROM lineitem GROUP BY 1")
def activity_any(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.coalesce(F.bool_or(in_period("l_shipdate")), F.lit(False)).alias("any_active"))


_LAST = "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem WHERE {}) WHERE k = 1"


def _latest(spark, d, where):
    rows = table(spark, d, "lineitem").where(where).select("l_orderkey", "l_shipdate", *TIES)
    return ranking.latest(rows, ["l_orderkey"], "l_shipdate", TIES).select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query(_LAST.format("l_returnflag <> 'R'"))
def latest_human(spark, d):
    return _latest(spark, d, "l_returnflag <> 'R'")


@query(_LAST.format("l_returnflag <> 'R' AND l_linestatus = 'F'"))
def latest_maintainer(spark, d):
    return _latest(spark, d, "l_returnflag <> 'R' and l_linestatus = 'F'")


@query(f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey, l_extendedprice)::INT AS rank
FROM lineitem WHERE l_returnflag <> 'R' AND NOT (l_shipdate {_P} OR l_shipdate + INTERVAL 30 DAY {_P})) WHERE rank <= 3""")
def previous_top3(spark, d):
    rows = table(spark, d, "lineitem").where((F.col("l_returnflag") != "R") & ~(in_period("l_shipdate") | in_period(updated_at("l_shipdate", 30))))
    out = ranking.previous_context(rows.select("l_orderkey", "l_shipdate", *TIES), ["l_orderkey"], "l_shipdate", TIES)
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "rank")


@query("""SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY upper(event_type) IN ('PURCHASE', 'SIGNUP') DESC, ts DESC NULLS LAST, event_id) AS k FROM events) WHERE k = 1""")
def current_review(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return ranking.current_review(rows, ["user_id"], "event_type", "ts", ["event_id"], ["PURCHASE", "SIGNUP"])


@query("SELECT doc_id, substring(text, 1, 12000) AS body, length(text) > 12000 AS truncated, length(text)::INT AS n FROM documents")
def body_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncated(F.col("text"), 12000).alias("body"), (F.length("text") > 12000).alias("truncated"), F.length("text").alias("n"))


@query("SELECT doc_id, repeat('`', greatest(4, coalesce(list_max(list_transform(regexp_extract_all(text, '[aeiou]+'), lambda x: length(x))), 0) + 1)::INT) AS fence FROM documents")
def fence_len(spark, d):
    return table(spark, d, "documents").select("doc_id", F.repeat(F.lit("`"), F.greatest(F.lit(4), T.longest_run(F.col("text"), "[aeiou]+") + 1)).alias("fence"))


@query("SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS anchor FROM pages")
def anchor_slug(spark, d):
    return table(spark, d, "pages").select("page_id", T.slug(F.col("url")).alias("anchor"))


@query("SELECT page_id, CASE WHEN strpos(url, '/en/') > 0 THEN substring(url, strpos(url, '/en/') + 4) END AS suffix FROM pages")
def url_suffix(spark, d):
    return table(spark, d, "pages").select("page_id", T.after_first(F.col("url"), "/en/").alias("suffix"))


@query(r"""SELECT page_id, CASE WHEN c = '' THEN 'None' ELSE c END AS cell FROM (SELECT page_id, regexp_replace(replace(replace(replace(translate(html, 'ae', '|\'), '\', '\\'), '|', '\|'), chr(10), ' '), '^\s+|\s+$', '', 'g') AS c FROM pages)""")
def cell_escape(spark, d):
    return table(spark, d, "pages").select("page_id", T.cell(F.translate("html", "ae", "|\\")).alias("cell"))


@query("SELECT doc_id, bytes FROM (SELECT doc_id, sum(strlen(text)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS bytes FROM documents) WHERE bytes <= 20000")
def byte_page(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("size"))
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = ((high or 0) - (low or 0)) // 10_000 + 1  # so that at most 10,000 totals meet in one task, however many rows there are
    return lines.byte_page(rows, [F.col("doc_id")], F.col("size"), 20_000, F.expr(f"(doc_id - {low or 0}) div {width}")).select("doc_id", "bytes")


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS thread FROM conversations GROUP BY conv_id")
def ordered_concat(spark, d):
    rows = table(spark, d, "conversations").withColumn("said", F.concat("role", F.lit(": "), "text"))
    return rows.groupBy("conv_id").agg(F.expr("listagg(said, '\n') within group (order by turn)").alias("thread"))


_LINES = "(SELECT doc_id, unnest(range(len(string_split(text, chr(10)))))::INT AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(f"SELECT doc_id, line_no, line FROM {_LINES}")
def doc_lines(spark, d):
    return lines.doc_lines(table(spark, d, "documents"), "doc_id", "text")


@query(f"SELECT doc_id, line_no, last_value(CASE WHEN length(line) < 40 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM {_LINES}")
def carry_forward(spark, d):
    rows = lines.doc_lines(table(spark, d, "documents"), "doc_id", "text")
    return lines.carried(rows, "doc_id", F.length("line") < 40, "section").select("doc_id", "line_no", "section")


@query(f"SELECT doc_id, line_no, last_value(CASE WHEN length(line) >= 40 THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {_LINES}")
def prev_nonblank(spark, d):
    rows = lines.doc_lines(table(spark, d, "documents"), "doc_id", "text")
    return lines.previous(rows, "doc_id", F.length("line") >= 40, "before").select("doc_id", "line_no", "before")


@query(f"SELECT doc_id, count(DISTINCT island) AS paragraphs FROM (SELECT doc_id, line, sum((length(line) < 40)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM {_LINES}) WHERE length(line) >= 40 GROUP BY doc_id")
def paragraphs(spark, d):
    rows = lines.doc_lines(table(spark, d, "documents"), "doc_id", "text")
    return lines.islands(rows, "doc_id", F.length("line") < 40)


@query("SELECT conv_id, count(*) AS turns, bool_and(turn = k - 1) AS in_sequence FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) GROUP BY conv_id")
def sequence_check(spark, d):
    rows = ranking.ranked(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], [F.asc("turn")])
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.bool_and(F.col("turn") == F.col("rank") - 1).alias("in_sequence"))


@query("SELECT doc_id, len(regexp_extract_all(translate(text, 'ae', '#7'), '#[0-9]+'))::INT AS refs FROM documents")
def item_refs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.regexp_count(F.translate("text", "ae", "#7"), F.lit("#[0-9]+")).alias("refs"))


@query(f"""SELECT (SELECT count(*) FROM orders WHERE o_orderdate {_P} OR {_ACTIVE}) AS retained, (SELECT count(*) FROM orders WHERE NOT (o_orderdate {_P} OR {_ACTIVE})) AS excluded, CAST(NULL AS INT) AS rate_limit_remaining""")
def run_summary(spark, d):
    active = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate").where(in_period("l_shipdate"))
    keys = active.select(F.col("l_orderkey").alias("k")).distinct().withColumn("any", F.lit(True))
    kept = in_period("o_orderdate") | F.coalesce("any", F.lit(False))
    joined = table(spark, d, "orders").select("o_orderkey", "o_orderdate").join(keys, F.col("o_orderkey") == F.col("k"), "left")
    return joined.agg(F.count_if(kept).alias("retained"), F.count_if(~kept).alias("excluded"), F.lit(None).cast("int").alias("rate_limit_remaining"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY lower(c_mktsegment), c_custkey LIMIT 50 OFFSET 100")
def index_page(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment").orderBy(F.lower("c_mktsegment"), "c_custkey").offset(100).limit(50)


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, 0::INT AS source_rank FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, 1::INT FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, 2::INT FROM lineitem WHERE l_returnflag = 'R'""")
def union_kinds(spark, d):
    rank = F.expr("case l_returnflag when 'A' then 0 when 'N' then 1 when 'R' then 2 end")  # one scan instead of one for each kind
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", rank.alias("source_rank")).where("source_rank is not null")


@query("SELECT event_id, array_to_string(list_filter(['k', 'missing', 'session'], lambda x: NOT list_contains(json_keys(props), x)), ',') AS missing FROM events")
def missing_fields(spark, d):
    required = F.array(*map(F.lit, ("k", "missing", "session")))
    return table(spark, d, "events").select("event_id", F.array_join(F.array_except(required, F.json_object_keys("props")), ",").alias("missing"))


@query("SELECT CAST(timezone('Asia/Shanghai', timezone('UTC', ts)) AS DATE) AS local_date, count(*) AS n FROM events GROUP BY 1")
def local_date_counts(spark, d):
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Shanghai"), F.col("ts"))
    return table(spark, d, "events").groupBy(F.to_date(local).alias("local_date")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH RECURSIVE c AS (SELECT doc_id, text, -1 AS chunk_no, 0::BIGINT AS begin, 0::BIGINT AS n FROM documents UNION ALL
SELECT doc_id, text, chunk_no + 1, begin + n, (SELECT max(k) FROM range(1, 1001) r(k) WHERE strlen(substring(text, (begin + n + 1), k)) <= 1000) FROM c WHERE begin + n < length(text) OR chunk_no < 0)
SELECT doc_id, chunk_no, substring(text, begin + 1, n) AS chunk FROM c WHERE chunk_no >= 0""")
def utf8_chunks(spark, d):
    chunks = T.utf8_chunks(F.col("text"), 1000)
    return table(spark, d, "documents").select("doc_id", F.posexplode(chunks).alias("chunk_no", "chunk"))


@query("""WITH RECURSIVE t AS (SELECT doc_id, translate(text, 'aeiounts', '中文🚀éß🎉д한') AS text FROM documents),
c AS (SELECT doc_id, text AS rest, -1 AS chunk_no, '' AS chunk FROM t UNION ALL SELECT doc_id, substring(rest, n + 1), chunk_no + 1, left(rest, n) FROM
(SELECT *, coalesce(list_max(list_filter(generate_series(1, 256), lambda k: strlen(left(w, k::INT)) <= 256)), 0)::INT AS n FROM (SELECT *, left(rest, 256) AS w FROM c WHERE rest <> '' OR chunk_no < 0)))
SELECT doc_id, chunk_no, strlen(chunk)::INT AS bytes, md5(chunk) AS chunk_md5 FROM c WHERE chunk_no >= 0""")
def utf8_chunks_wide(spark, d):
    wide = F.translate("text", "aeiounts", "中文🚀éß🎉д한")
    chunks = table(spark, d, "documents").select("doc_id", F.posexplode(T.utf8_chunks(wide, 256)).alias("chunk_no", "chunk"))
    return chunks.select("doc_id", "chunk_no", F.octet_length("chunk").alias("bytes"), F.md5("chunk").alias("chunk_md5"))


# No document holds a backtick, so every fence is a line of its own here and they open and close in turn.
@query("""WITH l AS (SELECT doc_id, unnest(range(len(x)))::INT AS line_no, unnest(x) = '```' AS fence FROM (SELECT doc_id, string_split(replace(text, 'The ', '```' || chr(10)), chr(10)) AS x FROM documents))
SELECT doc_id, line_no, NOT fence AND count(*) FILTER (WHERE fence) OVER (PARTITION BY doc_id ORDER BY line_no) % 2 = 0 AS visible FROM l""")
def visible_lines(spark, d):
    text = F.replace("text", F.lit("The "), F.lit("```\n"))
    return table(spark, d, "documents").select("doc_id", F.posexplode(lines.visible(text)).alias("line_no", "visible"))


@query("""SELECT doc_id, fence || 'markdown' || chr(10) || CASE WHEN text = '' THEN '(empty)' ELSE replace(substring(text, 1, 12000), '<!-- ITEM_', '&lt;!-- ITEM_') END || chr(10) || fence
|| CASE WHEN length(text) > 12000 THEN chr(10) || chr(10) || '_[Truncated at 12,000 characters by the collector.]_' ELSE '' END AS body
FROM (SELECT doc_id, text, repeat('`', greatest(4, coalesce(list_max(list_transform(regexp_extract_all(substring(text, 1, 12000), '`+'), lambda x: length(x))), 0) + 1)::INT) AS fence FROM documents)""")
def fenced_body(spark, d):
    return table(spark, d, "documents").select("doc_id", T.fenced(F.col("text"), 12000).alias("body"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS at FROM events")
def iso_time(spark, d):
    return table(spark, d, "events").select("event_id", T.iso(F.col("ts")).alias("at"))


#: A place of arrival that no two line items of an order share.
ORDINAL = "l_partkey * 100000 + l_suppkey * 10 + l_linenumber"

# The raw zone of an organisation whose issues are the orders and whose comments are the line items, as the service would send it.
QUARTER = build_period(1, date(1997, 1, 1), date(1997, 3, 31))
_Q = "BETWEEN TIMESTAMP '1996-12-31 16:00:00' AND TIMESTAMP '1997-03-31 15:59:59.999999'"
_JUDGED = f"""WITH acts AS (SELECT l_orderkey, l_shipdate {_Q} AS n, l_shipdate + INTERVAL 30 DAY {_Q} AS u, l_returnflag = 'R' AS b, l_linestatus = 'F' AS m FROM lineitem),
totals AS (SELECT l_orderkey, count(*) FILTER (WHERE n OR u) AS a, count(*) FILTER (WHERE (n OR u) AND NOT b) AS h, count(*) FILTER (WHERE (n OR u) AND NOT b AND m) AS m,
count(*) FILTER (WHERE n) AS n, count(*) FILTER (WHERE u AND NOT n) AS u FROM acts GROUP BY 1),
judged AS (SELECT o_orderkey AS number, o_orderstatus AS state, o_orderdate {_Q} AS created, o_orderdate {_Q} OR coalesce(a, 0) > 0 AS included, o_orderdate + INTERVAL 60 DAY {_Q} AS touched,
coalesce(a, 0) AS n_active, coalesce(h, 0) AS n_human, coalesce(totals.m, 0) AS n_maintainer, coalesce(n, 0) AS n_new_comment, coalesce(u, 0) AS n_updated_comment
FROM orders LEFT JOIN totals ON l_orderkey = o_orderkey WHERE o_orderdate + INTERVAL 60 DAY >= TIMESTAMP '1996-12-31 16:00:00')"""


def _as_received(spark, d) -> ingest.Raw:
    json = lambda **fields: F.to_json(F.struct(*(value.alias(name) for name, value in fields.items()))).alias("raw")
    text = lambda value: F.concat(F.lit("item "), F.col(value).cast("string"))
    user = lambda login: F.struct(login.alias("login"))
    issue = json(
        number=F.col("o_orderkey"),
        repository_url=F.lit("https://api.host/repos/o/r"),
        title=text("o_orderkey"),
        html_url=text("o_orderkey"),
        state=F.col("o_orderstatus"),
        user=user(F.col("o_custkey").cast("string")),
        created_at=T.iso(F.col("o_orderdate")),
        updated_at=T.iso(updated_at("o_orderdate", 60)),
        comments=F.lit(1),
    )
    said = json(
        user=user(F.when(F.col("l_returnflag") == "R", "r[bot]").otherwise("p")),
        author_association=F.when(F.col("l_linestatus") == "F", "MEMBER").otherwise("NONE"),
        created_at=T.iso(F.col("l_shipdate")),
        updated_at=T.iso(updated_at("l_shipdate", 30)),
    )
    candidates = table(spark, d, "orders").select(F.lit("issue").alias("kind"), F.col("o_orderkey").alias("ordinal"), issue)
    place = [F.lit("issue").alias("item_kind"), F.lit("o/r").alias("repository"), F.col("l_orderkey").alias("number")]
    children = table(spark, d, "lineitem").select(*place, F.lit("comment").alias("kind"), F.expr(ORDINAL).cast("long").alias("ordinal"), said)
    none = lambda schema: spark.createDataFrame([], schema)
    return ingest.Raw(
        candidates=candidates,
        details=none("kind string, repository string, number long, raw string, error string, url string"),
        children=children,
        failures=none("item_kind string, repository string, number long, kind string, error string, url string"),
        searches=none("kind string, total_count long, incomplete boolean, error string, partial_error string, url string"),
        requests=none("failed boolean, remaining string"),
    )


@query(f"""{_JUDGED} SELECT number, included, CASE WHEN included THEN NULL WHEN touched THEN 'unexplained_update' ELSE 'out_of_period' END AS reason, n_active, n_human, n_maintainer, n_new_comment, n_updated_comment FROM judged""")
def ingested_items(spark, d):
    names = ["number", "included", "reason", "n_active", "n_human", "n_maintainer", "n_new_comment", "n_updated_comment"]
    return ingest.ingest(_as_received(spark, d), QUARTER).items.select(*names)


_INDEX = """SELECT number, '| o/r#' || number || ' | o/r | ' || number || ' | item ' || number || ' | ' || state || ' | ' || CASE WHEN created THEN 'yes' ELSE 'no' END || ' | no | ' || n_human
|| ' | NONE | None | [evidence](#issue-o-r-' || number || ') |' AS row FROM judged WHERE included"""


@query(f"{_JUDGED} {_INDEX}")
def evidence_index(spark, d):
    items = ingest.ingest(_as_received(spark, d), QUARTER).items
    return items.where("included").select("number", render.index_row("issue").alias("row"))


@query(f"""{_JUDGED} SELECT count(*) FILTER (WHERE included) AS issues, 0::BIGINT AS pull_requests, count(*) FILTER (WHERE NOT included AND touched) AS unexplained_updated_excluded_count,
0::BIGINT AS activity_failure_excluded_count, 0::BIGINT AS warnings, 0::BIGINT AS failed_requests, NULL::INT AS rate_limit_remaining FROM judged""")
def ingest_summary(spark, d):
    return ingest.ingest(_as_received(spark, d), QUARTER).summary


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _fragments_sql() -> str:
    """The rows of the document of the issues: fixed texts, index rows, paragraphs of each item, and activities at the places of their groups."""
    iso = lambda ts: f"strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00')"
    yes = lambda flag: f"CASE WHEN {flag} THEN 'yes' ELSE 'no' END"
    code = lambda label, value: f"'- {label}: `' || {value} || '`'"
    lines = lambda *x: " || chr(10) || ".join(x)
    none = lambda count: f"CASE WHEN {count} = 0 THEN 'None.' END"
    S = K.ISSUE_SECTIONS
    body = "'````markdown' || chr(10) || '(empty)' || chr(10) || '````'"
    metadata = lines(
        "'- Title: item ' || number", "'- URL: item ' || number", code("State", "state"), code("State reason", "'Not provided'"), code("Author", "author"), code("Author association", "'NONE'"),
        code("Created at", iso("created_at")), code("Updated at", iso("created_at + INTERVAL 60 DAY")), code("Closed at", "'Not provided'"),
    )
    activity = lines(
        code("Created in period", yes("created")), code("Closed in period", "'no'"), code("New comments", "n_new_comment"), code("Updated existing comments", "n_updated_comment"), code("Human comment activity", "n_human"),
        code("Bot comment activity", "n_bot"), code("Maintainer/member/collaborator comment activity", "n_maintainer"),
    )
    paragraphs = [
        "'<!-- ITEM_START issue o/r#' || number || ' -->'", "'<a id=\"issue-o-r-' || number || '\"></a>'", "'### Issue: o/r#' || number", _literal(S[0]), metadata, _literal(S[1]), activity, _literal(S[2]),
        lines("'- Labels: None'", "'- Assignees: None'", "'- Milestone: None'"), _literal(S[3]), body, _literal(S[4]), none("n_previous"), _literal(S[5]), "'**Human comments**'", none("n_human"),
        "'**Bot comments (lower-salience evidence)**'", none("n_bot"), _literal(S[6]), none("n_latest_human"), _literal(S[7]), none("n_latest_maintainer"), _literal(S[8]), "'None.'", "'<!-- ITEM_END issue o/r#' || number || ' -->'",
    ]
    own = ", ".join(f"{{'part': {k}, 'text': {text}}}" for k, text in enumerate(paragraphs))
    facts = "'- author: `' || author || '`; association: `' || CASE WHEN m THEN 'MEMBER' ELSE 'NONE' END || '`; bot: `' || " + yes("b") + " || '`; occurred_at: `' || " + iso("seen") + " || '`; in_period: `' || " + yes("n")
    facts += " || '`; updated_at: `' || " + iso("seen + INTERVAL 30 DAY") + " || '`; updated_in_period: `' || " + yes("u") + f" || '`' || chr(10) || chr(10) || {body}"
    by_time = "ORDER BY seen DESC NULLS LAST, ordinal"
    shown = ", ".join(
        f"CASE WHEN {condition} THEN {{'part': {part}, 'pos': {pos}}} END"
        for part, condition, pos in ((15, "(n OR u) AND NOT b", "ordinal"), (17, "(n OR u) AND b", "ordinal"), (19, "NOT b AND latest = 1", "ordinal"), (21, "NOT b AND m AND own = 1", "ordinal"), (12, "NOT b AND NOT (n OR u) AND before <= 3", "-before"))
    )
    start, end = QUARTER.local_start.isoformat(), QUARTER.local_end.isoformat()
    utc_start, utc_end = QUARTER.utc_start.isoformat(), QUARTER.utc_end.isoformat()
    front = f'---\nschema_version: "1.0"\norganization: "o"\ngenerated_at: "{utc_end}"\ntimezone: "Asia/Shanghai"\nlocal_start: "{start}"\nlocal_end: "{end}"\nutc_start: "{utc_start}"\nutc_end: "{utc_end}"\nissue_count: '
    middle = f"\npull_request_count: 0\ncollection_warning_count: 0\n---\n\n# o GitHub Activity Evidence\n\n{K.TOP_SECTIONS[0]}\n\n{K.DOCUMENT_MAP}\n\n{K.TOP_SECTIONS[1]}\n\n- Organization: `o`\n"
    middle += f"- Local scan period: `{start}` through `{end}`\n- UTC scan period: `{utc_start}` through `{utc_end}`\n- UTC+8 Search API date window: `1997-01-01` through `1997-03-31`\n- Issues retained after exact local filtering: `"
    last = "`\n- Items excluded after activity endpoint failures: `0`\n- Failed API requests: `0`\n- GitHub API rate limit remaining: `unknown`"
    retained = "`\n- Pull requests retained after exact local filtering: `0`\n- Items excluded because `updated_at` was the only period match: `"
    count, touched = "(SELECT count(*) FROM judged WHERE included)", "(SELECT count(*) FROM judged WHERE NOT included AND touched)"
    fixed = [
        (0, f"{_literal(front)} || {count} || {_literal(middle)} || {count} || {_literal(retained)} || {touched} || {_literal(last)}"),
        (1, _literal(f"{K.TOP_SECTIONS[2]}\n\n{K.ISSUE_COLUMNS}")), (3, _literal(f"{K.TOP_SECTIONS[3]}\n\n{K.PULL_COLUMNS}\n")), (5, _literal(K.TOP_SECTIONS[4])), (7, _literal(f"{K.TOP_SECTIONS[5]}\n\nNo matching pull requests.")),
        (9, _literal(f"{K.TOP_SECTIONS[6]}\n\nNone.")), (11, _literal(f"{K.TOP_SECTIONS[7]}\n\n{K.LIMITATIONS}\n")),
    ]
    place = "NULL AS k1, NULL AS k2, NULL::BIGINT AS number, NULL::INT AS part, NULL::TIMESTAMP AS at, NULL AS tie, NULL::BIGINT AS pos"
    parts = [f"SELECT {k} AS section, {place}, {_literal('' if k == 0 else chr(10) * 2)} AS glue, {text} AS text" for k, text in fixed]
    item = "'o/r' AS k1, 'o/r' AS k2, number"
    parts.append(f"SELECT 2, {item}, NULL, NULL, NULL, NULL, chr(10), row FROM ({_INDEX})")
    parts.append(f"SELECT 6, {item}, p.part, NULL, NULL, NULL, chr(10) || chr(10), p.text FROM (SELECT number, unnest([{own}]) AS p FROM whole) WHERE p.text IS NOT NULL")
    parts.append(f"SELECT 6, {item}, g.part, seen, '', g.pos, chr(10) || chr(10), {facts} FROM (SELECT *, unnest([{shown}]) AS g FROM ranked) WHERE g IS NOT NULL")
    return f"""{_JUDGED}, said AS (SELECT l_orderkey AS number, ({ORDINAL})::BIGINT AS ordinal, CASE WHEN l_returnflag = 'R' THEN 'r[bot]' ELSE 'p' END AS author, l_returnflag = 'R' AS b, l_linestatus = 'F' AS m, l_shipdate AS seen, l_shipdate {_Q} AS n,
l_shipdate + INTERVAL 30 DAY {_Q} AS u FROM lineitem JOIN judged ON l_orderkey = judged.number WHERE included),
ranked AS (SELECT *, row_number() OVER (PARTITION BY number, b {by_time}) AS latest, row_number() OVER (PARTITION BY number, b, m {by_time}) AS own, row_number() OVER (PARTITION BY number, b, n OR u {by_time}) AS before FROM said),
more AS (SELECT number, count(*) FILTER (WHERE b AND (n OR u)) AS n_bot, count(*) FILTER (WHERE NOT b AND NOT (n OR u)) AS n_previous, count(*) FILTER (WHERE NOT b) AS n_latest_human, count(*) FILTER (WHERE NOT b AND m) AS n_latest_maintainer FROM said GROUP BY number),
whole AS (SELECT judged.*, o_custkey::VARCHAR AS author, o_orderdate AS created_at, coalesce(n_bot, 0) AS n_bot, coalesce(n_previous, 0) AS n_previous, coalesce(n_latest_human, 0) AS n_latest_human, coalesce(n_latest_maintainer, 0) AS n_latest_maintainer
FROM judged JOIN orders ON o_orderkey = judged.number LEFT JOIN more ON more.number = judged.number WHERE included) """ + " UNION ALL ".join(parts)


@query(_fragments_sql())
def evidence_fragments(spark, d):
    made = ingest.ingest(_as_received(spark, d), QUARTER, keeper(spark))
    rows = render.fragments(made, "o", QUARTER, QUARTER.utc_end)
    return rows.withColumn("at", F.col("at").cast("timestamp_ntz"))
