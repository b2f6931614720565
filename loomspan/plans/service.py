"""Scans of a recorded service, whose answers are made of the tables, each with SQL for the same rows.

Orders are the items of a search: even keys issues, odd ones pull requests, touched 60 days after their date. Suppliers are items with child lists: the line items they supply, by returnflag comments, reviews
and review comments; nations divisible by three have issues, those divisible by five no comments; the reviews of every seventh supplier fail at their second page.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.plans.registry import query, table
from loomspan.sources.items import child_lists, found_items
from loomspan.sources.recorded import BUCKETS, TRANSPORT, bucket_of, item_name, record
from loomspan.sources.rest import Service
from loomspan.storage import scratch

FIRST, LAST, SINCE = "1997-02-11", "1997-04-03", "1995-06-01T00:00:00Z"
TOUCHED = "date_format(o_orderdate + interval 60 days + make_dt_interval(0, 0, 0, cast(o_orderkey % 86400 as decimal(18,6))), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def service(folder: str, **more) -> Service:
    return Service(folder, "o", "NO_TOKEN", SINCE, "1992-01-01", "1999-12-31", rate=1e6, workers=8, transport=TRANSPORT, **more)


def recorded_orders(spark, d) -> str:
    folder = scratch(spark, "recorded")
    rows = table(spark, d, "orders").select(F.expr("if(o_orderkey % 2 = 0, 'issue', 'pr')").alias("kind"), F.expr(TOUCHED).alias("updated_at"), F.col("o_orderkey").alias("number"))
    record(folder, found=rows.withColumn("raw", F.to_json(F.struct("number", "updated_at"))))
    return folder


@query(f"""SELECT 'pull_request' AS item_kind, o_orderkey AS number, ordinal::BIGINT AS ordinal, (ordinal // 100 + 1)::INT AS page FROM
(SELECT o_orderkey, row_number() OVER (ORDER BY seen DESC, o_orderkey DESC) - 1 AS ordinal FROM (SELECT o_orderkey, o_orderdate + INTERVAL 60 DAY + to_seconds(o_orderkey % 86400) AS seen FROM orders WHERE o_orderkey % 2 = 1)
WHERE seen >= TIMESTAMP '{FIRST} 00:00:00' AND seen < TIMESTAMP '{LAST} 00:00:00' + INTERVAL 1 DAY) WHERE ordinal < 1000""")
def searched_pulls(spark, d):
    rows = found_items(spark, service(recorded_orders(spark, d)))
    rows = rows.where(f"item_kind = 'pull_request' and updated_at >= timestamp '{FIRST} 00:00:00Z' and updated_at <= timestamp '{LAST} 23:59:59.999999Z'")
    return rows.select("item_kind", F.get_json_object("raw", "$.number").cast("long").alias("number"), "ordinal", "page")


def recorded_suppliers(spark, d) -> tuple[str, str]:
    """(recording, items)"""
    folder = scratch(spark, "recorded")
    pull = F.col("s_nationkey") % 3 != 0
    suppliers = table(spark, d, "supplier")
    items = suppliers.select(F.when(pull, "pull_request").otherwise("issue").alias("item_kind"), F.lit("o/r").alias("repository"), F.col("s_suppkey").alias("number"), F.expr("if(s_nationkey % 5 = 0, 0L, null)").alias("comments"), F.lit(None).cast("long").alias("review_comments"))
    # As many files as buckets, each in the order in which the recording has its lists: so many tasks ask, each for lists that lie together.
    item = item_name(F.lit("o"), F.lit("r"), F.col("number").cast("string"))
    items.withColumn("item", item).repartitionById(BUCKETS, bucket_of(F.col("item"))).sortWithinPartitions("item").drop("item").write.parquet(f"{folder}/items")
    path = F.concat(F.lit("/repos/o/r/"), F.expr("if(l_returnflag = 'A', 'issues/', 'pulls/')"), F.col("l_suppkey").cast("string"), F.expr("if(l_returnflag = 'N', '/reviews', '/comments')"))
    lines = table(spark, d, "lineitem").select(
        path.alias("path"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordinal"),
        F.expr("date_format(l_shipdate + interval 30 days, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").alias("updated_at"),
        F.to_json(F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"))).alias("raw"),
        F.expr("if(l_returnflag = 'N' and l_suppkey % 7 = 0, 2, null)").alias("fails_at"),
    )
    record(folder, lists=lines)
    return folder, f"{folder}/items"


@query(f"""WITH s AS (SELECT s_suppkey AS number, CASE WHEN s_nationkey % 3 <> 0 THEN 'pull_request' ELSE 'issue' END AS item_kind, s_nationkey % 5 = 0 AS silent FROM supplier),
c AS (SELECT number, item_kind, silent, CASE l_returnflag WHEN 'A' THEN 'comment' WHEN 'N' THEN 'review' ELSE 'review_comment' END AS kind, l_orderkey FROM s JOIN lineitem ON l_suppkey = number
WHERE l_returnflag = 'N' OR l_shipdate + INTERVAL 30 DAY >= TIMESTAMP '{SINCE[:10]} 00:00:00'),
g AS (SELECT item_kind, number, kind, count(*) AS n, sum(l_orderkey)::BIGINT AS orders FROM c WHERE NOT (kind = 'comment' AND silent) AND (kind = 'comment' OR item_kind = 'pull_request') GROUP BY ALL)
SELECT item_kind, number, kind, CASE WHEN lost THEN 0 ELSE n END AS n, CASE WHEN lost THEN NULL ELSE orders END AS orders, CASE WHEN lost THEN 'GitHub API returned 404: gone' END AS error FROM (SELECT *, kind = 'review' AND number % 7 = 0 AND n > 100 AS lost FROM g)""")
def listed_children(spark, d):
    folder, items = recorded_suppliers(spark, d)
    rows = child_lists(spark, service(folder), items)
    of = F.get_json_object("raw", "$.order").cast("long")
    return rows.groupBy("item_kind", "number", "kind").agg(F.count("raw").alias("n"), F.sum(of).alias("orders"), F.max("error").alias("error"))
