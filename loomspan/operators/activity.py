"""Inclusion, rejects and counts of items by their activities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def included(items: DataFrame, active: DataFrame, item_key: str, active_key: str, own: Column, negate: bool = False) -> DataFrame:
    """Items with an event of their own or an active child; with negate, the others.

    Children are aggregated by key before the join, so an item with very many of them is one row.
    """
    children = active.groupBy(F.col(active_key).alias("_key")).agg(F.lit(True).alias("_any"))
    joined = items.join(children, items[item_key] == F.col("_key"), "left")
    keep = own | F.coalesce("_any", F.lit(False))
    return joined.where(~keep if negate else keep).drop("_key", "_any")


def counts(active: DataFrame, keys: list[str], in_period: Column, updated: Column, bot: Column, maintainer: Column) -> DataFrame:
    """New, updated-existing, human, bot and maintainer activity of each key in one aggregation."""
    any_ = in_period | updated
    return active.groupBy(*keys).agg(
        F.count_if(in_period).alias("new_count"),
        F.count_if(updated & ~in_period).alias("updated_count"),
        F.count_if(any_ & ~bot).alias("human_count"),
        F.count_if(any_ & bot).alias("bot_count"),
        F.count_if(any_ & maintainer & ~bot).alias("maintainer_count"),
    )


def reasons(rejects: DataFrame, failed: Column, unexplained: Column) -> DataFrame:
    """How many rejects for each reason; the first that holds counts."""
    reason = F.when(failed, "failed_child").when(unexplained, "unexplained_update").otherwise("out_of_period")
    return rejects.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
