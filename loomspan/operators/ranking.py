"""Ranked rows for each key. Every order must be total, as Spark's rows have none of their own and ties are settled by the first row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Spark turns the limit of 1 into a filter below the shuffle (WindowGroupLimit)."""
    return ranked(df, keys, order, "_rank").where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The last duplicate's values at the first one's position."""
    place = F.min(ordinal).over(W.partitionBy(*keys))
    return first_of(df.withColumn("position", place), keys, [F.desc(ordinal)])


def latest(df: DataFrame, keys: list[str], at: str, ties: list[str]) -> DataFrame:
    """Greatest time, null as the least; the first of equals."""
    return first_of(df, keys, [F.desc_nulls_last(at), *map(F.asc, ties)])


def previous_context(df: DataFrame, keys: list[str], at: str, ties: list[str], most: int = 3) -> DataFrame:
    """The newest `most` rows with their rank; show them by rank descending."""
    return ranked(df, keys, [F.desc_nulls_last(at), *map(F.asc, ties)]).where(F.col("rank") <= most)


def current_review(df: DataFrame, keys: list[str], state: str, at: str, ties: list[str], decisive: list[str]) -> DataFrame:
    """Latest decisive state of each key, else the latest of any."""
    return first_of(df, keys, [F.desc(F.coalesce(F.upper(state).isin(decisive), F.lit(False))), F.desc_nulls_last(at), *map(F.asc, ties)])
