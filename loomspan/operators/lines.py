"""Documents as lines, and what follows from their order. Windows are partitioned by document."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def doc_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each line, numbered from 0."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _order(key: str) -> W:
    return W.partitionBy(key).orderBy("line_no")


def carried(lines: DataFrame, key: str, mark: Column, name: str) -> DataFrame:
    """The last marked line at or before each line."""
    return lines.withColumn(name, F.last(F.when(mark, F.col("line")), True).over(_order(key)))


def previous(lines: DataFrame, key: str, mark: Column, name: str) -> DataFrame:
    """The number of the last marked line before each line."""
    return lines.withColumn(name, F.last(F.when(mark, F.col("line_no")), True).over(_order(key).rowsBetween(W.unboundedPreceding, -1)))


def islands(lines: DataFrame, key: str, gap: Column) -> DataFrame:
    """Number of runs of lines between gaps in each document."""
    groups = lines.withColumn("_island", F.sum(gap.cast("int")).over(_order(key))).where(~gap)
    return groups.groupBy(key).agg(F.countDistinct("_island").alias("paragraphs"))


def visible(text: Column, tilde: bool = False) -> Column:
    """Whether each line is outside fences, as an array of booleans."""
    return F.transform(F.split(fence_scan(text, tilde)["seen"], ""), lambda c: c == "1")


#: What may begin or end a fence: its run and what follows on the line.
FENCE = {False: re.compile(r"^(`{3,})(.*)$", re.M), True: re.compile(r"^ {0,3}(`{3,}|~{3,})(.*)$", re.M)}
NAME = re.compile(r"[A-Za-z0-9_-]*\s*")


def fences(text: str, tilde: bool = False) -> tuple[str, str]:
    """(the run that is still open at the end, or empty; a digit for each line, 1 for those outside fences), in one pass over the lines that may be fences."""
    fence, done, line, at = "", [], 0, 0  # done: digits of the lines before `line`, which holds place `at`
    for m in FENCE[tilde].finditer(text):
        run, rest = m.groups()
        if fence:
            ends = not rest.strip(" \t") and run[0] == fence[0] and len(run) >= len(fence) if tilde else run == fence and not rest
        else:
            ends = tilde or bool(NAME.fullmatch(rest))
        if not ends:
            continue
        skipped = text.count("\n", at, m.start())
        done.append(("0" if fence else "1") * skipped + "0")
        line, at = line + skipped + 1, m.end()
        at += at < len(text)
        fence = "" if fence else run
    done.append(("0" if fence else "1") * (text.count("\n") + 1 - line))
    return fence, "".join(done)


def fence_scan(text: Column, tilde: bool = False) -> Column:
    """fence: the run that is still open at the end, or empty; seen: a digit for each line, 1 for those outside fences; both null for a null text.

    Plain dialect: a fence is a line of three or more backticks, perhaps with one word behind, and closes with the same run alone. With tilde: up to three spaces before it, backticks or
    tildes, closed by a run at least as long. Fences and the lines in them are hidden. The state runs from line to line, which a built-in fold
    would copy at every step; so this is Arrow-batched Python, linear in the text.
    """

    @F.pandas_udf("fence string, seen string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if t is None else fences(t, tilde) for t in texts], columns=["fence", "seen"])

    return scan(text)


def byte_page(rows: DataFrame, order: list[Column], size: Column, budget: int, block: Column, header: int = 0) -> DataFrame:
    """The longest run of first rows that fits a byte budget; sizes are not negative.

    block puts rows into runs that follow the order. Only the totals of blocks are in one global order; rows are ordered within the blocks that the budget reaches.
    """
    sized = rows.withColumns({"_block": block, "_size": size})
    earlier = F.sum("_total").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    totals = sized.groupBy("_block").agg(F.sum("_size").alias("_total"))
    reached = totals.select("_block", F.coalesce(earlier, F.lit(0)).alias("_before")).where(F.col("_before") + header <= budget)
    within = F.sum("_size").over(W.partitionBy("_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    out = sized.join(reached, "_block").withColumn("bytes", within + F.col("_before") + header)
    return out.where(F.col("bytes") <= budget).drop("_block", "_size", "_before")
