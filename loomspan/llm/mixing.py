"""Mixing sources to target weights by min-cost flow.

Documents belong to one or more sources. They are aggregated by membership pattern; a pattern's words may pass into the mix once at no cost and again, up to
`max_repeats` times, at a rising cost (convex in the number of repeats). The flow routes the patterns' words to the sources' quotas at the least cost. As
only the arcs into patterns cost anything, each level of repetition is filled to its maximum flow before the next one is opened: that is successive
shortest paths. The flow says how many of a pattern's words pass at each level; laid out in seeded order of documents, they are cut there. A document of several
sources passes for its pattern; which of them its words count for is the flow's matter alone.

The order is by MD5 of seed and id, so that reruns agree and any SQL engine can repeat it. Sums over buckets of the order come before sums within the bucket
where a cut falls, so a source may hold a third of all rows. The cut falls at the document boundary nearest below, and one more document, the largest that
still fits, fills the gap. Sources that no chain of patterns links don't share words, so each connected component of sources has a flow of its own, worked out in a task;
a source that no document shares is a component of one pattern. There may be any number of components; one of more than `max_patterns` patterns is an error.

Defined results: sizes count words; a null or empty text has size 0 and is taken 0 words; a null source is a source of its own, the last; equal texts or
equal rows are taken each by its own (rows that share an id are taken alike or, at a cut, in any order); an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from fractions import Fraction
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, word_count
from .components import components

#: Rows that a bucket of the order is to hold at most.
BUCKET_ROWS = 100_000


def water_fill(sizes: Sequence[int], weights: Sequence[int], share: Fraction, most: int) -> list[float]:
    """Targets in proportion to weights that add up to share * sum(sizes), none above most * its size; the excess is shared again by weight."""
    open_, budget = {i for i, s in enumerate(sizes) if s > 0}, share * sum(sizes)
    full: set[int] = set()
    while True:
        rest, weight = budget - most * sum(sizes[i] for i in full), sum(weights[i] for i in open_ - full)
        over = {i for i in open_ - full if rest * weights[i] > most * sizes[i] * weight}
        if not over:
            break
        full |= over
    return [0.0 if i not in open_ else float(most * sizes[i]) if i in full else float(rest * weights[i] / weight) for i in range(len(sizes))]


def route(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], levels: int) -> list[list[dict[int, int]]]:
    """Least-cost flow: for each pattern and level the words that go to each source."""
    flow: list[list[dict[int, int]]] = [[{} for _ in range(levels)] for _ in capacity]
    total: list[dict[int, int]] = [{} for _ in capacity]  # of all levels so far: residual arcs
    room = list(quota)
    owners: list[list[int]] = [[] for _ in quota]
    for p, sources in enumerate(members):
        for s in sources:
            owners[s].append(p)
    for level in range(levels):
        before = [dict(x) for x in total]
        left = list(capacity)
        for p in range(len(capacity)):
            while left[p]:
                # Breadth-first over residual arcs: pattern -> source (unbounded), source -> pattern (what it has had).
                came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None}
                queue = deque([("p", p)])
                end = None
                while queue and end is None:
                    kind, i = queue.popleft()
                    steps = [("s", s) for s in members[i]] if kind == "p" else [("p", q) for q in owners[i] if total[q].get(i, 0) > 0]
                    for x in steps:
                        if x not in came:
                            came[x] = (kind, i)
                            if x[0] == "s" and room[x[1]]:
                                end = x
                                break
                            queue.append(x)
                if end is None:
                    break
                path = [end]
                while (back := came[path[-1]]) is not None:
                    path.append(back)
                path.reverse()
                amount = min([left[p], room[end[1]], *(total[b[1]][a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s")])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        total[a[1]][b[1]] = total[a[1]].get(b[1], 0) + amount
                    else:
                        total[b[1]][a[1]] -= amount
                left[p] -= amount
                room[end[1]] -= amount
        for p, now in enumerate(total):
            flow[p][level] = {s: now.get(s, 0) - before[p].get(s, 0) for s in {*now, *before[p]} if now.get(s, 0) != before[p].get(s, 0)}
    # A rerouting may shift words between a pattern's sources on an earlier level: levels keep their sums, sources share them in order.
    out: list[list[dict[int, int]]] = []
    for p, now in enumerate(total):
        stock = [[s, n] for s, n in sorted(now.items()) if n]
        own = []
        for level in range(levels):
            need, part = sum(flow[p][level].values()), {}
            while need and stock:
                n = min(need, stock[0][1])
                part[stock[0][0]] = part.get(stock[0][0], 0) + n
                need -= n
                stock[0][1] -= n
                if not stock[0][1]:
                    stock.pop(0)
            own.append(part)
        out.append(own)
    return out


def seeded(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: Fraction = Fraction(3, 2), max_repeats: int = 2, seed: int = 1, members: str | None = None, max_patterns: int = 20_000, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, sources (its pattern), taken of each row, and source_size and target of its first source.

    members names a column with an array of sources; without it each document is in its `source` alone. Sources in code-point order, null last, get the weights in turn.
    carry names columns that are handed through; they also break ties of the order.
    """
    pattern = F.array_sort(F.array_distinct(F.transform(F.col(members), lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit("~"))))) if members else F.array(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")))
    rows = docs.select("doc_id", word_count(F.col("text")).alias("size"), pattern.alias("_pattern"), *carry).withColumn("_order", seeded("doc_id", seed))
    rows = cut(rows)
    totals = cut(rows.groupBy("_pattern").agg(F.sum("size").alias("n")))
    sources = totals.select("n", F.explode("_pattern").alias("s")).groupBy("s").agg(F.sum("n").alias("n"))
    targets = cut(_targets(sources, weights, share, max_repeats))
    return _select(rows, _plan(totals, targets, max_repeats, max_patterns), carry)


def _targets(sources: DataFrame, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """s, n, target of each source: water_fill, however many there are.

    Each round is one pair of sums, so that the driver holds no list of sources. Places in code-point order come from counts of sorted runs.
    """
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = cut(sources.repartitionByRange(parts, "s").withColumn("_run", F.spark_partition_id()))
    counts = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    firsts = counts.select("_run", (F.sum("_n").over(W.orderBy("_run")) - F.col("_n")).alias("_first"))  # at most as many rows as parts
    place = F.col("_first") + F.row_number().over(W.partitionBy("_run").orderBy("s")) - 1
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    known = cut(runs.join(F.broadcast(firsts), "_run").select("s", "n", turn.alias("w")))
    total, weight = known.where("n > 0").agg(F.sum("n"), F.sum("w")).first()
    exact = lambda k: f"cast('{k}' as decimal(38,0))"
    full_n, full_w = 0, 0
    while True:
        rest, open_w = share.numerator * (total or 0) - most * share.denominator * full_n, (weight or 0) - full_w
        # The rest by weight would be more than most * n. Those that are full stay so, as what the others get only rises.
        full = F.lit(True) if not open_w else F.expr(f"{exact(rest)} * w > {exact(most * share.denominator * open_w)} * n")
        n, w = known.where("n > 0 and w > 0").where(full).agg(F.sum("n"), F.sum("w")).first()
        if (n or 0, w or 0) == (full_n, full_w):
            break
        full_n, full_w = n or 0, w or 0
    by_weight = F.lit(0.0) if not open_w else F.expr(f"cast({exact(rest)} * w as double) / cast({exact(share.denominator * open_w)} as double)")
    target = F.when((F.col("n") == 0) | (F.col("w") == 0), F.lit(0.0)).when(full, (F.col("n") * most).cast("double")).otherwise(by_weight)
    return known.select("s", "n", target.alias("target"))


def _plan(totals: DataFrame, targets: DataFrame, levels: int, max_patterns: int) -> DataFrame:
    """For each pattern its words, how many of them pass at each level by its component's flow, and its first source's size and target; zeros for a pattern without sources."""
    parts = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = totals.select("_pattern", F.explode("_pattern").alias("s")).join(targets, "s")
    known = each.groupBy("_pattern").agg(F.array_sort(F.collect_list(F.struct("s", "n", "target"))).alias("of"))
    # Neighbours in a pattern are linked, so all its sources are.
    shared = totals.where(F.size("_pattern") > 1)
    pairs = F.arrays_zip(F.slice("_pattern", 1, F.size("_pattern") - 1).alias("a"), F.slice("_pattern", 2, F.size("_pattern") - 1).alias("b"))
    first = F.xxhash64(F.get("_pattern", F.lit(0)))
    rows = totals.join(known, "_pattern").withColumn("v", first)
    if not shared.isEmpty():
        linked = components(shared.select(F.explode(pairs).alias("p")).select(F.xxhash64("p.a").alias("u"), F.xxhash64("p.b").alias("v")))
        rows = rows.join(linked, "v", "left")
    else:
        rows = rows.withColumn("component", F.lit(None).cast("long"))
    rows = rows.select(F.coalesce("component", "v").alias("component"), "_pattern", "n", "of").repartition(parts, "component").sortWithinPartitions("component", "_pattern")

    def flow(patterns: list) -> pd.DataFrame:
        names = sorted({(x["s"], x["target"]) for p in patterns for x in p.of})
        at = {s: i for i, (s, _) in enumerate(names)}
        routed = route([p.n for p in patterns], [[at[x["s"]] for x in p.of] for p in patterns], [int(t) for _, t in names], levels)
        return pd.DataFrame([(p._pattern, p.n, [sum(x.values()) for x in own], p.of[0]["n"], p.of[0]["target"]) for p, own in zip(patterns, routed, strict=True)], columns=columns)

    def flows(batches):
        held: list = []
        for batch in batches:
            done = []
            for p in batch.rename(columns={"_pattern": "pattern"}).itertuples(index=False):
                p = SimpleNamespace(component=p.component, _pattern=list(p.pattern), n=int(p.n), of=list(p.of))
                if held and held[0].component != p.component:
                    done.append(flow(held))
                    held = []
                held.append(p)
                if len(held) > max_patterns:
                    raise ValueError(f"more than {max_patterns} membership patterns that overlap")
            if done:
                yield pd.concat(done)
        if held:
            yield flow(held)

    columns = ["_pattern", "_total", "_levels", "source_size", "target"]
    plan = rows.mapInPandas(flows, "_pattern array<string>, _total long, _levels array<long>, source_size long, target double")
    none = totals.where(F.size("_pattern") == 0).select("_pattern", F.col("n").alias("_total"), F.array_repeat(F.lit(0).cast("long"), levels).alias("_levels"), F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"))
    return cut(plan.unionByName(none))


def _select(rows: DataFrame, plan: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Levels that pass a whole pattern repeat all its documents; the words of the last, partial level are met by documents in seeded order, and one to fill the gap.

    What holds for a pattern is joined to its buckets, and these to the rows, so that neither many patterns nor one of very many rows land in one task.
    """
    digits, n = 3, rows.count()
    while n > BUCKET_ROWS * 16**digits:
        digits += 1
    whole = F.size(F.filter("_levels", lambda n: (n >= F.col("_total")) & (n > 0)))
    rest = F.coalesce(F.array_max(F.filter("_levels", lambda n: (n > 0) & (n < F.col("_total")))), F.lit(0))
    plan = plan.select("_pattern", whole.alias("_whole"), rest.alias("_rest"), "source_size", "target")
    key, pattern = ["_pattern", "_bucket"], W.partitionBy("_pattern")  # at most 16^digits buckets of a pattern
    rows = rows.withColumn("_bucket", F.substring("_order", 1, digits))
    sums = rows.groupBy(*key).agg(F.sum("size").alias("_sum"))
    before = sums.select(*key, (F.sum("_sum").over(pattern.orderBy("_bucket")) - F.col("_sum")).alias("_before")).join(plan, "_pattern")
    placed = rows.withColumn("_inner", F.sum("size").over(W.partitionBy(*key).orderBy("_order", "doc_id", "size", *carry).rowsBetween(W.unboundedPreceding, 0))).join(before, key)
    placed = placed.withColumn("_sum", F.col("_before") + F.col("_inner"))
    # The gap that the seeded prefix leaves, and the largest of the other documents that fits it (ties: first in order).
    reach = placed.groupBy(*key).agg(F.max("_rest").alias("_rest"), F.max(F.when(F.col("_sum") <= F.col("_rest"), F.col("_sum")).otherwise(0)).alias("_reach"))
    fill = reach.select(*key, (F.max("_rest").over(pattern) - F.max("_reach").over(pattern)).alias("_gap"))
    largest = F.struct(F.col("size"), (-F.col("_sum")).alias("at"))
    best = placed.join(fill, key).where("_sum > _rest and size > 0 and size <= _gap").groupBy("_pattern").agg(F.max(largest).alias("_best"))
    out = placed.join(sums.select(*key).join(best, "_pattern"), key, "left")
    once = (F.col("_sum") <= F.col("_rest")) | F.coalesce((F.col("size") == F.col("_best.size")) & (-F.col("_sum") == F.col("_best.at")), F.lit(False))
    taken = F.col("size") * (F.col("_whole") + F.when(once, 1).otherwise(0))
    names = F.transform("_pattern", lambda s: F.when(s != "~", F.substr(s, F.lit(2))))
    return out.select("doc_id", "size", names.alias("sources"), "source_size", "target", taken.cast("long").alias("taken"), *carry)
