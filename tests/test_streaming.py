"""The stream gives what the batch gives for all windows that have closed."""

from __future__ import annotations

import random
from dataclasses import replace

from pyspark.sql import functions as F

from loomspan.operators.ranking import keep_last
from loomspan.plans.service import service
from loomspan.sources.items import streamed_items
from loomspan.sources.recorded import record
from loomspan.streaming.activity import activity_windows
from loomspan.streaming.items import keep_last_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    twice = events.unionByName(events.limit(50))
    twice.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counts = activity_windows(stream, "ts", ["event_type"], ["event_id"])
    query = counts.writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    got = {tuple(r) for r in spark.table("counted").collect()}
    want = {tuple(r) for r in activity_windows(twice, "ts", ["event_type"], ["event_id"]).collect()}
    assert got and got <= want and {w for w in want if w[1] < max(x[1] for x in want)} <= got


def run(frame, folder, name):
    query = frame.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/{name}-state").outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(300) and query.exception() is None


def test_two_batches_give_what_one_gives(spark, tmp_path):
    """All events as items of a recorded service; the second run goes on from the first one's cursor. A day has more items than a search gives."""
    events = spark.read.parquet(f"{SF}/events.parquet").select((F.col("event_id") % 2 == 0).alias("even"), F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (event_id * 37) % 90000)"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), F.col("event_id").alias("number"))
    copies = events.select(F.when(F.col("even"), "issue").otherwise("pr").alias("kind"), "updated_at", F.explode(F.expr("sequence(number * 4, number * 4 + 3)")).alias("number"))
    found = copies.withColumn("raw", F.to_json(F.struct("number", "updated_at")))
    cut = "2024-01-01T09:00:00Z"
    folder = str(tmp_path / "recorded")
    items = lambda: streamed_items(spark, replace(service(folder), last_day="2024-12-31")).select("item_kind", "updated_at", F.get_json_object("raw", "$.number").cast("long").alias("number"))
    record(folder, found=found.where(F.col("updated_at") <= cut))
    run(items(), tmp_path, "steps")
    first = spark.read.parquet(str(tmp_path / "steps")).count()
    record(folder, found=found.where(F.col("updated_at") > cut))
    run(items(), tmp_path, "steps")
    run(items(), tmp_path, "whole")
    steps, whole = (sorted(map(tuple, spark.read.parquet(str(tmp_path / x)).collect())) for x in ("steps", "whole"))
    assert steps == whole and 0 < first < len(steps) == copies.count()
    assert copies.where("kind = 'pr' and updated_at < '2024-01-02'").count() > 1000


def test_last_copies_whatever_the_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rnd = random.Random(6)
        made = [("o/r" if rnd.random() < 0.5 else "o/s", rnd.randrange(12), k, rnd.choice([None, f"copy {k}"])) for k in range(200)]
        want = None
        for n in range(2):
            rnd.shuffle(made)
            rows = spark.createDataFrame(made, "repository string, number long, ordinal long, title string").withColumn("at", F.expr("timestamp'2024-01-01 00:00:00Z' + make_interval(0, 0, 0, 0, 0, 0, ordinal % 60)"))
            parts = [rows.where(F.pmod(F.xxhash64("ordinal", F.lit(n)), F.lit(3)) == k) for k in range(3)] + [spark.createDataFrame([("end", k, 10_000 + k, None) for k in range(2)], "repository string, number long, ordinal long, title string").withColumn("at", F.expr("timestamp'2024-01-03 00:00:00Z'"))]
            for k, part in enumerate(parts):
                part.coalesce(1).write.parquet(str(tmp_path / f"in{n}/{k}"))
            stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / f"in{n}"))
            run(keep_last_stream(stream, ["repository", "number"], "ordinal", "at"), tmp_path, f"last{n}")
            got = {tuple(r) for r in spark.read.parquet(str(tmp_path / f"last{n}")).where("repository <> 'end'").select("repository", "number", "ordinal", "title", "position").collect()}
            want = want or {tuple(r) for r in keep_last(rows.drop("at"), ["repository", "number"], "ordinal").select("repository", "number", "ordinal", "title", "position").collect()}
            assert got == want and len(got) > 20
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
