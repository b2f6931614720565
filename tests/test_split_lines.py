"""Large documents read in splits against whole ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import lines as whole
from loomspan.operators import reader
from loomspan.sources import split_lines as splits
from loomspan.sources.evidence import read_texts

PIECES = ["```", "````", "`````", "```py", "``` ", "```a b", "~~~", "~~~~", "   ```", "    ```", " ~~~\t", "x", "", "text ```", "``", "```\u2028", "a\u2028b\x85", "a\rb", "x\r"]


def states(tilde: bool) -> list[str]:
    return ["", *[c * n for c in ("`~" if tilde else "`") for n in range(3, 9)]]


def test_maps_equal_runs_from_every_state():
    rng = random.Random(3)
    for _ in range(3000):
        own = rng.choices(PIECES[:15], k=rng.randrange(12))
        for tilde in (False, True):
            events = [e for e in (splits.event(x, tilde) for x in own) if e is not None]
            idle, exits = splits.split_map(events, tilde)
            exits = [dict(zip(("mark", "least", "most", "exit"), x, strict=True)) for x in exits]
            for state in states(tilde):
                want = state
                for run, opens, ends in events:
                    want = ("" if ends and splits.closes(run, want, tilde) else want) if want else run if opens else ""
                assert splits.after(state, idle, exits) == want, (own, tilde, state)


@pytest.mark.parametrize("split", ["64b", "700b", "128m"])
def test_lines_equal_those_of_whole_texts(spark, tmp_path, split):
    rng = random.Random(4)
    for k in range(12):
        text = "\n".join(rng.choices(PIECES, k=rng.choice([1, 3, 60, 200]))) + rng.choice(["", "\n", "\r", "\r\n"])
        (tmp_path / f"d{k}.md").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for tilde in (False, True):
            # Two runs of the scan of whole texts, one for each dialect; an open fence is no error here.
            docs = read_texts(spark, tmp_path)
            text = F.regexp_replace("text", f"({reader.RARE_END})", "$1\n")
            want = docs.select("doc_id", text.alias("text")).withColumn("seen", whole.visible(F.col("text"), tilde)).select("doc_id", F.posexplode(F.arrays_zip(F.split("text", "\n").alias("line"), "seen")).alias("n", "x")).select("doc_id", "n", "x.line", "x.seen")
            got = splits.split_lines(spark, str(tmp_path), tilde=tilde, strict=False)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_open_fence_is_an_error(spark, tmp_path):
    (tmp_path / "a.md").write_text("x\n```\n````\n")
    with pytest.raises(Exception, match="unterminated fence"):
        splits.split_lines(spark, str(tmp_path)).collect()


def test_many_splits_need_no_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splits, "MOST_BROADCAST", 0)
    spark.range(3000).select(F.concat(F.lit("```\n"), F.col("id").cast("string"), F.lit("\n```\nplain"))).repartition(7).write.text(str(tmp_path / "doc"))
    rows = splits.split_lines(spark, str(tmp_path / "doc"), parts=True).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(12_001)) and rows[-1].line == ""
    assert all(r.visible == (k % 4 == 3) for k, r in enumerate(rows[:-1]))
