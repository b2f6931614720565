"""The fence scan against a plain state machine, its cost on long documents, and the rarer line ends."""

from __future__ import annotations

import random
import re
import time

from loomspan.operators import reader
from loomspan.operators.lines import fence_scan, fences

PIECES = ["```", "````", "```py", "``` ", "```a b", "~~~", "~~~~", "   ```", "    ```", " ~~~\t", "x", "", "text ```", "``", "```\u2028"]


def plain(text: str, tilde: bool) -> tuple[str, str]:
    """Line by line, as the docstring of the scan says it."""
    open_, seen = "", ""
    for line in text.split("\n"):
        run = re.match(r" {0,3}(`{3,}|~{3,})" if tilde else r"(`{3,})[A-Za-z0-9_-]*\s*\Z", line)
        alone = re.match(r" {0,3}(`{3,}|~{3,})[ \t]*\Z" if tilde else r"(`{3,})\Z", line)
        seen += "0" if open_ or run else "1"
        if not open_:
            open_ = run[1] if run else ""
        elif alone and (alone[1][0] == open_[0] and len(alone[1]) >= len(open_) if tilde else alone[1] == open_):
            open_ = ""
    return open_, seen


def test_fences_equal_a_plain_machine():
    rng = random.Random(1)
    for _ in range(4000):
        text = "\n".join(rng.choices(PIECES, k=rng.randrange(12)))
        for tilde in (False, True):
            assert fences(text, tilde) == plain(text, tilde), (text, tilde)


def test_scan_of_nulls_and_long_documents(spark):
    long = "```\nx\n```\ny\n" * 100_000
    began = time.perf_counter()
    rows = spark.createDataFrame([(0, None), (1, ""), (2, long)], "k int, text string").select("k", fence_scan("text").alias("s")).collect()
    got = {r.k: r.s for r in rows}
    assert time.perf_counter() - began < 60
    assert got[0].seen is None and tuple(got[1]) == ("", "1") and tuple(got[2]) == ("", "0001" * 100_000 + "1")


def test_rare_line_ends_stay_in_their_lines(spark):
    text = "a\u2028\nb\x85c\r\n## d\u2028\r```\u2028```\n"
    rows = reader.evidence_lines(spark.createDataFrame([("d", text)], "doc_id string, text string")).withColumn("ended", reader.ended()).orderBy("line_no").collect()
    assert "".join(r.ended for r in rows) == re.sub("\r\n?", "\n", text) + "\n"
    assert [r.line for r in rows] == ["a\u2028", "", "b\x85", "c", "## d\u2028", "", "```\u2028", "```", ""]
    assert [r.visible for r in rows] == [True] * 6 + [False] * 2 + [True]
