"""Every catalogue query against its SQL on DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

from loomspan.functions.text import utf8_cuts, utf8_pieces
from loomspan.plans import catalogue, records, service, texts  # noqa: F401
from loomspan.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    rel = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in rel.description]
    want = rel.fetchall()
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_chunks_join_to_the_text(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    parts: dict = {}
    for r in QUERIES["utf8_chunks"](spark, SF).collect():
        assert len(r.chunk.encode()) <= 1000
        parts.setdefault(r.doc_id, {})[r.chunk_no] = r.chunk
    assert {i: "".join(p[k] for k in sorted(p)) for i, p in parts.items()} == texts


def test_pieces_are_places_in_the_texts_own_buffer():
    own = ["aé中🚀" * 50, None, "", "x" * 8, "中" * 3, None]
    for texts in (pa.array(own), pa.array(["before", *own, "after"]).slice(1, len(own)), pa.array([], pa.string()), pa.array([None, None], pa.string()), pa.array(["", ""])):
        want = []
        for text in texts.to_pylist():
            data = (text or "").encode()
            ends = utf8_cuts(data, 8)
            want.append(None if text is None else [data[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)])
        assert utf8_pieces(texts, 8).to_pylist() == want
    texts = pa.array(["中" * 1000] * 2000)  # 6 MB of text in 48,000 pieces
    before = pa.total_allocated_bytes()
    made = utf8_pieces(texts, 128)
    assert len(made.values) == 48_000 and pa.total_allocated_bytes() - before < 1 << 20
