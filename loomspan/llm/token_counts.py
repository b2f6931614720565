"""Token counts of whole texts by the compiled transducers of fst_tokenizer.

One narrow pass: only the id and the text are read, nothing is shuffled. Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows and
ties give a row each; an empty table gives an empty one; other columns are neither read nor needed, so their names can't clash; the text is never cut off,
and a very long one runs in slices that begin where a pretoken surely begins.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fst_tokenizer
from .common import slices


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit (n_tokens > limit) of each row."""
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    names = [id_col, "n_bytes", "n_tokens", "over_limit"]

    def count(batches):
        tokenizer = fst_tokenizer.load(path)
        for batch in batches:
            for first, texts in slices(batch):
                n = tokenizer.counts(texts)
                sizes = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], names
                )

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType())]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return narrow.mapInArrow(count, T.StructType(fields))
