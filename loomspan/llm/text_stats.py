"""Rule statistics of whole texts: what quality rules and the quality model see."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices
from .shingles import WIDTH, _ODD, mixed

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b"!?.,;:-_=~^/\\\"'()[]{}@+`"

#: Columns of `stats_of`, all counts.
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_distinct", "longest"]


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of five that the text holds twice or more, the first time included."""
    n = len(words) - WIDTH + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    key = h[:n] * _ODD[0]
    for i in range(1, WIDTH):
        key += h[i : i + n] * _ODD[i]
    key = mixed(key)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[WIDTH : WIDTH + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge)))


def stats_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    data = text.encode()
    words = data.split()
    without = lambda chars: len(data) - len(data.translate(None, chars))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words), len(text) - without(_SPACE), without(_SYMBOLS), len(lines) - len(set(lines)), repeat_words(words), len(lines), without(_UPPER), without(_LOWER), without(_DIGITS), without(_MARKS),
        len(set(words)), max(map(len, words), default=0),
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of each row; a null text counts as empty."""

    def compute(batches):
        for batch in batches:
            for first, texts in slices(batch):
                columns = zip(*map(stats_of, texts), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *STATS])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, T.LongType()) for n in STATS)]
    return docs.select("doc_id", "text").mapInArrow(compute, T.StructType(fields))


def ratios(stats: np.ndarray) -> np.ndarray:
    """Features of rows of STATS, free of a text's length but for the first."""
    s = {n: stats[:, i].astype(float) for i, n in enumerate(STATS)}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.column_stack([
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words, np.log1p(words / lines), s["n_upper"] / chars,
        s["n_lower"] / chars, s["n_digits"] / chars, s["n_marks"] / words, np.log1p(s["n_distinct"]) / np.log1p(words), np.log1p(s["longest"]),
    ])


FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "line_length", "upper", "lower", "digits", "marks", "distinct", "longest"]
