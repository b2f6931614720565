"""Text functions of evidence documents: expressions, but for the cuts of UTF-8 chunks, which depend on each other and so are Arrow-batched Python."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_no(flag: Column) -> Column:
    return F.when(flag, "yes").otherwise("no")


def list_text(items: Column) -> Column:
    return F.when(F.coalesce(F.size(items), F.lit(0)) < 1, "None").otherwise(F.array_join(items, ", "))


def cell(text: Column) -> Column:
    """Table cell: backslash and bar escaped, line feeds to spaces, Unicode blanks stripped, None if empty."""
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    out = F.regexp_replace(out, r"(?U)^\s+|\s+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", "None").otherwise(out)


def truncated(text: Column, most: int) -> Column:
    """The first `most` code points."""
    return F.substring(text, 1, most)


def longest_run(text: Column, pattern: str = "`+") -> Column:
    """Length of the longest match of a run pattern, 0 without one."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)), F.length)), F.lit(0))


def fenced(text: Column, most: int) -> Column:
    """Body in a fence longer than any run of backticks in it, cut to `most` code points first, item markers made harmless; a note follows a cut body."""
    text = F.coalesce(text, F.lit(""))
    body = F.replace(truncated(text, most), F.lit("<!-- ITEM_"), F.lit("&lt;!-- ITEM_"))
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(4), longest_run(body) + 1))
    shown = F.when(body == "", "(empty)").otherwise(body)
    note = F.when(F.length(text) > most, f"\n\n_[Truncated at {most:,} characters by the collector.]_").otherwise("")
    return F.concat(fence, F.lit("markdown\n"), shown, F.lit("\n"), fence, note)


def iso(ts: Column, missing: str = "Not provided") -> Column:
    """ISO 8601 in UTC, microseconds only when there are any. The session's time zone must be UTC."""
    micros = F.when(F.date_format(ts, "SSSSSS") == "000000", "").otherwise(F.date_format(ts, ".SSSSSS"))
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), micros, F.lit("+00:00")), F.lit(missing))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def after_first(text: Column, marker: str) -> Column:
    """What follows the marker's first occurrence; null without one."""
    at = F.locate(marker, text)
    return F.when(at > 0, F.substr(text, at + F.lit(len(marker))))


def utf8_cuts(data: bytes | memoryview, most: int) -> list[int]:
    """Ends of the greedy longest pieces of at most `most` bytes that split no code point, each found from the one before; nothing has one empty piece. most must be 4 at least."""
    ends, at = [], 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        ends.append(end)
        at = end
    return ends or [0]


def utf8_pieces(texts: pa.Array, most: int) -> pa.Array:
    """A list of pieces for each text, null for a null one. The pieces are places in the buffer that the texts came in: no text or piece is copied or made a Python string."""
    null = pc.is_null(texts).to_numpy(zero_copy_only=False)
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist() if len(texts) else [0]
    view = memoryview(data or b"")
    cuts, upto = [starts[0]], [0]
    for first, last, none in zip(starts, starts[1:], null, strict=False):
        if not none:
            cuts += [first + end for end in utf8_cuts(view[first:last], most)]
        upto.append(len(cuts) - 1)
    pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(np.array(cuts, np.int32)), data if data is not None else pa.py_buffer(b""))
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pieces, mask=pa.array(null))


def utf8_chunks(text: Column, most: int) -> Column:
    """Array of a text's pieces of at most `most` UTF-8 bytes; null for a null text. One walk over the cuts, linear in the text."""

    @F.arrow_udf("array<string>")
    def pieces(texts: pa.Array) -> pa.Array:
        return utf8_pieces(texts, most)

    return pieces(text)


def utf8_chunk(text: Column, most: int, number: int) -> Column:
    """One piece of a text alone (from 1; null beyond the last) and how many there are."""

    @F.pandas_udf("text string, chunks int")
    def piece(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            if text is None:
                rows.append((None, None))
                continue
            data = text.encode()
            ends = [0, *utf8_cuts(data, most)]
            rows.append((data[ends[number - 1] : ends[number]].decode() if number < len(ends) else None, len(ends) - 1))
        return pd.DataFrame(rows, columns=["text", "chunks"])

    return piece(text)
