"""A training corpus from raw documents: quality rules, line dedup, near-duplicate groups, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is written as Parquet and read again as the
next one's docs; all but the last return the columns of documents, whatever else docs has. Rows that share an id count as one document's copies: exact repeats of a row pass the
first three stages together, then are mixed and packed each. An empty table passes through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import columns_but, cut, discard, scratch, table, word_count
from loomspan.llm.isolation_forest import keep_good
from loomspan.llm.jaccard_join import labelled_rows, row_key
from loomspan.llm.line_dedup import deduped
from loomspan.llm.mixing import mix
from loomspan.llm.packing import packed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the forest rejects go, null and empty texts among them; the others stay as they are, repeated rows alike."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """docs' columns from the struct `row`, in which no name can clash with a stage's own."""
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows leave the texts; a document that loses all its lines goes. n_chars follows the text.

    Null and short texts stay as they are; rows with null ids lose windows like others, the last of all; copies of a row stay alike.
    """
    out = deduped(docs).where("n_removed = 0 or n_removed < n_lines")
    own = {c: F.col("text") if c == "text" else F.col("own")[c] for c in docs.columns}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return out.select(*[value.alias(c) for c, value in own.items()])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.75 or more connect, that with the least id stays; where all ids are null, one row.

    Null texts and texts without words stay; all rows of the least id in a group stay, as they are one document's copies.
    """
    rows = cut(labelled_rows(docs))
    nameless = rows.where("component is null and root is not null")
    other = nameless.join(cut(nameless.groupBy("root").agg(F.min("r").alias("least"))), "root").where("r <> least")
    gone = rows.where("not doc_id <=> component").select("doc_id", "r").unionByName(other.select("doc_id", "r")).distinct()
    keyed = docs.select(F.struct(*columns_but(docs)).alias("row"), row_key().alias("key"))
    kept = keyed.join(cut(gone), (F.col("key") == F.col("r")) & F.col("row.doc_id").eqNullSafe(F.col("doc_id")), "left_anti")
    copies = F.col("row.doc_id").isNull() & (word_count(F.col("row.text")) > 0)
    one = kept.where(copies).groupBy("key").agg(F.min("row").alias("row"))
    return _unpacked(kept.where(~copies).select("row").unionByName(one.select("row")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it: none, one or two; rows without words are taken none, null sources are a source.

    Rows go by a hash of all their columns, so null and shared ids lose none; equal rows add up.
    """
    columns = [x for c in columns_but(docs) for x in (c, c.isNull())]  # the hash alone passes over nulls
    keyed = docs.select("doc_id", "text", "source", F.struct(*columns_but(docs)).alias("row"), F.xxhash64(*columns).alias("key_a"), F.xxhash64(F.lit(1), *columns).alias("key_b"))
    taken = mix(keyed, carry=("key_a", "key_b")).where("taken > 0").groupBy("key_a", "key_b").agg(F.expr("cast(sum(taken div size) as int)").alias("times"))
    once = keyed.select("row", "key_a", "key_b").dropDuplicates(["key_a", "key_b"])
    return _unpacked(once.join(taken, ["key_a", "key_b"]).select("row", F.explode(F.sequence(F.lit(1), F.col("times")))), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences; a null text is empty, repeated rows are packed each."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("jaccard_join", one_of_each_group), ("mixing", mix_sources), ("packing", pack_sequences)]

#: Token ids and the forest are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all documents. A stage's files go once the next one is written, the last ones when the driver's process ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before is not None:
            discard(before)
        before = folder
    return docs
