"""Corpus pipeline: quality filter, exact dedup, near dedup, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all
but the last return the columns of ``documents``. Rows that repeat an id and its text
leave the exact-dedup stage once; the mix repeats a document's row as often as it takes it.
Rows without an id pass through every stage as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymend.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from waymend.llm.common import staged
from waymend.llm.queries import TOKENIZERS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = quality.train(docs, labels)
    return quality.score(docs.select(*COLUMNS), weights).where("score >= 0.5").select(*COLUMNS)


def row_key(*columns: str) -> Column:
    """64 bits of the values of a row, nulls told apart from all else."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one with the smallest id.

    A document without an id is a member like any other and stays if it is the longest of its
    group, or if no other is as long.
    """
    def key(digest):  # digests are of one length, so no id runs into one
        return F.concat(digest, F.coalesce(F.concat(F.lit(":"), F.col("doc_id").cast("string")), F.lit("")))

    kept = exact_dedup.exact_dedup(docs).where("kept").select(key(F.col("text_sha256")).alias("row")).distinct()
    own = key(F.sha2(exact_dedup.normalised(F.col("text")), 256))
    found = docs.select(*COLUMNS, own.alias("row")).join(kept, "row", "left_semi")
    # Rows that repeat the winner's id may be shorter than it.
    length = F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("length")
    return found.groupBy("row").agg(F.max(F.struct(length, *COLUMNS)).alias("best")).select("best.*").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that the join links.

    Texts are linked from a Jaccard similarity of 0.8 of their five-word shingles on. Documents
    without an id are linked like others; one of them stays where a group has no id at all (which
    one, a hash of the text decides). Each pair of id and text is a node of its own; rows that
    repeat both stay or go together.
    """
    rows = docs.select(*COLUMNS, row_key("doc_id", "text").alias("row"))
    linked = jaccard_join.jaccard_join(rows, id_col="row", width=5, similarity=(4, 5)).select("row", "component_id").distinct()
    named = linked.join(rows.select("row", "doc_id").distinct(), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    stays = named.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return rows.join(stays, "row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (rows of one id alike).

    Documents without an id are drawn one by one: a hash of the row stands in for the id.
    """
    rows = docs.select(*COLUMNS, F.coalesce("doc_id", row_key("text", "lang", "source")).alias("row"))
    times = mixing.mix(rows, id_col="row").groupBy("row").agg(F.max("times").cast("int").alias("times")).where("times > 0")
    repeated = rows.join(times, "row").withColumn("times", F.explode(F.sequence(F.lit(1), "times")))
    return repeated.select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of the ids and of the text decoded from them."""
    return bpe.encode_and_decode(docs.select(*COLUMNS), f"{TOKENIZERS}/byte_bpe_50k.json", with_ids=True).select(
        "doc_id", "lang", "source", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: No SQL: trained weights, a seeded subset sum and a tokenizer are part of the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
