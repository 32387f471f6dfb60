"""Registered queries of this subpackage, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymend.llm import (
    bpe, byte_dedup, collocations, exact_dedup, jaccard_join, language, mixing, quality, spelling, substring_dedup, topk_search,
    url_filter, warc,
)
from waymend.llm.common import fold_remainder

#: The contract's rules, and where the public vocabulary files lie.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(x):
    """floor(1024 * x) of a finite component, as a double; large ones are whole already."""
    scaled = F.lit(1024.0) * x.cast("double")
    return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)


def op1_topk_search(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", whole).alias("vector"))
    return topk_search.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op2_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").where("quality is not null").select(
        "doc_id", F.when(F.col("quality") == 0, "block").otherwise("allow").alias("label")
    )
    # A page's address ends in the id of the document that it shows.
    shown = F.regexp_extract(url_filter.split_url(F.col("url"))[1], r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    ids = pages.select("page_id", F.when(shown != "", shown).cast("long").alias("doc_id"))
    known = ids.join(labels, "doc_id").select("page_id", "label")
    return url_filter.filter_urls(pages, URL_RULES, known)


def op3_source_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


def op4_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, f"{TOKENIZERS}/byte_bpe_50k.json").drop("text")


def op5_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold_remainder(F.col("doc_id"), 3) == 1
    labels = table(spark, folder, "labels").where(~held_out)
    weights = quality.train(docs.where(~held_out), labels)
    return quality.score(docs, weights, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_ngram_jaccard(spark, folder):
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


def op7_exact_dedup(spark, folder):
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op8_substring_dedup(spark, folder):
    return substring_dedup.substring_dedup(table(spark, folder, "documents")).drop("removed")


def captures(spark, folder):
    """Captures made of the pages: each page is a full response; later on two revisits of its
    address follow, of which every fourth page's second one names another entity tag."""
    pages = table(spark, folder, "pages").select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("tag"))
    kinds = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("step")
    steps = pages.select("page_id", "url", "tag", kinds)
    late = (F.col("step") == 2) & (F.col("page_id") % 4 == 0)
    return steps.select(
        (F.col("page_id") * 3 + F.col("step")).alias("record_id"), "url", (F.col("page_id") * 10 + F.col("step") * 35).alias("at"),
        F.when(F.col("step") == 0, "response").otherwise("revisit").alias("kind"),
        F.when(late, F.reverse("tag")).when(F.col("step") == 1, F.concat(F.lit("W/"), "tag")).otherwise(F.col("tag")).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.when(
            F.col("step") == 0,
            F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), F.col("page_id").cast("string"), F.lit("ETag"), F.col("tag")),
        ).otherwise(
            F.create_map(F.lit("date"), F.concat(F.lit("r"), F.col("page_id").cast("string")), F.lit("Content-Type"), F.lit("text/plain"))
        ).alias("headers"),
    )


def op9_warc_revisits(spark, folder):
    resolved = warc.resolve_revisits(captures(spark, folder))
    headers = F.array_join(
        F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(F.lower(e["key"]), F.lit("="), e["value"]))), ";"
    )
    return resolved.select("record_id", "url", "at", "refers_to", "verdict", headers.alias("headers"))


def op10_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold_remainder(F.col("doc_id"), 5) == 0
    model = language.train(docs.where(~held_out))
    return language.identify(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op11_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


def op12_byte_dedup(spark, folder):
    return byte_dedup.byte_dedup(table(spark, folder, "documents")).drop("removed")


def op13_spelling_variants(spark, folder):
    return spelling.variants(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_topk_search, op2_url_filter, op3_source_mixing, op4_bpe, op5_quality, op6_ngram_jaccard, op7_exact_dedup,
        op8_substring_dedup, op9_warc_revisits, op10_language_id, op11_collocations, op12_byte_dedup,
        op13_spelling_variants,
    )
}
