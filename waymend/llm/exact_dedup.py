"""Exact duplicates by salted combining, in DataFrame operations only.

Texts are equal when they are identical after every white-space character
([\\x20\\x09-\\x0D]) is deleted. Of equal texts the row with the most code points in its
original text stays, then the one with the smallest id.

Method: (1) rows of one task that hold the same (digest, content, salt) are combined
before they leave it; (2) the salted groups are merged, so that a text that makes up a
third of all rows is spread over ``salts`` groups; (3) the winners of all salts meet by
digest. The whole content is part of the grouping key at each of these stages, so rows
whose digests collide stay apart. Rows then look up their winner by digest and a second,
independent one (so that no text has to be shuffled again).

Defined cases: a null text counts as empty, and all empty or white-space-only texts are one
group; repeated rows of one id are members like any others (each gets its own output row);
ids may be null (a null id is larger than any other); an empty table gives an empty result;
further columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import SPACES


def normalised(text: Column) -> Column:
    """Without white space; null is empty."""
    return reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit("")), SPACES, F.coalesce(text.cast("string"), F.lit("")))


def groups(rows: DataFrame, salts: int = 32) -> DataFrame:
    """(digest, content, best, size): one row for each distinct content.

    ``rows`` has digest, content, rank (struct, the smallest stays) and id.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    merged = salted.groupBy("digest", "content", "salt").agg(F.min("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    return (
        merged.repartition("digest").groupBy("digest", "content")
        .agg(F.min("rank").alias("best"), F.sum("n").alias("size"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
    digest: Callable[[Column], Column] = lambda content: F.sha2(content, 256),
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows that repeat the winner's id, text and length all count as kept.
    """
    content = normalised(F.col(text_col))
    short = -F.length(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    # Longest first, then the smallest id; null ids last.
    rank = F.struct(short.alias("short"), F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))
    rows = docs.select(
        F.col(id_col).alias("id"), content.alias("content"), digest(content).alias("digest"), rank.alias("rank")
    )
    winners = groups(rows, salts).select("digest", F.md5("content").alias("check"), "best", "size")
    slim = docs.select(
        F.col(id_col).alias("id"), digest(content).alias("digest"), F.md5(content).alias("check"),
        F.sha2(content, 256).alias("sha"), short.alias("short"),
    )
    return slim.join(winners, ["digest", "check"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("short") == F.col("best.short"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
