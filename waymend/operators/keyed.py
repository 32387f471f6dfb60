"""Per-key helpers that stay safe when one key holds a large part of the rows.

Every group is reduced by an aggregate first (partial sums before the shuffle) and
only the one-row-per-key result is joined back, so a hot key never has to fit into
one task; adaptive execution splits its side of the join.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: list, how: str) -> DataFrame:
    """Equi join in which two nulls match; key columns are kept once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def repeated_keys(df: DataFrame, keys: list) -> DataFrame:
    """Keys that occur more than once, with ``_n``; nulls are values like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")


def rows_of_repeated_keys(df: DataFrame, keys: list) -> DataFrame:
    """All rows of every group with more than one member."""
    return join_on_keys(df, repeated_keys(df, keys).select(*keys), keys, "left_semi")


def repeated_rows(df: DataFrame, columns: list) -> DataFrame:
    """All rows that equal another row in ``columns``, nulls like any value.

    A 64-bit hash is counted first; only rows whose hash repeats are grouped by the columns
    themselves, so texts of unique rows are neither shuffled nor compared.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*columns))
    suspects = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    return rows_of_repeated_keys(hashed.join(suspects, "_hash", "left_semi"), ["_hash", *columns]).drop("_hash")


def first_per_key(df: DataFrame, key: str, values: list, row_id: str = "row_id") -> DataFrame:
    """The earliest row of each key; null is a key too."""
    picked = F.min_by(F.struct(*values), F.col(row_id)).alias("_first")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_first.{v}") for v in values])


def last_per_key(df: DataFrame, key: str, values: list, order) -> DataFrame:
    """The latest row of each key in the order of ``order`` (a column or struct)."""
    picked = F.max_by(F.struct(*values), order).alias("_last")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_last.{v}") for v in values])


def drop_duplicates_keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """First row of each group. Spark limits every task to one row per group before it
    shuffles, so repeated rows do not travel."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list, order: list, count: int, rank: str) -> DataFrame:
    """The first ``count`` rows of each key with their rank (limited before the shuffle)."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) <= count)
