"""Reports as (measure, value) rows, each made of one aggregate."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measures(df: DataFrame, values: dict) -> DataFrame:
    """One aggregate over ``df``: a row for each name; no rows count as 0."""
    names = list(values)
    one = df.agg(*[F.coalesce(values[n], F.lit(0)).cast("long").alias(f"v{i}") for i, n in enumerate(names)])
    pairs = [F.struct(F.lit(n).alias("measure"), F.col(f"v{i}").alias("value")) for i, n in enumerate(names)]
    return one.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def report(*parts: DataFrame) -> DataFrame:
    """All parts; values of the same measure add up."""
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.groupBy("measure").agg(F.sum("value").alias("value"))


def total(condition=None):
    """Number of rows, or of those for which the condition holds."""
    return F.count(F.lit(1)) if condition is None else F.count(F.when(condition, 1))
