"""Writers. Results are folders of part files; nothing is gathered on the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.session import frozen


def write_csv(df: DataFrame, path, mode="errorifexists"):
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path, mode="errorifexists"):
    df.write.mode(mode).parquet(path)


def write_train_list(trains: DataFrame, path, column="train_no", mode="errorifexists"):
    """Sorted distinct train numbers under the header 'Train Number'."""
    listed = trains.select(F.col(column).alias("Train Number")).distinct().orderBy("Train Number")
    write_csv(listed, path, mode)


def write_summary_json(summary: DataFrame, path, mode="errorifexists"):
    """A (measure, value) table as JSON lines, one measure per line."""
    summary.write.mode(mode).json(path)


def write_change_reports(status: DataFrame, folder, mode="errorifexists"):
    """new_trains, updated_trains (with their changes) and missing_trains.

    The status is written once in between; the three reports would each compute it.
    """
    status = frozen(status.where("status <> 'unchanged'"))
    number = F.col("train_no").alias("Train Number")
    changes = F.array_join("changes", ", ").alias("Changes")
    write_csv(status.where("status = 'new'").select(number), f"{folder}/new_trains", mode)
    write_csv(
        status.where("status = 'updated'").select(number, changes), f"{folder}/updated_trains", mode
    )
    write_csv(status.where("status = 'missing'").select(number), f"{folder}/missing_trains", mode)


def write_new_version(df: DataFrame, folder, version: str):
    """Write a rewritten table next to the one it was read from, never over it."""
    write_parquet(df, f"{folder}/version={version}")
    return f"{folder}/version={version}"
