"""A table of Parquet files in versions: a rewrite copies only the files it touches.

Every version is a list of files (one row each in ``manifest/version=n``). A rewrite of some keys
finds the files that hold them, writes the rows of those files anew (without the keys, with the
new rows) and publishes a list of the untouched files and the new ones. Files are never
changed or removed, so readers of an earlier version go on undisturbed, and a writer that is late
fails on the version that another has published.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _manifest(folder) -> str:
    return f"{folder}/manifest"


def _publish(spark: SparkSession, folder, version: int, files: list) -> int:
    """The list of files is the commit: written under a name that must not exist yet."""
    rows = spark.createDataFrame([(f,) for f in files], "file string")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{_manifest(folder)}/version={version:09d}")
    return version


def _written(df: DataFrame, folder) -> list:
    """The files of ``df`` once it is written; none for no rows."""
    path = f"{folder}/data/{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return sorted(written.inputFiles())


def create_versions(df: DataFrame, folder) -> int:
    """Write ``df`` as version 0. Rows that are rewritten together should lie together."""
    return _publish(df.sparkSession, folder, 0, _written(df, folder))


def latest_version(spark: SparkSession, folder) -> int:
    return spark.read.parquet(_manifest(folder)).agg(F.max(F.col("version").cast("int"))).first()[0]


def version_files(spark: SparkSession, folder, version: int | None = None) -> list:
    """Files of a version (default: the latest): as many as the table has, never its rows."""
    version = latest_version(spark, folder) if version is None else version
    listed = spark.read.parquet(f"{_manifest(folder)}/version={version:09d}")
    return sorted(r["file"] for r in listed.collect())


def read_version(spark: SparkSession, folder, version: int | None = None) -> DataFrame:
    return spark.read.parquet(*version_files(spark, folder, version))


def rewrite_keys(spark: SparkSession, folder, key: str, keys: DataFrame, new_rows: DataFrame) -> int:
    """A version in which the rows of ``keys`` (a column named ``key``) are replaced by ``new_rows``.

    Files without any of the keys keep their place and are not read beyond the key column.
    """
    version, files = latest_version(spark, folder), version_files(spark, folder)
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    table = spark.read.parquet(*files)
    holding = table.select(key, F.col("_metadata.file_path").alias("_file")).join(wanted, key, "left_semi")
    touched = {r["_file"] for r in holding.select("_file").distinct().collect()}
    touched = [f for f in files if _plain(f) in {_plain(t) for t in touched}]
    rows = new_rows.select(*table.columns)
    if touched:
        rows = spark.read.parquet(*touched).join(wanted, key, "left_anti").select(*table.columns).unionByName(rows)
    kept = [f for f in files if f not in touched]
    return _publish(spark, folder, version + 1, kept + _written(rows, folder))


def _plain(path: str) -> str:
    """One spelling of a file's address (file:/x and file:///x are the same)."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if rest else path
