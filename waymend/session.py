"""Session settings the jobs rely on, and the shared folder that cuts lineage."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins against a side that is unique per key lean on this for hot keys.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # 'Arrival time' and 'Arrival Time' are different headers.
    "spark.sql.caseSensitive": "true",
}


def build_session(app_name="waymend", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables that cut lineage: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster must
    name one that all executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="waymend-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def frozen(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Cuts lineage, so that values tied to the physical layout cannot change and nothing
    upstream runs again, also after the loss of an executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
