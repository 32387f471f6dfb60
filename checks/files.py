"""The given tables through files and back: readers, writers and versions."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.merging import ORACLE as MERGE_SQL
from checks.merging import merge_log
from checks.migration import ORACLE as MIGRATION_SQL
from checks.migration import _two_schedules
from checks.tables import S, sql, stops, table
from waymend.operators import diff
from waymend.roles import BASE, rename_to_common, to_headers, to_roles
from waymend.session import shared_folder
from waymend.sources import readers, versions, writers


def _folder(spark):
    return f"{shared_folder(spark)}/check-{uuid.uuid4().hex}"


def _csv(spark, folder):
    path = _folder(spark)
    writers.write_csv(to_headers(stops(spark, folder).select(*BASE)), path)
    return path


def csv_blank_cells(spark, folder):
    """Stops written as CSV and read in the convention of validation: blanks are ''."""
    return to_roles(readers.read_schedule(spark, _csv(spark, folder))).select(*BASE)


def csv_null_cells(spark, folder):
    """The same in the convention of the audit: the empty text is null."""
    return to_roles(readers.read_stops_null_blank(spark, _csv(spark, folder))).select(*BASE)


def common_schema(spark, folder):
    """Headers of another table renamed to the common ones; an absent name is ignored."""
    renames = {"p_partkey": "Station Code", "p_name": "Station Name", "no such header": "SEQ"}
    return rename_to_common(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), renames)


def csv_row_numbers(spark, folder):
    """Numbers of the rows of all CSV files: dense, from 0."""
    rows = readers.read_stops_with_row_id(spark, _csv(spark, folder))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("row_id").alias("low"), F.max("row_id").alias("high"),
        F.count_distinct("row_id").alias("different"),
    )


def train_list(spark, folder):
    path = _folder(spark)
    writers.write_train_list(stops(spark, folder), path)
    return readers.read_schedule(spark, path).select(F.col("Train Number").alias("train_no"))


def summary_json(spark, folder):
    path = _folder(spark)
    writers.write_summary_json(merge_log(spark, folder), path)
    return spark.read.schema("measure string, value long").json(path)


def change_reports(spark, folder):
    path = _folder(spark)
    writers.write_change_reports(diff.schedule_status(*_two_schedules(spark, folder)), path)
    parts = []
    for kind in ("new", "updated", "missing"):
        rows = readers.read_schedule(spark, f"{path}/{kind}_trains")
        changes = F.col("Changes") if kind == "updated" else F.lit("")
        parts.append(rows.select(F.lit(kind).alias("status"), F.col("Train Number").alias("train_no"), changes.alias("changes")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def station_master_file(spark, folder):
    """Parts as a station master: written, read back with the aliases as a list and dense numbers."""
    path = _folder(spark)
    parts = table(spark, folder, "part")
    writers.write_csv(parts.select(
        F.concat(F.lit(" P"), F.col("p_partkey").cast(S)).alias(" Station Code"), F.col("p_name").alias("Canonical Name"),
        F.concat_ws(";", "p_brand", F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")), F.lit("")).alias("Aliases"),
    ), path)
    master = readers.read_station_master(spark, path)
    dense = master.agg(F.max("ord") + 1 == F.count_distinct("ord")).scalar()
    return master.where(dense).select("code", "canonical_name", F.array_join("aliases", "|").alias("aliases"))


def _json_files(rows, value, path, head="[", tail="]"):
    """The rows' ``value`` as JSON arrays between ``head`` and ``tail``, in folders ``file=``/``piece=``.

    Pieces are ranges of (file, place), named in their order: paths sort as the rows do, and no task
    holds more than a piece, however long a file is.
    """
    cut = rows.repartitionByRange("file", "place").withColumn("piece", F.lpad(F.spark_partition_id().cast(S), 6, "0"))
    within = Window.partitionBy("file", "piece").orderBy("place")
    text = F.concat(
        F.when(F.row_number().over(within) == 1, F.lit(head)).otherwise(F.lit("")), F.to_json(value),
        F.when(F.lead(F.lit(True)).over(within).isNull(), F.lit(tail)).otherwise(F.lit(",")),
    )
    lines = cut.select("file", "piece", "place", text.alias("value")).sortWithinPartitions("file", "piece", "place")
    lines.select("file", "piece", "value").write.partitionBy("file", "piece").text(path)


def _features(spark, folder, rows):
    """Feature files, one for each value of ``file``."""
    path = _folder(spark)
    properties = F.struct(F.struct(*[c for c in rows.columns if c not in ("file", "place")]).alias("properties"), F.lit("Feature").alias("type"))
    _json_files(rows, properties, path, '{"type":"FeatureCollection","features":[', "]}")
    return path


def station_reference_file(spark, folder):
    """Customers as stations; each code occurs once for each of its orders' priorities, the last counts."""
    customers = table(spark, folder, "customer")
    rows = customers.select(
        F.pmod("c_custkey", F.lit(7)).alias("file"), F.explode(F.array(F.lit(0), F.lit(1))).alias("step"), "c_custkey", "c_name", "c_mktsegment"
    ).select(
        "file", (F.col("c_custkey") * 2 + F.col("step")).alias("place"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), F.col("c_custkey").cast(S))).alias("code"),
        F.when(F.col("step") == 0, F.lit('an "old" name, {unused}')).otherwise(F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("state"), F.lit(None).cast(S).alias("zone"),
    )
    return readers.read_station_reference(spark, _features(spark, folder, rows))


def train_reference_file(spark, folder):
    """Orders as trains whose numbers are written with leading zeros."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        F.pmod("o_orderkey", F.lit(5)).alias("file"), F.col("o_orderkey").alias("place"),
        F.lpad(F.col("o_orderkey").cast(S), 9, "0").alias("number"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("zone"), F.col("o_custkey").cast(S).alias("from_station_code"),
    )
    found = readers.read_train_reference(spark, _features(spark, folder, rows))
    return found.select("number_key", "name", "zone", "from_code", "to_code")


def route_files(spark, folder):
    """Orders as routes of customers in two files; the later one, and in it the later order, counts."""
    orders = table(spark, folder, "orders")
    priority = F.substring("o_orderpriority", 1, 1)
    stop = F.struct(F.lit("1").alias("sno"), F.col("o_orderpriority").alias("stationName"), F.lit("Source").alias("arrives"),
                    F.lit("9:05").alias("departs"), F.lit("0 kms").alias("distance"))
    trains = orders.select(
        (priority == "1").cast("int").alias("file"), F.col("o_orderkey").alias("place"),
        F.struct(F.lpad(F.col("o_custkey").cast(S), 8, "0").alias("trainNumber"), F.col("o_orderkey").cast(S).alias("trainName"),
                 F.array(stop).alias("trainRoute")).alias("train"),
    )
    path = _folder(spark)
    _json_files(trains, F.col("train"), path)
    routes, duplicates = readers.read_route_json(spark, [f"{path}/file=0", f"{path}/file=1"])
    return routes.join(duplicates, "number", "left").select(
        "number", "train_name", F.col("route")[0]["stationName"].alias("first"), F.coalesce("extra", F.lit(0)).alias("extra")
    )


def versioned_rewrite(spark, folder):
    """Line items as a versioned table; trains of finished orders keep only their lines that were not
    returned, under another name. The newest version is read."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("train"), F.col("l_linenumber").cast("int").alias("seq"), F.col("l_returnflag").alias("flag"), F.lit("old").alias("name")
    )
    orders = table(spark, folder, "orders")
    path = _folder(spark)
    versions.create_versions(lines.repartitionByRange(8, "train"), path)
    keys = orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("train"))
    new = lines.join(keys, "train", "left_semi").where("flag <> 'R'").withColumn("name", F.lit("new"))
    versions.rewrite_keys(spark, path, "train", keys, new)
    return versions.read_version(spark, path)


QUERIES = {
    f.__name__: f
    for f in (
        csv_blank_cells, csv_null_cells, common_schema, csv_row_numbers, train_list, summary_json, change_reports, station_master_file,
        station_reference_file, train_reference_file, route_files, versioned_rewrite,
    )
}

_BLANK = ", ".join(f"coalesce({c}, '') AS {c}" for c in BASE)
ORACLE = {
    "csv_blank_cells": sql(f"SELECT {_BLANK} FROM stops"),
    "csv_null_cells": sql(f"SELECT {', '.join(BASE)} FROM stops"),
    "common_schema": 'SELECT p_partkey AS "Station Code", p_name AS "Station Name", p_brand FROM part',
    "csv_row_numbers": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS low, count(*) - 1 AS high, count(*) AS different FROM lineitem",
    "train_list": sql("SELECT DISTINCT train_no FROM stops"),
    "summary_json": MERGE_SQL["merge_log"],
    "change_reports": "SELECT status, train_no, CASE WHEN status = 'updated' THEN changes ELSE '' END AS changes FROM ("
    + MIGRATION_SQL["schedule_status"] + ") WHERE status <> 'unchanged'",
    "station_master_file": """SELECT 'P' || p_partkey AS code, p_name AS canonical_name, p_brand || '|' || p_type AS aliases FROM part""",
    "station_reference_file": """SELECT 'C' || c_custkey AS code, c_name AS name, c_mktsegment AS state, CAST(NULL AS VARCHAR) AS zone
      FROM customer WHERE c_custkey % 5 <> 0""",
    "train_reference_file": """SELECT CAST(o_orderkey AS VARCHAR) AS number_key, o_orderpriority AS name, o_orderstatus AS zone,
      CAST(o_custkey AS VARCHAR) AS from_code, CAST(NULL AS VARCHAR) AS to_code FROM orders""",
    "route_files": """SELECT CAST(o_custkey AS VARCHAR) AS number,
        CAST(arg_max(o_orderkey, place) AS VARCHAR) AS train_name, arg_max(o_orderpriority, place) AS first, count(*) - 1 AS extra
      FROM (SELECT *, (CASE WHEN o_orderpriority LIKE '1%' THEN 1000000000000 ELSE 0 END) + o_orderkey AS place FROM orders) GROUP BY 1""",
    "versioned_rewrite": """SELECT l_orderkey AS train, CAST(l_linenumber AS INTEGER) AS seq, l_returnflag AS flag,
        CASE WHEN o_orderkey IS NULL THEN 'old' ELSE 'new' END AS name
      FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') ON o_orderkey = l_orderkey
      WHERE o_orderkey IS NULL OR l_returnflag <> 'R'""",
}
