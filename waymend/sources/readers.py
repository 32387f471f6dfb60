"""Readers. Every cell is text; numbers are parsed where they are used."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymend.functions.text import cell_text, number_key, strip_leading_zeros, trim_ws
from waymend.operators.keyed import first_per_key, last_per_key
from waymend.roles import quoted
from waymend.session import frozen


def _raw_csv(spark, path, multiline=False):
    return (
        spark.read.option("header", True).option("multiLine", multiline)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def spread(df: DataFrame, *keys) -> DataFrame:
    """Share rows out when a scan has at most half as many tasks as the cluster has cores.

    A file written as one large piece is read by one task; everything up to the next
    shuffle would run there. Larger inputs have more pieces than cores and stay as
    they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() * 2 <= cores
    return df.repartition(cores, *keys) if few else df


def _stripped_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def read_schedule(spark: SparkSession, path, multiline=False) -> DataFrame:
    """CSV of unknown layout: all text, blanks are '', header names stripped."""
    return _stripped_headers(_raw_csv(spark, path, multiline)).fillna("")


def read_station_master(spark: SparkSession, path) -> DataFrame:
    """Station master with its file order in ``ord``."""
    return station_master(with_csv_row_id(read_schedule_with_place(spark, path), "ord"))


def station_master(df: DataFrame) -> DataFrame:
    """code, canonical_name, aliases (array), ord from the raw master columns."""
    present = set(df.columns)
    text = cell_text("Aliases") if "Aliases" in present else F.lit("")
    aliases = F.filter(F.transform(F.split(text, ";"), trim_ws), lambda a: a != "")
    return df.select(
        cell_text("Station Code").alias("code"),
        cell_text("Canonical Name").alias("canonical_name"),
        aliases.alias("aliases"),
        F.col("ord"),
    )


def read_stops_null_blank(spark: SparkSession, path, multiline=False) -> DataFrame:
    """CSV in which only the empty text is null; 'NA' stays text."""
    df = _raw_csv(spark, path, multiline)
    return df.select(*[F.nullif(quoted(c), F.lit("")).alias(c) for c in df.columns])


def read_schedule_with_place(spark: SparkSession, path, multiline=False) -> DataFrame:
    """As ``read_schedule`` plus the place columns ``with_csv_row_id`` needs."""
    df = _raw_csv(spark, path, multiline)
    place = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_order"),
    ]
    cells = [F.coalesce(quoted(c), F.lit("")).alias(c.strip()) for c in df.columns]
    return df.select(*cells, *place)


def read_stops_with_row_id(spark: SparkSession, path, multiline=False) -> DataFrame:
    """As ``read_stops_null_blank`` with the row's place in the file(s) as ``row_id``."""
    placed = read_schedule_with_place(spark, path, multiline)
    keep = ("_file", "_start", "_order")
    cells = [
        quoted(c) if c in keep else F.nullif(quoted(c), F.lit("")).alias(c)
        for c in placed.columns
    ]
    return with_csv_row_id(placed.select(*cells))


def _numbered(df: DataFrame, parts: list, within: Column, name: str) -> DataFrame:
    """Dense numbers: rows of earlier parts plus the place within the part.

    The part table has one row per file split, which bounds the one window that sees
    all of it.
    """
    sizes = df.groupBy(*parts).agg(F.count("*").alias("_size"), F.min(within).alias("_low"))
    every = Window.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *parts, "_low", F.coalesce(F.sum("_size").over(every), F.lit(0)).alias("_before")
    )
    return df.join(starts, parts).withColumn(name, F.col("_before") + within - F.col("_low")).drop(
        *parts, "_low", "_before"
    )


def with_csv_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Turn the place columns into dense row numbers over all files in path order.

    How splits are packed into tasks may differ between two scans, so the placed rows
    are checkpointed once, at ingest.
    """
    return _numbered(frozen(df), ["_file", "_start"], F.col("_order"), name).drop("_order")


def read_parquet_with_row_id(spark: SparkSession, path, columns=None, name="row_id") -> DataFrame:
    """Parquet rows with their dense number; a single file needs no further job."""
    df = spark.read.parquet(path)
    picked = [quoted(c) for c in (columns or df.columns)]
    index = F.col("_metadata.row_index")
    files = df.inputFiles()
    if len(files) == 1:
        return spread(df.select(*picked, index.alias(name)), name)
    placed = df.select(*picked, F.col("_metadata.file_path").alias("_file"), index.alias("_order"))
    return _numbered(placed, ["_file"], F.col("_order"), name).drop("_order")


STATION_REFERENCE = "properties STRUCT<code: STRING, name: STRING, state: STRING, zone: STRING>"
TRAIN_REFERENCE = (
    "properties STRUCT<number: STRING, name: STRING, zone: STRING,"
    " from_station_code: STRING, from_station_name: STRING, to_station_code: STRING,"
    " to_station_name: STRING, type: STRING>"
)


def json_pieces(spark: SparkSession, path, key: str) -> DataFrame:
    """What follows each key ``key`` in JSON files: ``value`` (text up to the next one) and ``pos``, its place.

    The key's name is the separator of records, so large files are read in as many splits as any
    text, not by one task each. Inside a JSON text the quotes around the name would be
    escaped; a piece that is cut short by a value of that very name fails in ``from_json`` (FAILFAST).
    """
    rows = spark.read.option("lineSep", f'"{key}"').text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    return rows.select("value", place.alias("pos"))


def _parsed(value, key, schema):
    return F.from_json(F.concat(F.lit('{"' + key + '"'), value), schema, {"mode": "FAILFAST"})


def _features(spark, path, schema):
    pieces = json_pieces(spark, path, "properties").where(F.ltrim("value").startswith(":"))
    return pieces.select("pos", _parsed(F.col("value"), "properties", schema).alias("feature")).select("pos", "feature.properties.*")


def station_reference(rows: DataFrame) -> DataFrame:
    """Last entry per non-empty code; ``rows``: pos, code, name, state, zone."""
    return last_per_key(rows.where(F.col("code") != ""), "code", ["name", "state", "zone"], F.col("pos"))


def read_station_reference(spark: SparkSession, path) -> DataFrame:
    return station_reference(_features(spark, path, STATION_REFERENCE))


def train_reference(rows: DataFrame) -> DataFrame:
    """Last entry per number without leading zeros."""
    keyed = rows.where(F.col("number") != "").select(
        "pos",
        strip_leading_zeros("number").alias("number_key"),
        "name", "zone",
        F.col("from_station_code").alias("from_code"),
        F.col("from_station_name").alias("from_name"),
        F.col("to_station_code").alias("to_code"),
        F.col("to_station_name").alias("to_name"),
        "type",
    )
    values = [c for c in keyed.columns if c not in ("pos", "number_key")]
    return last_per_key(keyed, "number_key", values, F.col("pos"))


def read_train_reference(spark: SparkSession, path) -> DataFrame:
    return train_reference(_features(spark, path, TRAIN_REFERENCE))


def read_secondary_codes(spark: SparkSession, path) -> DataFrame:
    """(code, name) rows of a JSON array whose first element maps names to codes."""
    text = spark.read.text(path, wholetext=True)
    first = F.try_element_at(F.from_json("value", "array<map<string,string>>"), F.lit(1))
    return text.select(F.explode(first).alias("name", "code"))


ROUTE = (
    "trainNumber STRING, trainName STRING, trainRoute ARRAY<STRUCT<sno: STRING,"
    " stationName: STRING, arrives: STRING, departs: STRING, distance: STRING>>"
)


def read_route_json(spark: SparkSession, paths: list) -> tuple[DataFrame, DataFrame]:
    """(routes, duplicates): the last file and position wins for a train number.

    Each file is an array of trains whose first key is trainNumber, where the file is cut; another
    order of keys is an error. routes: number, train_name, route; duplicates: number, extra (rows
    beyond the first).
    """
    rows = None
    for i, path in enumerate(paths):
        pieces = json_pieces(spark, path, "trainNumber")
        value = F.col("value")
        whole = value.rlike(r"(^|[{\]])\s*\z")  # up to the next object, or to the end of the array
        checked = F.when(whole, value).otherwise(F.raise_error(F.lit(f"trainNumber is not the first key of a train in {path}")))
        part = (
            pieces.withColumn("value", checked).where(F.ltrim("value").startswith(":"))
            .select(F.lit(i).alias("file_no"), "pos", _parsed(F.col("value"), "trainNumber", ROUTE).alias("t"))
            .select("file_no", "pos", "t.*")
        )
        rows = part if rows is None else rows.unionByName(part)
    return last_routes(rows)


def last_routes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: file_no, pos, trainNumber, trainName, trainRoute."""
    keyed = rows.withColumn("number", strip_leading_zeros(trim_ws("trainNumber")))
    routes = last_per_key(
        keyed, "number", ["trainName", "trainRoute"], F.struct("file_no", "pos")
    ).withColumnsRenamed({"trainName": "train_name", "trainRoute": "route"})
    duplicates = (
        keyed.groupBy("number").agg((F.count("*") - 1).alias("extra")).where("extra > 0")
    )
    return routes, duplicates


def needed_meta(needed: DataFrame) -> DataFrame:
    """Declared end names of each train from its first row; key without leading zeros."""
    keyed = needed.withColumn("number", number_key("train_no"))
    return first_per_key(keyed, "number", ["source_name", "dest_name"])
