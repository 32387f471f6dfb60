"""Codes and train numbers against reference lists, and the columns added from it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions import fixed_values as fv
from waymend.functions.text import digits_key, is_truncation_of, norm_ref_name
from waymend.operators.keyed import first_per_key


def station_crossref(stops: DataFrame, reference: DataFrame, secondary: DataFrame) -> DataFrame:
    """One row per distinct code with its status.

    reference: code, name, state, zone (one row per code); secondary: code, name.
    """
    # The stops are read once: each code meets its secondary names, if any, and becomes one row again.
    name, other, listed = norm_ref_name("station_name"), norm_ref_name("name"), F.col("listed")
    pairs = _secondary_pairs(secondary).withColumn("listed", F.lit(True))
    codes = (
        first_per_key(stops, "station_code", ["station_name"]).join(pairs, "station_code", "left").groupBy("station_code")
        .agg(
            F.first("station_name").alias("station_name"),
            F.max(F.when(listed, name.contains(other) | other.contains(name))).alias("secondary_match"),
            F.when(F.count(listed) > 0, F.concat(
                F.count(listed).cast("string"), F.lit(" names: "), F.min("name"), F.lit(" .. "), F.max("name")
            )).alias("secondary_names"),
        )
    )
    primary = reference.select(
        F.col("code").alias("station_code"),
        F.col("name").alias("reference_name"),
        F.col("state").alias("reference_state"),
        F.col("zone").alias("reference_zone"),
        F.lit(True).alias("in_primary"),
    )
    joined = codes.join(primary, "station_code", "left").withColumn(
        "found_in_primary_reference", F.coalesce("in_primary", F.lit(False))
    )
    primary_hit = F.col("found_in_primary_reference")
    named = F.coalesce(F.col("reference_name") != "", F.lit(False))
    same = F.when(primary_hit & named, norm_ref_name("station_name") == norm_ref_name("reference_name"))
    cut = named & is_truncation_of("station_name", "reference_name")
    second_hit = F.col("secondary_match").isNotNull()
    status = (
        F.when(primary_hit & F.coalesce(same, F.lit(False)), fv.VERIFIED)
        .when(primary_hit & cut, fv.TRUNCATED)
        .when(primary_hit, fv.NAME_MISMATCH)
        .when(second_hit & F.col("secondary_match"), fv.SECONDARY_ONLY)
        .when(second_hit, fv.MANUAL)
        .otherwise(fv.NOT_FOUND)
    )
    return joined.select(
        "station_code",
        F.col("station_name").alias("station_name_in_dataset"),
        "found_in_primary_reference", "reference_name", "reference_state", "reference_zone",
        same.alias("name_match"),
        F.when(~primary_hit, second_hit).alias("found_in_secondary_reference"),
        F.when(~primary_hit, F.col("secondary_names")).alias("secondary_names_for_code"),
        status.alias("status"),
    ).withColumn(
        "suggested_full_name",
        F.when(F.col("status").isin(fv.TRUNCATED, fv.NAME_MISMATCH), F.col("reference_name")),
    )


def _secondary_pairs(secondary: DataFrame) -> DataFrame:
    return secondary.select(F.col("code").alias("station_code"), "name").distinct()


def secondary_names(stops: DataFrame, secondary: DataFrame) -> DataFrame:
    """(station_code, name): every secondary name of every code in the stops."""
    codes = stops.select("station_code").distinct()
    return _secondary_pairs(secondary).join(codes, "station_code", "left_semi")


def train_crossref(stops: DataFrame, reference: DataFrame) -> DataFrame:
    """One row per distinct train number; reference: number_key, name, zone, from/to."""
    trains = first_per_key(stops, "train_no", ["train_name"]).withColumn(
        "number_key", digits_key("train_no")
    )
    listed = reference.select(
        "number_key",
        F.col("name").alias("reference_name"), F.col("zone").alias("reference_zone"),
        F.col("from_code").alias("reference_from"), F.col("to_code").alias("reference_to"),
        F.lit(True).alias("listed"),
    )
    present = F.coalesce("listed", F.lit(False))
    return trains.join(listed, "number_key", "left").select(
        "train_no",
        F.col("train_name").alias("train_name_in_dataset"),
        present.alias("found_in_reference"),
        "reference_name", "reference_zone", "reference_from", "reference_to",
        F.when(present, fv.TRAIN_PRESENT).otherwise(fv.TRAIN_ABSENT).alias("status"),
    )


def status_counts(crossref: DataFrame) -> DataFrame:
    return crossref.groupBy("status").agg(F.count("*").alias("n"))


def enrich(stops: DataFrame, crossref: DataFrame) -> DataFrame:
    """Add ``validation_status`` and, for cut-off names only, ``reference_name``."""
    known = crossref.where("station_code is not null").select(
        "station_code", "status", "suggested_full_name"
    )
    return stops.join(known, "station_code", "left").select(
        *stops.columns,
        F.coalesce("status", F.lit(fv.MANUAL)).alias("validation_status"),
        F.when(F.col("status") == fv.TRUNCATED, F.col("suggested_full_name"))
        .otherwise(F.lit("")).alias("reference_name"),
    )
