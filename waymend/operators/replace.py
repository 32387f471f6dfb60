"""Replace whole trains by a fuller source when both ends of the route agree."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions import fixed_values as fv
from waymend.functions.similarity import similarity_ratio
from waymend.functions.text import (
    cell_text, endpoint_arrival, endpoint_departure, norm_endpoint_name, number_key,
    parse_distance, split_station,
)
from waymend.operators.measures import measures, report, total
from waymend.roles import BASE


def _end_score(declared, offered):
    """0 for a blank declared name, else the similarity of the two ends."""
    own = norm_endpoint_name(declared)
    return F.when(own == "", F.lit(0.0)).otherwise(similarity_ratio(own, norm_endpoint_name(offered)))


def match_routes(meta: DataFrame, routes: DataFrame) -> DataFrame:
    """Decision per train number both sides know.

    meta: number, source_name, dest_name; routes: number, train_name, route (array of
    stops with stationName). reason: null, empty_route_in_source, endpoint_mismatch.
    """
    ends = routes.select(
        "number",
        F.coalesce(F.size("route"), F.lit(0)).alias("stops"),
        F.try_element_at("route", F.lit(1))["stationName"].alias("first_station"),
        F.try_element_at("route", F.lit(-1))["stationName"].alias("last_station"),
    )
    both = meta.join(ends, "number")
    scored = both.withColumns(
        {
            "src_score": _end_score("source_name", split_station("first_station")[0]),
            "dst_score": _end_score("dest_name", split_station("last_station")[0]),
        }
    )
    empty = F.col("stops") <= 0
    good = (F.col("src_score") >= fv.ENDPOINT_ACCEPT) & (F.col("dst_score") >= fv.ENDPOINT_ACCEPT)
    reason = F.when(empty, fv.EMPTY_ROUTE).when(~F.coalesce(good, F.lit(False)), fv.ENDPOINT_MISMATCH)
    return scored.select(
        "number",
        reason.isNull().alias("matched"),
        reason.alias("reason"),
        F.when(~empty, F.bround("src_score", 1)).alias("src_score"),
        F.when(~empty, F.bround("dst_score", 1)).alias("dst_score"),
    )


def route_stops(routes: DataFrame) -> DataFrame:
    """Routes as per-stop rows in the twelve base columns."""
    first_name, first_code = split_station(F.col("route")[0]["stationName"])
    last_name, last_code = split_station(F.element_at("route", -1)["stationName"])
    whole = routes.where(F.size("route") > 0).select(
        "number", "train_name", "route",
        first_code.alias("source_code"), first_name.alias("source_name"),
        last_code.alias("dest_code"), last_name.alias("dest_name"),
    )
    stops = whole.select("*", F.explode("route").alias("stop"))
    name, code = split_station("stop.stationName")
    return stops.select(
        F.col("number").alias("train_no"), "train_name",
        F.coalesce("stop.sno", F.lit("")).alias("seq"),
        code.alias("station_code"), name.alias("station_name"),
        endpoint_arrival("stop.arrives").alias("arrival"),
        endpoint_departure("stop.departs").alias("departure"),
        parse_distance("stop.distance").alias("distance"),
        "source_code", "source_name", "dest_code", "dest_name",
    )


def _number_in_table(train_no="train_no"):
    """The matched number a table row belongs to; only-zero numbers stay as written."""
    text = cell_text(train_no)
    short = F.regexp_replace(text, "^0+", "")
    return F.when(short == "", text).otherwise(short)


def replace_trains(table: DataFrame, needed: DataFrame, routes: DataFrame, decisions: DataFrame):
    """(table, needed) after the swap.

    Matched trains lose all their rows in ``table`` and get the full route instead;
    they leave ``needed``.
    """
    matched = decisions.where("matched").select("number")
    old = table.withColumn("number", _number_in_table()).join(matched, "number", "left_anti")
    new = route_stops(routes.join(matched, "number", "left_semi"))
    still = needed.withColumn("number", number_key("train_no")).join(matched, "number", "left_anti")
    return old.select(*BASE).unionByName(new.select(*BASE)), still.select(*needed.columns)


def replace_log(table, needed, meta, routes, duplicates, decisions) -> DataFrame:
    """(measure, value) rows of the swap: one aggregate for each table."""
    matched = decisions.where("matched").select("number", F.lit(True).alias("hit"))
    hit = F.col("hit").isNotNull()

    def swapped(df, number, before, dropped, after):
        rows = df.select(number.alias("number")).join(matched, "number", "left")
        return measures(rows, {before: total(), dropped: total(hit), after: total(~hit)})

    stops = F.when(hit & (F.size("route") > 0), F.size("route").cast("long"))
    offered = routes.select("number", "route").join(matched, "number", "left")
    return report(
        measures(
            offered,
            {fv.REPLACE_SOURCE: total(), fv.REPLACE_TABLE_ADDED: F.sum(stops), fv.REPLACE_TABLE_AFTER: F.sum(stops)},
        ),
        measures(duplicates, {fv.REPLACE_REPEATED: F.sum("extra")}),
        measures(meta, {fv.REPLACE_NEEDED: total()}),
        measures(
            decisions,
            {
                fv.REPLACE_OVERLAP: total(), fv.REPLACE_MATCHED: total(F.col("matched")),
                fv.REPLACE_REJECTED: total(~F.col("matched")),
            },
        ),
        swapped(table, _number_in_table(), fv.REPLACE_TABLE_BEFORE, fv.REPLACE_TABLE_DROPPED, fv.REPLACE_TABLE_AFTER),
        swapped(
            needed, number_key("train_no"), fv.REPLACE_NEEDED_BEFORE, fv.REPLACE_NEEDED_DROPPED, fv.REPLACE_NEEDED_AFTER
        ),
    )


def rejected_sample(decisions: DataFrame, count: int = 30) -> DataFrame:
    """First rejections by train number, for the log."""
    return decisions.where("not matched").orderBy("number").limit(count)
