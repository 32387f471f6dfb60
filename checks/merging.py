"""Two views of the line items as sibling tables: cross-fill and merge queries."""

from pyspark.sql import functions as F

from checks.tables import S, as_stops, day, numbered, sql, stops, table, whole
from waymend.operators import merge as m
from waymend.roles import BASE


def sibling(spark, folder):
    """The line items once more: pending orders under another number, other fields missing."""
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines, orders = lines.withColumn("l_orderkey", F.col("l_orderkey").cast(S)), orders.withColumn("o_orderkey", F.col("o_orderkey").cast(S))
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey, "left").join(
        orders, lines.l_orderkey == orders.o_orderkey, "left"
    )
    pending = F.col("o_orderstatus") == "P"
    key = F.col("l_orderkey").cast(S)
    return as_stops(
        joined,
        train_no=F.when(pending, F.concat(F.lit("P"), key)).otherwise(key),
        train_name=F.col("o_orderstatus"),
        seq=F.col("l_linenumber"),
        station_code=F.col("l_partkey"),
        station_name=F.col("p_name"),
        arrival=F.when(F.col("l_linestatus") == "O", day("l_shipdate")),
        departure=F.when(F.col("l_returnflag") != "A", day("l_shipdate")),
        distance=F.when(F.col("l_returnflag") != "N", whole("l_quantity")),
        source_code=F.when(~pending, F.col("o_custkey").cast(S)),
        dest_code=F.col("o_custkey"),
    )


def _both(spark, folder):
    return stops(spark, folder), sibling(spark, folder)


def cross_fill(spark, folder):
    filled = m.cross_fill(stops(spark, folder), sibling(spark, folder))
    return filled.select(
        "row_id", "train_no", "station_code", "arrival", "departure", "distance", "timing_source"
    )


def cross_fill_counts(spark, folder):
    return m.fill_counts(m.cross_fill(sibling(spark, folder), stops(spark, folder)))


def overlap_resolution(spark, folder):
    return m.overlap_decisions(*_both(spark, folder))


def merge_sources(spark, folder):
    return m.merge_sources(m.united(*_both(spark, folder))).select(*BASE, "source_dataset", "timing_source")


def merge_log(spark, folder):
    return m.merge_log(m.united(*_both(spark, folder)))


def decision_sample(spark, folder):
    return m.decision_sample(m.overlap_decisions(*_both(spark, folder)))


QUERIES = {
    f.__name__: f
    for f in (cross_fill, cross_fill_counts, overlap_resolution, merge_sources, merge_log, decision_sample)
}

_FIELDS = ["arrival", "departure", "distance"]


def _lookup(source):
    return (
        f"SELECT train_no, station_code, {', '.join(f'max({f}) AS o_{f}' for f in _FIELDS)} "
        f"FROM {source} GROUP BY 1, 2 HAVING count(*) = 1"
    )


def _filled(source, lookup):
    others = ", ".join(f"coalesce({f}, o_{f}) AS {f}" for f in _FIELDS)
    hits = ", ".join(f"{f} IS NULL AND o_{f} IS NOT NULL AS hit_{f}" for f in _FIELDS)
    return (
        f"SELECT s.* EXCLUDE ({', '.join(_FIELDS)}), {others}, {hits}, "
        f"CASE WHEN {' OR '.join(f'({f} IS NULL AND o_{f} IS NOT NULL)' for f in _FIELDS)} "
        f"THEN 'filled_from_sibling_dataset' ELSE 'original' END AS timing_source "
        f"FROM {source} s LEFT JOIN {lookup} USING (train_no, station_code)"
    )


def _missing(source):
    nulls = " + ".join(f"CASE WHEN {f} IS NULL THEN 1 ELSE 0 END" for f in _FIELDS)
    return f"SELECT train_no, sum({nulls})::BIGINT AS missing FROM {source} GROUP BY 1"


_VIEWS = {
    "sibling": """
      SELECT row_id, CASE WHEN o_orderstatus = 'P' THEN 'P' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS train_no,
        o_orderstatus AS train_name, CAST(l_linenumber AS VARCHAR) AS seq, CAST(l_partkey AS VARCHAR) AS station_code,
        p_name AS station_name,
        CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END AS arrival,
        CASE WHEN l_returnflag <> 'A' THEN strftime(l_shipdate, '%Y-%m-%d') END AS departure,
        CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS distance,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS source_code,
        CAST(NULL AS VARCHAR) AS source_name, CAST(o_custkey AS VARCHAR) AS dest_code, CAST(NULL AS VARCHAR) AS dest_name
      FROM lines LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "look1": _lookup("stops"),
    "look2": _lookup("sibling"),
    "filled1": _filled("stops", "look2"),
    "filled2": _filled("sibling", "look1"),
    "miss1": _missing("filled1"),
    "miss2": _missing("filled2"),
    "decisions": """SELECT train_no, CASE WHEN a.missing <= b.missing THEN 'dataset1' ELSE 'dataset2' END AS kept_source,
        CASE WHEN a.missing <= b.missing THEN 'dataset2' ELSE 'dataset1' END AS dropped_source,
        a.missing AS dataset1_missing_fields, b.missing AS dataset2_missing_fields
      FROM miss1 a JOIN miss2 b USING (train_no)""",
    "both_kept": f"""
      SELECT {', '.join(BASE)}, 'dataset1_original' AS source_dataset, timing_source, 0 AS rank, row_id FROM filled1
      WHERE train_no NOT IN (SELECT train_no FROM decisions WHERE dropped_source = 'dataset1')
      UNION ALL
      SELECT {', '.join(BASE)}, 'dataset2_uploaded', timing_source, 1, row_id FROM filled2
      WHERE train_no NOT IN (SELECT train_no FROM decisions WHERE dropped_source = 'dataset2')""",
    "merged": f"""SELECT {', '.join(BASE)}, source_dataset, timing_source FROM both_kept
      QUALIFY row_number() OVER (PARTITION BY {', '.join(BASE)} ORDER BY rank, row_id) = 1""",
}


def _counts(source):
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER (hit_{f}) AS n FROM {source}" for f in _FIELDS
    )


_LOST = "filled2 JOIN decisions USING (train_no) WHERE timing_source <> 'original' AND dropped_source = 'dataset2'"
ORACLE = {
    "cross_fill": sql(
        "SELECT row_id, train_no, station_code, arrival, departure, distance, timing_source FROM filled1", _VIEWS
    ),
    "cross_fill_counts": sql(_counts("filled2"), _VIEWS),
    "overlap_resolution": sql("SELECT * FROM decisions", _VIEWS),
    "merge_sources": sql("SELECT * FROM merged", _VIEWS),
    "merge_log": sql(
        f"""SELECT 'dataset1_input_rows' AS measure, count(*) AS value FROM stops
        UNION ALL SELECT 'dataset2_input_rows', count(*) FROM sibling
        UNION ALL SELECT 'dataset1_unique_trains', count(DISTINCT train_no) FROM stops
        UNION ALL SELECT 'dataset2_unique_trains', count(DISTINCT train_no) FROM sibling
        UNION ALL SELECT 'trains_present_in_both', count(*) FROM decisions
        UNION ALL SELECT 'trains_kept_from_dataset1_on_overlap', count(*) FILTER (kept_source = 'dataset1') FROM decisions
        UNION ALL SELECT 'trains_kept_from_dataset2_on_overlap', count(*) FILTER (kept_source = 'dataset2') FROM decisions
        UNION ALL SELECT 'dataset1_cross_fill_counts:' || field, n FROM ({_counts('filled1')})
        UNION ALL SELECT 'dataset2_cross_fill_counts:' || field, n FROM ({_counts('filled2')})
        UNION ALL SELECT 'dataset2_filled_rows_dropped', count(*) FROM {_LOST}
        UNION ALL SELECT 'dataset2_filled_rows_retained',
          (SELECT count(*) FROM filled2 WHERE timing_source <> 'original') - (SELECT count(*) FROM {_LOST})
        UNION ALL SELECT 'exact_duplicate_rows_removed_in_final_pass',
          (SELECT count(*) FROM both_kept) - (SELECT count(*) FROM merged)
        UNION ALL SELECT 'final_merged_row_count', count(*) FROM merged
        UNION ALL SELECT 'final_merged_unique_trains', count(DISTINCT train_no) FROM merged
        UNION ALL SELECT 'final_merged_unique_stations', count(DISTINCT station_code) FROM merged""",
        _VIEWS,
    ),
    "decision_sample": sql("SELECT * FROM decisions ORDER BY train_no LIMIT 25", _VIEWS),
}
