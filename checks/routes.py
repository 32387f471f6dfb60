"""Gated replacement and distance queries."""

from pyspark.sql import functions as F

from checks.tables import S, as_stops, numbered, sql, stops, table
from checks.text import endpoint_form, ratio_sql
from waymend.operators import distance as dist
from waymend.operators import replace as rep
from waymend.roles import BASE
from waymend.sources.readers import last_routes, needed_meta

# ------------------------------------------------------------ replacement


def _order_facts(spark, folder):
    orders = numbered(
        spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
    )


def _needed(spark, folder):
    """One row per order with its declared ends; pending orders declare no source."""
    df = _order_facts(spark, folder)
    pending = F.col("o_orderstatus") == "P"
    return as_stops(
        df, train_no=F.lpad(F.col("o_custkey").cast(S), 7, "0"), seq=F.col("o_orderkey"),
        source_name=F.when(pending, F.lit("")).otherwise(F.col("c_mktsegment")),
        dest_name=F.concat("r_name", F.lit(" JN")),
    )


def _routes(spark, folder):
    """Routes of customers as offered by their orders; the last order counts."""
    df = _order_facts(spark, folder)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    first = (
        F.when(urgent, F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "F", F.concat("c_mktsegment", F.lit(" CITY - Terminal")))
        .otherwise(F.substring("c_mktsegment", 1, 5))
    )
    last = F.when(F.col("o_orderpriority") == "5-LOW", "ASIA").otherwise(F.col("r_name"))

    def stop(sno, name, code, arrives, departs, km):
        return F.struct(
            F.lit(sno).alias("sno"), F.concat(name, F.lit(" - "), code).alias("stationName"),
            arrives.alias("arrives"), departs.alias("departs"), km.alias("distance"),
        )

    clock = F.date_format("o_orderdate", "M:dd")
    whole = F.array(
        stop("1", first, F.col("o_orderstatus"), F.lit("Source"), clock, F.lit("0 kms")),
        stop("2", F.col("n_name"), F.col("c_nationkey").cast(S), clock, clock, F.concat(F.col("o_orderkey").cast(S), F.lit(" kms"))),
        stop("3", last, F.col("n_regionkey").cast(S), clock, F.lit("Destination"), F.lit("far")),
    )
    none = F.slice(whole, 1, 0)
    rows = df.select(
        F.lit(0).alias("file_no"), F.col("row_id").alias("pos"), F.col("o_custkey").cast(S).alias("trainNumber"),
        F.col("o_orderpriority").alias("trainName"),
        F.when(F.col("o_orderpriority") == "2-HIGH", none).otherwise(whole).alias("trainRoute"),
    )
    return last_routes(rows)


def _sides(spark, folder):
    routes, duplicates = _routes(spark, folder)
    return needed_meta(_needed(spark, folder)), routes, duplicates


def _decisions(spark, folder):
    meta, routes, duplicates = _sides(spark, folder)
    return meta, routes, duplicates, rep.match_routes(meta, routes)


def match_routes(spark, folder):
    meta, routes, _ = _sides(spark, folder)
    return rep.match_routes(meta, routes)


def _table(spark, folder):
    """The line items under the number of their supplier."""
    return stops(spark, folder).withColumn("train_no", F.col("dest_code"))


def gated_replace(spark, folder):
    _, routes, _, decisions = _decisions(spark, folder)
    new, _ = rep.replace_trains(_table(spark, folder), _needed(spark, folder), routes, decisions)
    return new.select(*BASE)


def replace_log(spark, folder):
    meta, routes, duplicates, decisions = _decisions(spark, folder)
    return rep.replace_log(_table(spark, folder), _needed(spark, folder), meta, routes, duplicates, decisions)


# ------------------------------------------------------------ distance


def _line_stops(spark, folder, train, code):
    lines = numbered(
        spark, folder, "lineitem",
        list(dict.fromkeys(["l_linenumber", "l_quantity", train, code])),
    )
    return as_stops(
        lines, train_no=F.col(train), seq=F.col("l_linenumber"), station_code=F.col(code),
        distance=F.col("l_quantity").cast("int"),
    )


def segment_median(spark, folder):
    """Suppliers as stations, line status as the train: long runs of neighbours."""
    return dist.segment_lookup(_line_stops(spark, folder, "l_linestatus", "l_suppkey"))


def _fill_inputs(spark, folder, code="l_returnflag"):
    """Open lines need a distance, finished ones have it; the flag (or the part) is the station."""
    lines = numbered(
        spark, folder, "lineitem",
        list(dict.fromkeys(["l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", code])),
    )

    def part(df, km):
        return as_stops(
            df, train_no=F.col("l_orderkey"), seq=F.col("l_linenumber"),
            station_code=F.col(code), distance=km,
        )

    needed = part(lines.where("l_linestatus = 'O'"), F.lit(None))
    known = part(lines.where("l_linestatus = 'F'"), F.col("l_quantity").cast("int"))
    lookup = dist.segment_lookup(_line_stops(spark, folder, "l_linestatus", code))
    return needed, known, lookup, dist.chained(needed, known, lookup)


def chain_log(spark, folder):
    return dist.chain_log(_fill_inputs(spark, folder)[-1])


def chain_log_gaps(spark, folder):
    """Parts as stations: thousands of pairs, most of which have no known length."""
    return dist.chain_log(_fill_inputs(spark, folder, "l_partkey")[-1])


def chain_fill(spark, folder):
    return dist.fill_distances(_fill_inputs(spark, folder)[-1]).select("row_id", "train_no", "seq", "distance", "fill_status")


def move_rows(spark, folder):
    _, known, _, chains = _fill_inputs(spark, folder)
    return dist.placed_rows(known, dist.fill_distances(chains)).select(
        "table", "train_no", "seq", "station_code", "distance"
    )


def fill_log(spark, folder):
    _, _, lookup, chains = _fill_inputs(spark, folder)
    return dist.fill_log(chains, lookup)


QUERIES = {
    f.__name__: f
    for f in (
        match_routes, gated_replace, replace_log, segment_median, chain_log, chain_log_gaps, chain_fill, move_rows, fill_log,
    )
}

# ---------------------------------------------------------------- SQL twins

_CLOCK = "lpad(CAST(CAST(strftime(o_orderdate, '%m') AS INTEGER) AS VARCHAR), 2, '0') || strftime(o_orderdate, ':%d') || ':00'"
_VIEWS = {
    "facts": """SELECT *, row_number() OVER () - 1 AS order_row FROM orders""",
    "order_facts": """SELECT * FROM facts JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
    "meta": """SELECT CAST(o_custkey AS VARCHAR) AS number,
        arg_min(CASE WHEN o_orderstatus = 'P' THEN '' ELSE c_mktsegment END, order_row) AS source_name,
        arg_min(r_name || ' JN', order_row) AS dest_name FROM order_facts GROUP BY 1""",
    "offers": f"""SELECT CAST(o_custkey AS VARCHAR) AS number, o_orderpriority AS train_name, o_orderpriority = '2-HIGH' AS bare,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority
             WHEN o_orderstatus = 'F' THEN c_mktsegment || ' CITY - Terminal' ELSE substr(c_mktsegment, 1, 5) END AS first_name,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'ASIA' ELSE r_name END AS last_name, o_orderstatus AS first_code,
        n_name, CAST(c_nationkey AS VARCHAR) AS middle_code, CAST(n_regionkey AS VARCHAR) AS last_code,
        {_CLOCK} AS clock, CAST(o_orderkey AS VARCHAR) AS km
      FROM order_facts QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY order_row DESC) = 1""",
    "ends": f"""SELECT number, bare, {endpoint_form('source_name')} AS a1, {endpoint_form('first_name')} AS b1,
        {endpoint_form('dest_name')} AS a2, {endpoint_form('last_name')} AS b2 FROM meta JOIN offers USING (number)""",
    "end_scores": f"""SELECT number, bare, CASE WHEN a1 = '' THEN 0.0 ELSE {ratio_sql('a1', 'b1')} END AS s1,
        CASE WHEN a2 = '' THEN 0.0 ELSE {ratio_sql('a2', 'b2')} END AS s2 FROM ends""",
    "decided": """SELECT number, NOT bare AND s1 >= 70 AND s2 >= 70 AS matched,
        CASE WHEN bare THEN 'empty_route_in_source' WHEN NOT (s1 >= 70 AND s2 >= 70) THEN 'endpoint_mismatch' END AS reason,
        CASE WHEN NOT bare THEN round_even(s1, 1) END AS src_score,
        CASE WHEN NOT bare THEN round_even(s2, 1) END AS dst_score FROM end_scores""",
    "accepted": "SELECT o.* FROM offers o JOIN decided USING (number) WHERE matched",
    "added": """
      SELECT number AS train_no, train_name, '1' AS seq, first_code AS station_code, first_name AS station_name, '' AS arrival,
        clock AS departure, '0' AS distance, first_code AS source_code, first_name AS source_name, last_code AS dest_code,
        last_name AS dest_name FROM accepted
      UNION ALL SELECT number, train_name, '2', middle_code, n_name, clock, clock, km, first_code, first_name, last_code, last_name FROM accepted
      UNION ALL SELECT number, train_name, '3', last_code, last_name, clock, '', '', first_code, first_name, last_code, last_name FROM accepted""",
    "table_rows": "SELECT * REPLACE (dest_code AS train_no) FROM stops",
    "kept_rows": "SELECT * FROM table_rows WHERE train_no NOT IN (SELECT number FROM decided WHERE matched)",
}


def _segments(code):
    return f"""
      SELECT least({code}, c0) AS a, greatest({code}, c0) AS b, median(km) AS km FROM (
        SELECT CAST({code} AS VARCHAR) AS {code}, CAST(lag({code}) OVER w AS VARCHAR) AS c0,
          round_even(l_quantity - lag(l_quantity) OVER w, 2) AS km,
          l_linestatus = lag(l_linestatus) OVER w AS same FROM lines WINDOW w AS (ORDER BY row_id))
      WHERE same GROUP BY 1, 2"""


_FILL = {
    "lookup": _segments("l_returnflag"),
    "route": """SELECT l_orderkey AS k, l_linenumber AS place, arg_max(l_returnflag, rank) AS code,
        CASE WHEN max(side) = 1 THEN arg_max(CAST(l_quantity AS BIGINT), rank) END AS km,
        count(*) FILTER (side = 0) AS needed_rows, max(side) AS has_known
      FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS side,
          (CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) * 100000000000 + row_id AS rank FROM lines
        WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')) GROUP BY 1, 2""",
    "placed": """SELECT k, place, pos, code, needed_rows, has_known, CASE WHEN pos = 1 THEN coalesce(km, 0) ELSE km END * 1000000 AS dist,
        CASE WHEN pos > 1 THEN least(code, before) END AS a, CASE WHEN pos > 1 THEN greatest(code, before) END AS b
      FROM (SELECT *, row_number() OVER w AS pos, lag(code) OVER w AS before FROM route WINDOW w AS (PARTITION BY k ORDER BY place))""",
    "summed": """SELECT *, sum(coalesce(step, 0)) OVER w AS upto,
        sum(CASE WHEN step IS NULL AND pos > 1 THEN 1 ELSE 0 END) OVER w AS gaps
      FROM (SELECT p.*, CAST(l.km * 1000000 AS BIGINT) AS step FROM placed p LEFT JOIN lookup l USING (a, b))
      WINDOW w AS (PARTITION BY k ORDER BY place)""",
    "anchors": """SELECT k, pos AS p1, place AS s1, dist AS d1, upto AS u1, gaps AS g1,
        lead(pos) OVER w AS p2, lead(place) OVER w AS s2, lead(dist) OVER w AS d2, lead(upto) OVER w AS u2, lead(gaps) OVER w AS g2
      FROM summed WHERE dist IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY place)""",
    "chains": """SELECT *, g1 = g2 AS complete, CASE WHEN g1 <> g2 THEN 'rejected_gap_in_segment_lookup'
        WHEN abs((u2 - u1) - (d2 - d1)) <= 3000000 THEN 'verified_and_filled' ELSE 'rejected_inconsistent' END AS status
      FROM anchors WHERE p2 - p1 > 1""",
    "places": """SELECT s.k, s.place, needed_rows, has_known,
        CASE WHEN dist IS NOT NULL THEN dist WHEN status = 'verified_and_filled' THEN d1 + upto - u1 END AS filled
      FROM summed s LEFT JOIN chains c ON c.k = s.k AND s.pos > c.p1 AND s.pos < c.p2""",
    "fills": """SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, CAST(l_linenumber AS VARCHAR) AS seq, l_returnflag,
        CASE WHEN fill_status = 'filled' THEN CAST(CAST(round_even(filled / 1000000.0::DOUBLE, 0) AS BIGINT) AS VARCHAR) END AS distance, fill_status
      FROM (SELECT *, CASE WHEN has_known = 1 THEN 'already_known' WHEN needed_rows > 1 THEN 'duplicate_seq'
          WHEN filled IS NULL THEN 'open' ELSE 'filled' END AS fill_status
        FROM lines JOIN places ON l_orderkey = k AND l_linenumber = place WHERE l_linestatus = 'O')""",
}


_GAPS = {**_FILL, "lookup": _segments("l_partkey"), "route": _FILL["route"].replace("l_returnflag", "CAST(l_partkey AS VARCHAR)")}
_CHAINS = """SELECT CAST(k AS VARCHAR) AS train_no, CAST(s1 AS VARCHAR) AS from_seq, CAST(s2 AS VARCHAR) AS to_seq, status,
          CASE WHEN complete THEN round_even((u2 - u1)::DOUBLE / 1000000, 2) END AS chain_sum,
          CASE WHEN complete THEN round_even((d2 - d1)::DOUBLE / 1000000, 2) END AS known_gap FROM chains"""


def _n(measure, source):
    return f"SELECT '{measure}' AS measure, count(*) AS value FROM {source}"


_MATCHED = "(SELECT number FROM decided WHERE matched)"
ORACLE = {
    "match_routes": sql("SELECT * FROM decided", _VIEWS),
    "gated_replace": sql(
        f"SELECT {', '.join(BASE)} FROM kept_rows UNION ALL SELECT {', '.join(BASE)} FROM added", _VIEWS
    ),
    "replace_log": sql(
        " UNION ALL ".join([
            _n("source_unique_trains", "offers"),
            "SELECT 'source_duplicate_train_numbers', (SELECT count(*) FROM order_facts) - (SELECT count(*) FROM offers)",
            _n("needed_unique_trains_before", "meta"), _n("overlap_trains_by_number", "decided"),
            _n("matched_trains_integrated", "decided WHERE matched"),
            _n("rejected_trains_endpoint_mismatch_or_empty", "decided WHERE NOT matched"),
            _n("table_rows_before", "table_rows"),
            _n("table_rows_dropped_old_fragments", f"table_rows WHERE train_no IN {_MATCHED}"),
            _n("table_rows_added_new", "added"),
            "SELECT 'table_rows_after', (SELECT count(*) FROM kept_rows) + (SELECT count(*) FROM added)",
            _n("needed_rows_before", "order_facts"),
            _n("needed_rows_dropped_resolved", f"order_facts WHERE CAST(o_custkey AS VARCHAR) IN {_MATCHED}"),
            _n("needed_rows_after", f"order_facts WHERE CAST(o_custkey AS VARCHAR) NOT IN {_MATCHED}"),
        ]),
        _VIEWS,
    ),
    "segment_median": sql(_segments("l_suppkey")),
    "chain_log": sql(_CHAINS, _FILL),
    "chain_log_gaps": sql(_CHAINS, _GAPS),
    "chain_fill": sql("SELECT row_id, train_no, seq, distance, fill_status FROM fills", _FILL),
    "move_rows": sql(
        """SELECT 'known' AS "table", CAST(l_orderkey AS VARCHAR) AS train_no, CAST(l_linenumber AS VARCHAR) AS seq,
          l_returnflag AS station_code, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS distance FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT CASE WHEN fill_status = 'filled' THEN 'known' ELSE 'needed' END, train_no, seq, l_returnflag, distance FROM fills""",
        _FILL,
    ),
    "fill_log": sql(
        " UNION ALL ".join([
            _n("segment_lookup_size", "lookup"),
            "SELECT 'trains_processed', count(DISTINCT l_orderkey) FROM lineitem WHERE l_linestatus = 'O'",
            "SELECT 'trains_with_at_least_one_fill', count(DISTINCT train_no) FROM fills WHERE fill_status = 'filled'",
            _n("rows_before", "fills"),
            "SELECT 'rows:' || fill_status, count(*) FROM fills GROUP BY 1",
            "SELECT 'chains:' || status, count(*) FROM chains GROUP BY 1",
            _n("known_rows_before", "lineitem WHERE l_linestatus = 'F'"),
            _n("known_rows_after", "lineitem LEFT JOIN (SELECT 1) ON true WHERE l_linestatus = 'F'").replace(
                "count(*) AS value", "count(*) + (SELECT count(*) FROM fills WHERE fill_status = 'filled') AS value"),
        ]),
        _FILL,
    ),
}
