"""Schedule parsing, name resolution and schedule difference queries."""

from functools import reduce

from pyspark.sql import functions as F

from checks.tables import S, as_stops, numbered, sql, table
from checks.text import common_length, plain_form
from waymend.functions.text import normalize_name
from waymend.operators import diff as d
from waymend.operators import resolve as rs
from waymend.operators import schedules as sc

# ------------------------------------------------------------ schedules


def _old(spark, folder):
    """Line items as an old schedule; returned lines have no usable SEQ."""
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"],
    )
    return as_stops(
        lines,
        train_no=F.concat(F.lit(" "), F.col("l_orderkey").cast(S)),
        train_name=F.col("l_linestatus"),
        seq=F.when(F.col("l_returnflag") == "R", F.concat(F.lit("x"), F.col("l_linenumber")))
        .otherwise(F.col("l_linenumber").cast(S)),
        station_code=F.col("l_suppkey"), station_name=F.col("l_partkey"),
        arrival=F.col("l_quantity").cast("int"), departure=F.col("l_returnflag"),
        distance=F.col("l_linestatus"), source_code=F.col("l_suppkey"), dest_code=F.col("l_partkey"),
    )


def old_schedule(spark, folder):
    return sc.old_schedule(_old(spark, folder)).select(
        "train_no", "pos", "seq", "station_code", "station_name", "arrival", "source_code"
    )


def skipped_seq_values(spark, folder):
    return sc.skipped_rows(_old(spark, folder))


def _packed(spark, folder):
    """Orders as per-train rows: nation to nation over a region and a priority."""
    orders = numbered(
        spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    joined = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
    )
    date = F.date_format("o_orderdate", "MM:dd")
    packed = F.concat(
        F.col("r_name"), F.lit("(arr="), date, F.lit(", dep = 23:59)| |"),
        F.col("o_orderpriority"), F.lit("|"), F.col("c_mktsegment"), F.lit("(dep=a=b,arr=1,arr="),
        F.col("o_orderstatus"), F.lit(",x)|"), F.lower("n_name"), F.lit("(arr=9)"),
    )
    return joined.select(
        "row_id",
        F.col("o_custkey").cast(S).alias("train_number"),
        F.col("o_orderpriority").alias("train_name"),
        F.concat(F.lit("RL "), F.col("n_name")).alias("source_station"),
        F.when(F.col("o_orderstatus") == "P", "ASIA").otherwise(F.col("c_mktsegment")).alias("destination_station"),
        date.alias("departure_time"), F.col("o_orderstatus").alias("arrival_time"),
        F.col("o_orderkey").cast(S).alias("distance"), packed.alias("intermediate_stops"),
        F.col("o_orderstatus").alias("classes"),
    )


def _stations(spark, folder):
    """Nations, regions and market segments as a station master, in a fixed order."""
    parts = [
        table(spark, folder, "nation").select(
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("code"), F.col("n_name").alias("canonical_name"),
            F.col("n_nationkey").cast("bigint").alias("ord"),
        ),
        table(spark, folder, "region").select(
            F.concat(F.lit("R"), F.col("r_regionkey")), F.col("r_name"), F.col("r_regionkey").cast("bigint") + 100
        ),
        table(spark, folder, "customer").select(
            F.lit("SEG"), F.col("c_mktsegment"), F.col("c_custkey") + 1000
        ),
    ]
    rows = reduce(lambda a, b: a.union(b), parts)
    return rows.withColumn("aliases", F.array().cast("array<string>"))


def parse_packed_stops(spark, folder):
    return sc.packed_stops(sc.packed_trains(_packed(spark, folder))).select(
        "train_no", "pos", "name", "arrival", "departure", "distance"
    )


def new_schedule(spark, folder):
    """Packed stops resolved to codes."""
    return sc.new_schedule(_packed(spark, folder), _stations(spark, folder)).select(
        "train_no", "train_name", "pos", "station_code", "station_name", "arrival", "departure",
        "distance", "source_code", "dest_code", "classes",
    )


def _rough_stations(spark, folder):
    """Nations by name, regions under longer names or as aliases, no market segments."""
    name = F.col("r_name")
    coast = name.isin("AFRICA", "AMERICA")
    regions = table(spark, folder, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey")).alias("code"),
        F.when(coast, F.concat(name, F.lit(" COAST"))).when(name == "ASIA", "FAR LAND").otherwise(name).alias("canonical_name"),
        (F.col("r_regionkey").cast("bigint") + 100).alias("ord"),
        F.when(name == "ASIA", F.array(F.lower(name))).otherwise(F.array().cast("array<string>")).alias("aliases"),
    )
    return _stations(spark, folder).where("code like 'N%'").unionByName(regions)


def new_schedule_rough(spark, folder):
    """Names found exactly, by alias, as a prefix, or not at all (UNKNOWN, shown as written)."""
    return sc.new_schedule(_packed(spark, folder), _rough_stations(spark, folder)).select(
        "train_no", "pos", "station_code", "station_name", "source_code", "dest_code", "source_name", "dest_name"
    )


def unresolved_report(spark, folder):
    return sc.unresolved_names(sc.new_schedule(_packed(spark, folder), _rough_stations(spark, folder)))


# ------------------------------------------------------------ resolution


def _part_master(spark, folder):
    parts = table(spark, folder, "part")
    return parts.select(
        F.col("p_partkey").cast(S).alias("code"), F.col("p_name").alias("canonical_name"),
        F.array(F.concat("p_brand", F.lit(" "), F.lower("p_type")), F.col("p_type")).alias("aliases"),
        F.col("p_partkey").alias("ord"),
    )


def _customer_master(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast(S).alias("code"), F.col("c_name").alias("canonical_name"),
        F.array().cast("array<string>").alias("aliases"), F.col("c_custkey").alias("ord"),
    )


def _names(spark, folder):
    """Names of every kind in the tables, as written."""
    parts = table(spark, folder, "part")
    words = [
        parts.select(F.upper("p_name").alias("name")),
        parts.select(F.concat("p_brand", F.lit("  "), F.col("p_type"))),
        parts.select("p_type"),
        table(spark, folder, "events").select("event_type"),
        table(spark, folder, "customer").select("c_mktsegment"),
    ]
    return reduce(lambda a, b: a.union(b), words).distinct()


def _queries(df):
    return df.select(normalize_name("name").alias("query")).where("query <> ''").distinct()


def resolve_exact(spark, folder):
    return rs.resolve_exact(_queries(_names(spark, folder)), _part_master(spark, folder))


def resolve_alias(spark, folder):
    return rs.resolve_alias(_queries(_names(spark, folder)), _part_master(spark, folder))


def resolve_prefix(spark, folder):
    """Customer names with an order's priority behind them, and customer names cut short."""
    orders = table(spark, folder, "orders")
    full = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast(S), 9, "0"))
    longer = orders.select(F.concat(full, F.lit(" "), F.col("o_orderpriority")).alias("name"))
    cut = table(spark, folder, "customer").select(F.substring("c_name", 1, 17).alias("name"))
    return rs.resolve_prefix(_queries(longer.union(cut)), _customer_master(spark, folder))


def resolve_codes(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_suppkey").cast(S).alias("code")).distinct()
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").cast(S).alias("code"), F.col("s_name").alias("canonical_name"),
        F.array().cast("array<string>").alias("aliases"), F.col("s_suppkey").alias("ord"),
    )
    return rs.resolve_codes(lines, suppliers).select("code", "canonical_name")


def resolve_names(spark, folder):
    """The whole cascade over all names of the tables."""
    out = rs.resolve_names(_names(spark, folder), _part_master(spark, folder))
    return out.withColumn("suggestions", F.array_join("suggestions", "; "))


def suggest_top5(spark, folder):
    """Five closest part names of every event type, segment and region."""
    names = reduce(
        lambda a, b: a.union(b),
        [
            table(spark, folder, "events").select(F.col("event_type").alias("name")),
            table(spark, folder, "customer").select("c_mktsegment"),
            table(spark, folder, "region").select("r_name"),
        ],
    )
    canonical = rs.canonical_names(_part_master(spark, folder))
    best = rs.closest_names(_queries(names.distinct()), canonical)
    shown = best.join(canonical.select("first_ord", "canonical_name"), "first_ord")
    return shown.select("query", "rank", "canonical_name", F.round("score", 6).alias("score"))


# ------------------------------------------------------------ difference


def _flat(df, name, code, arrival, departure, distance, source, dest, key):
    """Line items as numbered stops of a schedule."""
    return sc.old_schedule(
        as_stops(
            df, train_no=key, train_name=name, seq=F.col("l_linenumber"), station_code=code,
            station_name=code, arrival=arrival, departure=departure, distance=distance,
            source_code=source, dest_code=dest,
        )
    )


def _two_schedules(spark, folder):
    """The same line items; orders differ by status, priority, date and line flags."""
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_discount"],
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    df = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    key, code = F.col("l_orderkey").cast(S), F.col("l_suppkey").cast(S)
    quantity = F.col("l_quantity").cast("int").cast(S)
    high = F.col("l_discount") > 0.08
    urgent = F.col("o_orderpriority") == "1-URGENT"
    old = _flat(
        df, F.col("o_orderstatus"), code, quantity, F.col("l_returnflag"), quantity,
        F.col("o_custkey"), F.col("o_custkey"), key,
    )
    new = _flat(
        df.where("not (l_returnflag = 'R' and l_linestatus = 'O' and l_discount > 0.09)"),
        F.when(urgent, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus")),
        F.when(high & (F.col("l_returnflag") == "A"), F.lit("S")).otherwise(code),
        F.when(high & (F.col("l_linestatus") == "O"), F.lit("First")).otherwise(quantity),
        F.when(high & (F.col("l_returnflag") == "N"), F.lit("LAST")).otherwise(F.col("l_returnflag")),
        F.when(high, F.when(F.col("l_linestatus") == "F", F.lit("9")).otherwise(F.lit(""))).otherwise(quantity),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2")).otherwise(F.col("o_custkey").cast(S)),
        F.when(urgent, F.lit("1")).otherwise(F.col("o_custkey").cast(S)),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("P"), key)).otherwise(key),
    )
    return old, new


def schedule_status(spark, folder):
    status = d.schedule_status(*_two_schedules(spark, folder))
    return status.select("train_no", "status", F.array_join("changes", ", ").alias("changes"))


def status_totals(spark, folder):
    return d.status_totals(d.schedule_status(*_two_schedules(spark, folder)))


def import_rows(spark, folder):
    old, new = _two_schedules(spark, folder)
    full = d.with_stop_ends(new).withColumns({"classes": F.lit(""), "running_days": F.lit("")})
    return d.import_rows(full, d.schedule_status(old, new))


QUERIES = {
    f.__name__: f
    for f in (
        old_schedule, skipped_seq_values, parse_packed_stops, new_schedule, new_schedule_rough, unresolved_report, resolve_exact, resolve_alias,
        resolve_prefix, resolve_codes, resolve_names, suggest_top5, schedule_status, status_totals, import_rows,
    )
}

# ---------------------------------------------------------------- SQL twins

_VIEWS = {
    "old_rows": """SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, l_linenumber, l_returnflag,
        CASE WHEN l_returnflag = 'R' THEN 'x' || l_linenumber ELSE CAST(l_linenumber AS VARCHAR) END AS seq,
        CAST(l_suppkey AS VARCHAR) AS station_code, CAST(l_partkey AS VARCHAR) AS station_name,
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS arrival FROM lines""",
    "order_rows": "SELECT *, row_number() OVER () - 1 AS order_row FROM orders",
    "trips": """SELECT CAST(o_custkey AS VARCHAR) AS train_no, o_orderpriority AS train_name, 'RL ' || n_name AS source,
        CASE WHEN o_orderstatus = 'P' THEN 'ASIA' ELSE c_mktsegment END AS destination,
        strftime(o_orderdate, '%m:%d') AS departure, o_orderstatus, CAST(o_orderkey AS VARCHAR) AS distance,
        n_name, r_name, c_mktsegment
      FROM order_rows JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY order_row DESC) = 1""",
    # The item named after the nation equals the source without its mark and always goes.
    "trip_stops": """
      SELECT *, row_number() OVER (PARTITION BY train_no ORDER BY place) - 1 AS pos FROM (
        SELECT train_no, 1 AS place, source AS name, '' AS arrival, departure, '' AS distance FROM trips
        UNION ALL SELECT train_no, 2, r_name, departure, '23:59', '' FROM trips WHERE lower(r_name) <> lower(destination)
        UNION ALL SELECT train_no, 3, c_mktsegment, o_orderstatus, 'a=b', '' FROM trips
          WHERE lower(c_mktsegment) <> lower(destination)
        UNION ALL SELECT train_no, 5, destination, o_orderstatus, '', distance FROM trips)""",
    "stations": """SELECT 'N' || n_nationkey AS code, n_name AS name FROM nation
        UNION ALL SELECT 'R' || r_regionkey, r_name FROM region
        UNION ALL SELECT DISTINCT 'SEG', c_mktsegment FROM customer""",
    "names": """SELECT upper(p_name) AS name FROM part UNION SELECT p_brand || '  ' || p_type FROM part
        UNION SELECT p_type FROM part UNION SELECT event_type FROM events UNION SELECT c_mktsegment FROM customer""",
    "name_queries": f"SELECT DISTINCT {plain_form('name')} AS query FROM names",
    "long_names": """SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' ' || o_orderpriority AS name FROM orders
        UNION SELECT substr(c_name, 1, 17) FROM customer""",
    "long_queries": f"SELECT DISTINCT {plain_form('name')} AS query FROM long_names",
    "flat": """SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(l_suppkey AS VARCHAR) AS code,
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, l_discount > 0.08 AS high, o_orderpriority = '1-URGENT' AS urgent,
        CAST(o_custkey AS VARCHAR) AS cust, l_linenumber, l_returnflag, l_linestatus, l_discount, o_orderstatus,
        o_orderpriority, row_id FROM lines JOIN orders ON l_orderkey = o_orderkey""",
    "old_flat": """SELECT k AS train_no, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, row_id) - 1 AS pos,
        l_linenumber AS seq, o_orderstatus AS train_name, code, q AS arrival, l_returnflag AS departure, q AS distance,
        cust AS source, cust AS dest FROM flat""",
    "new_rows": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'P' || k ELSE k END AS train_no, l_linenumber AS seq, row_id,
        CASE WHEN urgent THEN o_orderpriority ELSE o_orderstatus END AS train_name,
        CASE WHEN high AND l_returnflag = 'A' THEN 'S' ELSE code END AS code,
        CASE WHEN high AND l_linestatus = 'O' THEN 'First' ELSE q END AS arrival,
        CASE WHEN high AND l_returnflag = 'N' THEN 'LAST' ELSE l_returnflag END AS departure,
        CASE WHEN high AND l_linestatus = 'F' THEN '9' WHEN high THEN '' ELSE q END AS distance,
        CASE WHEN o_orderpriority = '5-LOW' THEN '2' ELSE cust END AS source, CASE WHEN urgent THEN '1' ELSE cust END AS dest
      FROM flat WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount > 0.09)""",
    "new_flat": "SELECT *, row_number() OVER (PARTITION BY train_no ORDER BY seq, row_id) - 1 AS pos FROM new_rows",
    "old_heads": """SELECT train_no, count(*) AS n, arg_min(train_name, pos) AS name, arg_min(source, pos) AS source,
        arg_min(dest, pos) AS dest FROM old_flat GROUP BY 1""",
    "new_heads": """SELECT train_no, count(*) AS n, arg_min(train_name, pos) AS name, arg_min(source, pos) AS source,
        arg_min(dest, pos) AS dest FROM new_flat GROUP BY 1""",
    "kinds": """
      SELECT o.train_no, -1 AS pos, 0 AS rank, 'TRAIN_NAME' AS kind FROM old_heads o JOIN new_heads w USING (train_no) WHERE o.name <> w.name
      UNION ALL SELECT o.train_no, -1, 1, 'SOURCE' FROM old_heads o JOIN new_heads w USING (train_no) WHERE o.source <> w.source
      UNION ALL SELECT o.train_no, -1, 2, 'DESTINATION' FROM old_heads o JOIN new_heads w USING (train_no) WHERE o.dest <> w.dest
      UNION ALL SELECT o.train_no, -1, 3, 'STOP_COUNT' FROM old_heads o JOIN new_heads w USING (train_no) WHERE o.n <> w.n
      UNION ALL SELECT o.train_no, min(pos), 4, 'ROUTE' FROM old_flat o JOIN new_flat w USING (train_no, pos) WHERE o.code <> w.code GROUP BY 1
      UNION ALL SELECT o.train_no, min(pos), 5, 'ARRIVAL' FROM old_flat o JOIN new_flat w USING (train_no, pos) WHERE o.arrival <> w.arrival GROUP BY 1
      UNION ALL SELECT o.train_no, min(pos), 6, 'DEPARTURE' FROM old_flat o JOIN new_flat w USING (train_no, pos) WHERE o.departure <> w.departure GROUP BY 1
      UNION ALL SELECT o.train_no, min(pos), 7, 'DISTANCE' FROM old_flat o JOIN new_flat w USING (train_no, pos)
        WHERE o.distance <> w.distance AND o.distance <> '' AND w.distance <> '' GROUP BY 1""",
    "statuses": """SELECT train_no, CASE WHEN o.train_no IS NULL THEN 'new' WHEN w.train_no IS NULL THEN 'missing'
          WHEN c.changes IS NULL THEN 'unchanged' ELSE 'updated' END AS status, coalesce(c.changes, '') AS changes
      FROM old_heads o FULL JOIN new_heads w USING (train_no)
      LEFT JOIN (SELECT train_no, string_agg(kind, ', ' ORDER BY pos, rank) AS changes FROM kinds GROUP BY 1) c USING (train_no)""",
}

# Weighted similarity of every (a, b) in a table ``asked_pairs``, written from its definition.
_LENGTHS = "length(x) + length(y)"
_WEIGHTED = {
    "prepared": """SELECT DISTINCT t, list_filter(string_split(t, ' '), lambda w: w <> '') AS w FROM (SELECT a AS t FROM asked_pairs UNION SELECT b FROM asked_pairs)""",
    "words_of": """SELECT t, array_to_string(list_sort(w), ' ') AS ordered, array_to_string(list_sort(list_distinct(w)), ' ') AS single,
        list_distinct(w) AS ws FROM prepared""",
    "facts_of": """SELECT a, b, p.ordered AS ao, q.ordered AS bo, p.single AS au, q.single AS bu,
        array_to_string(list_sort(list_filter(p.ws, lambda w: list_contains(q.ws, w))), ' ') AS both_words,
        array_to_string(list_sort(list_filter(p.ws, lambda w: NOT list_contains(q.ws, w))), ' ') AS rest_a,
        array_to_string(list_sort(list_filter(q.ws, lambda w: NOT list_contains(p.ws, w))), ' ') AS rest_b,
        greatest(length(a), length(b))::DOUBLE / least(length(a), length(b)) AS stretch
      FROM asked_pairs JOIN words_of p ON p.t = a JOIN words_of q ON q.t = b""",
    "scaled": """SELECT *, length(both_words) AS base, CASE WHEN stretch <= 8 THEN 0.9 ELSE 0.6 END::DOUBLE AS far_scale FROM facts_of""",
    "far_texts": """SELECT a, b, a AS s, b AS l, far_scale AS w FROM scaled WHERE stretch >= 1.5
      UNION ALL SELECT a, b, ao, bo, 0.95::DOUBLE * far_scale FROM scaled WHERE stretch >= 1.5 AND base = 0
      UNION ALL SELECT a, b, au, bu, 0.95::DOUBLE * far_scale FROM scaled WHERE stretch >= 1.5 AND base = 0 AND (ao <> au OR bo <> bu)""",
    "ways": """SELECT a, b, CASE WHEN length(s) <= length(l) THEN s ELSE l END AS s, CASE WHEN length(s) <= length(l) THEN l ELSE s END AS l, w FROM far_texts
      UNION ALL SELECT a, b, l, s, w FROM far_texts WHERE length(s) = length(l)""",
    "cuts": """SELECT a, b, s, l, w, unnest(range(1 - length(s), length(l))) AS k FROM ways""",
    "comparisons": """SELECT a, b, a AS x, b AS y, 0 AS more, 1.0::DOUBLE AS w FROM scaled
      UNION ALL SELECT a, b, ao, bo, 0, 0.95 FROM scaled WHERE stretch < 1.5
      UNION ALL SELECT a, b, rest_a, rest_b, CASE WHEN base > 0 THEN 2 * (base + 1) ELSE 0 END, 0.95 FROM scaled WHERE stretch < 1.5
      UNION ALL SELECT a, b, s, substr(l, greatest(k, 0) + 1, least(k + length(s), length(l)) - greatest(k, 0)), 0, w FROM cuts""",
    "compared": f"""SELECT a, b, max(w * CASE WHEN {_LENGTHS} + more = 0 THEN 100.0
        ELSE (1.0::DOUBLE - ({_LENGTHS} - 2 * CASE WHEN length(x) = 0 OR length(y) = 0 THEN 0 ELSE {common_length('x', 'y')} END)::DOUBLE / ({_LENGTHS} + more)) * 100 END) AS best
      FROM comparisons GROUP BY 1, 2""",
    "scores_of": """SELECT a, b, round(greatest(best, CASE WHEN base = 0 THEN 0.0 WHEN stretch >= 1.5 THEN 100.0 * 0.95::DOUBLE * far_scale
        WHEN rest_a = '' OR rest_b = '' THEN 0.95::DOUBLE * 100.0 ELSE 0.95::DOUBLE * greatest(
          100.0 - 100.0 * (1 + length(rest_a))::DOUBLE / (2 * base + 1 + length(rest_a)),
          100.0 - 100.0 * (1 + length(rest_b))::DOUBLE / (2 * base + 1 + length(rest_b))) END), 9) AS score
      FROM compared JOIN scaled USING (a, b)""",
    "ranked_names": """SELECT a AS query, row_number() OVER (PARTITION BY a ORDER BY score DESC, first_ord) AS rank, score, code, canonical_name
      FROM scores_of JOIN part_names ON b = name""",
}
_PART_NAMES = f"""SELECT {plain_form('p_name')} AS name, min(p_partkey) AS first_ord, CAST(max(p_partkey) AS VARCHAR) AS code,
    arg_max(p_name, p_partkey) AS canonical_name FROM part GROUP BY 1"""
_SUGGEST = {
    **_VIEWS, "part_names": _PART_NAMES,
    "asked_names": f"""SELECT DISTINCT {plain_form('n')} AS a FROM (SELECT event_type AS n FROM events UNION SELECT c_mktsegment FROM customer UNION SELECT r_name FROM region)""",
    "asked_pairs": "SELECT a, name AS b FROM asked_names, part_names WHERE a <> '' AND name <> ''",
    **_WEIGHTED,
}
_CASCADE = {
    **_VIEWS, "part_names": _PART_NAMES,
    "written": f"""SELECT n AS name, {plain_form('n')} AS query FROM (SELECT upper(p_name) AS n FROM part UNION SELECT p_brand || '  ' || p_type FROM part
        UNION SELECT p_type FROM part UNION SELECT event_type FROM events UNION SELECT c_mktsegment FROM customer)""",
    "aliases": f"""SELECT query, CAST(k AS VARCHAR) AS code, p_name AS canonical_name FROM (SELECT query, max(p_partkey) AS k FROM (
        SELECT {plain_form("p_brand || ' ' || lower(p_type)")} AS query, p_partkey FROM part UNION ALL SELECT {plain_form('p_type')}, p_partkey FROM part)
        GROUP BY 1) JOIN part ON p_partkey = k""",
    "begun": f"""SELECT query, min(CAST(p_partkey AS VARCHAR)) AS code, min(p_name) AS canonical_name FROM (SELECT DISTINCT query FROM written WHERE query <> '')
        JOIN (SELECT *, {plain_form('p_name')} AS name FROM part) ON starts_with(query, name) OR starts_with(name, query) GROUP BY 1 HAVING count(*) = 1""",
    "asked_pairs": """SELECT query AS a, name AS b FROM (SELECT DISTINCT query FROM written WHERE query <> '' AND query NOT IN (SELECT name FROM part_names)
        AND query NOT IN (SELECT query FROM aliases) AND query NOT IN (SELECT query FROM begun)), part_names WHERE name <> ''""",
    **_WEIGHTED,
    "top_names": """SELECT query, max(CASE WHEN rank = 1 THEN score END) AS score, max(CASE WHEN rank = 1 THEN code END) AS code,
        max(CASE WHEN rank = 1 THEN canonical_name END) AS canonical_name, string_agg(canonical_name, '; ' ORDER BY rank) AS names
      FROM ranked_names WHERE rank <= 5 GROUP BY 1""",
}

_ROUGH = {
    **_VIEWS,
    "rough": """SELECT 'N' || n_nationkey AS code, n_name AS name, n_name AS shown FROM nation UNION ALL
      SELECT 'R' || r_regionkey, r_name, CASE WHEN r_name IN ('AFRICA', 'AMERICA') THEN r_name || ' COAST'
        WHEN r_name = 'ASIA' THEN 'FAR LAND' ELSE r_name END FROM region""",
    "rough_stops": """SELECT s.*, coalesce(a.code, 'UNKNOWN') AS station_code, coalesce(a.shown, s.name) AS station_name
      FROM trip_stops s LEFT JOIN rough a ON a.name = replace(s.name, 'RL ', '')""",
}

ORACLE = {
    "suggest_top5": sql("SELECT query, CAST(rank AS INTEGER) AS rank, canonical_name, round(score, 6) AS score FROM ranked_names WHERE rank <= 5", _SUGGEST),
    "resolve_names": sql(
        """SELECT w.name, coalesce(e.code, l.code, p.code, CASE WHEN t.score >= 80 THEN t.code END, '') AS station_code,
          coalesce(e.canonical_name, l.canonical_name, p.canonical_name, CASE WHEN t.score >= 80 THEN t.canonical_name END, '') AS canonical_name,
          CASE WHEN e.code IS NOT NULL THEN 'EXACT' WHEN l.code IS NOT NULL THEN 'ALIAS' WHEN p.code IS NOT NULL THEN 'PREFIX'
            WHEN t.score >= 80 THEN 'FUZZY' ELSE '' END AS method,
          CASE WHEN coalesce(e.code, l.code, p.code) IS NOT NULL THEN 100.0 WHEN t.score >= 80 THEN round_even(t.score, 2) ELSE 0.0 END::DOUBLE AS confidence,
          coalesce(e.code, l.code, p.code) IS NOT NULL OR coalesce(t.score >= 80, false) AS matched,
          CASE WHEN t.score < 80 THEN t.names END AS suggestions
        FROM written w LEFT JOIN part_names e ON e.name = w.query LEFT JOIN aliases l USING (query) LEFT JOIN begun p USING (query)
        LEFT JOIN top_names t USING (query)""",
        _CASCADE,
    ),
    "new_schedule_rough": sql(
        """SELECT s.train_no, s.pos, s.station_code, s.station_name, coalesce(b.code, 'UNKNOWN') AS source_code,
          coalesce(c.code, 'UNKNOWN') AS dest_code, coalesce(b.shown, 'RL ' || t.n_name) AS source_name, coalesce(c.shown, t.destination) AS dest_name
        FROM rough_stops s JOIN trips t USING (train_no) LEFT JOIN rough b ON b.name = t.n_name LEFT JOIN rough c ON c.name = t.destination""",
        _ROUGH,
    ),
    "unresolved_report": sql("""SELECT DISTINCT name AS "Station" FROM rough_stops WHERE station_code = 'UNKNOWN'""", _ROUGH),
    "old_schedule": sql(
        """SELECT train_no, row_number() OVER (PARTITION BY train_no ORDER BY l_linenumber, row_id) - 1 AS pos,
          CAST(l_linenumber AS VARCHAR) AS seq, station_code, station_name, arrival, station_code AS source_code
        FROM old_rows WHERE l_returnflag <> 'R'""",
        _VIEWS,
    ),
    "skipped_seq_values": sql(
        """SELECT seq, sum(n)::BIGINT AS rows, count(*) AS trains,
          string_agg(train_no, ', ' ORDER BY train_no) FILTER (place <= 5) AS first_trains
        FROM (SELECT seq, train_no, count(*) AS n, row_number() OVER (PARTITION BY seq ORDER BY train_no) AS place
          FROM old_rows WHERE l_returnflag = 'R' GROUP BY 1, 2) GROUP BY 1""",
        _VIEWS,
    ),
    "parse_packed_stops": sql("SELECT train_no, pos, name, arrival, departure, distance FROM trip_stops", _VIEWS),
    "new_schedule": sql(
        """SELECT s.train_no, t.train_name, s.pos, a.code AS station_code, a.name AS station_name, s.arrival, s.departure,
          s.distance, b.code AS source_code, c.code AS dest_code, t.o_orderstatus AS classes
        FROM trip_stops s JOIN trips t USING (train_no) JOIN stations a ON a.name = replace(s.name, 'RL ', '')
        JOIN stations b ON b.name = t.n_name JOIN stations c ON c.name = t.destination""",
        _VIEWS,
    ),
    "resolve_exact": sql(
        f"""SELECT query, code, canonical_name FROM name_queries JOIN (SELECT {plain_form('p_name')} AS query,
          CAST(arg_max(p_partkey, p_partkey) AS VARCHAR) AS code, arg_max(p_name, p_partkey) AS canonical_name
          FROM part GROUP BY 1) USING (query)""",
        _VIEWS,
    ),
    "resolve_alias": sql(
        f"""SELECT query, CAST(k AS VARCHAR) AS code, p_name AS canonical_name FROM name_queries JOIN (
          SELECT query, max(p_partkey) AS k FROM (SELECT {plain_form("p_brand || ' ' || lower(p_type)")} AS query, p_partkey FROM part
            UNION ALL SELECT {plain_form('p_type')}, p_partkey FROM part) GROUP BY 1) USING (query)
          JOIN part ON p_partkey = k""",
        _VIEWS,
    ),
    "resolve_prefix": sql(
        f"""SELECT query, min(code) AS code, min(c_name) AS canonical_name FROM long_queries JOIN
          (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name, {plain_form('c_name')} AS name FROM customer)
          ON starts_with(query, name) OR starts_with(name, query) GROUP BY 1 HAVING count(*) = 1""",
        _VIEWS,
    ),
    "resolve_codes": """SELECT CAST(l_suppkey AS VARCHAR) AS code, arg_max(s_name, s_suppkey) AS canonical_name
        FROM (SELECT DISTINCT l_suppkey FROM lineitem) LEFT JOIN supplier ON s_nationkey = l_suppkey GROUP BY 1""",
    "schedule_status": sql("SELECT * FROM statuses", _VIEWS),
    "status_totals": sql("SELECT status, count(*) AS n FROM statuses GROUP BY 1", _VIEWS),
    "import_rows": sql(
        """SELECT w.train_no AS "Train No", train_name AS "Train Name", CAST(seq AS VARCHAR) AS "SEQ", code AS "Station Code",
          code AS "Station Name", CASE WHEN lower(arrival) = 'first' THEN '' ELSE arrival END AS "Arrival Time",
          CASE WHEN lower(departure) = 'last' THEN '' ELSE departure END AS "Departure Time", distance AS "Distance",
          a AS "Source Station", a AS "Source Station Name", b AS "Destination Station", b AS "Destination Station Name",
          '' AS "Classes", '' AS "Running Days"
        FROM new_flat w JOIN statuses USING (train_no)
        JOIN (SELECT train_no, arg_min(code, pos) AS a, arg_max(code, pos) AS b FROM new_flat GROUP BY 1) USING (train_no)
        WHERE status IN ('new', 'updated')""",
        _VIEWS,
    ),
}
