"""Validation, cross-reference, repair and suggestion queries."""

from pyspark.sql import functions as F

from checks.tables import S, as_stops, numbered, sql, stops, table
from checks.text import reference_form
from waymend.functions import fixed_values as fv
from waymend.operators import crossref as x
from waymend.operators import repair as r
from waymend.operators import validate as v
from waymend.roles import BASE


def _per_stop(spark, folder):
    """Line items under per-stop headers; open lines have no code."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        F.col("l_orderkey").cast(S).alias("Train No"),
        F.col("l_linenumber").cast(S).alias("SEQ"),
        F.when(F.col("l_linestatus") == "O", " ").otherwise(F.col("l_returnflag")).alias("Station Code"),
    )


def _per_train(spark, folder):
    """Orders under per-train headers; the packed text has up to three stops."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_custkey").cast(S).alias("train_number"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("source_station"),
        F.col("o_orderstatus").alias("destination_station"),
        F.replace("o_orderpriority", F.lit("-"), F.lit("|")).alias("intermediate_stops"),
    )


def validate_stops(spark, folder):
    return v.statistics(_per_stop(spark, folder))


def validate_trains(spark, folder):
    return v.statistics(_per_train(spark, folder))


def quality_score(spark, folder):
    """Score, grade and deductions of both layouts."""
    parts = []
    for label, df in (("stops", _per_stop(spark, folder)), ("trains", _per_train(spark, folder))):
        report = v.validate(df, label)
        parts.append(
            report.select(
                "label", "shape", "total_rows", F.col("quality_score.score").alias("score"),
                F.col("quality_score.grade").alias("grade"),
                F.array_join(
                    F.transform("quality_score.deductions", lambda d: d["points"].cast(S)), ","
                ).alias("points"),
                F.size("warnings").cast("bigint").alias("warnings"),
            )
        )
    return parts[0].unionByName(parts[1])


def _references(spark, folder):
    """Reference lists made from the parts: complete, cut, other or missing names by size."""
    parts = table(spark, folder, "part")
    size = F.col("p_size")
    name = (
        F.when(size <= 10, F.upper("p_name")).when(size <= 20, F.concat("p_name", F.lit(" junction")))
        .when(size <= 25, F.col("p_type"))
    )
    primary = parts.where(size <= 30).select(
        F.col("p_partkey").cast(S).alias("code"), name.alias("name"),
        F.col("p_brand").alias("state"), F.col("p_type").alias("zone"),
    )
    one = parts.where((size > 30) & (size <= 40)).select(
        F.col("p_partkey").cast(S).alias("code"),
        F.when(size <= 35, F.substring("p_name", 1, 4)).otherwise(F.col("p_brand")).alias("name"),
    )
    two = parts.where((size > 38) & (size <= 40)).select(
        F.col("p_partkey").cast(S).alias("code"), F.concat("p_name", F.lit(" Town")).alias("name")
    )
    return primary, one.unionByName(two)


def station_crossref(spark, folder):
    primary, secondary = _references(spark, folder)
    return x.station_crossref(stops(spark, folder), primary, secondary)


def secondary_names(spark, folder):
    return x.secondary_names(stops(spark, folder), _references(spark, folder)[1])


def crossref_status_counts(spark, folder):
    return x.status_counts(station_crossref(spark, folder))


def enrich(spark, folder):
    rows = stops(spark, folder)
    primary, secondary = _references(spark, folder)
    enriched = x.enrich(rows, x.station_crossref(rows, primary, secondary))
    return enriched.select("row_id", "station_code", "validation_status", "reference_name")


def _train_numbers(spark, folder):
    orders = numbered(spark, folder, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    number = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("K"), F.col("o_orderkey"))).otherwise(
        F.lpad(F.col("o_orderkey").cast(S), 8, "0")
    )
    return as_stops(orders, train_no=number, train_name=F.col("o_orderpriority"))


def train_crossref(spark, folder):
    customers = table(spark, folder, "customer")
    reference = customers.select(
        F.col("c_custkey").cast(S).alias("number_key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("zone"), F.col("c_nationkey").cast(S).alias("from_code"),
        F.lit(None).cast(S).alias("to_code"),
    )
    return x.train_crossref(_train_numbers(spark, folder), reference)


def _torn_rows(spark, folder):
    """Line items in file order: returned ones are split-off pieces, open ones lack a tail."""
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"],
    )
    piece, open_ = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    tail = {
        "arrival": F.col("l_quantity").cast("int").cast(S), "departure": F.col("l_linenumber").cast(S),
        "distance": F.col("l_partkey").cast(S), "source_code": F.col("l_suppkey").cast(S),
        "source_name": F.col("l_linestatus"), "dest_code": F.col("l_suppkey").cast(S),
        "dest_name": F.col("l_returnflag"),
    }
    return as_stops(
        lines,
        train_no=F.when(piece, F.lit("K")).otherwise(F.col("l_orderkey").cast(S)),
        train_name=F.col("l_returnflag"), seq=F.col("l_linenumber"),
        station_code=F.col("l_partkey"), station_name=F.col("l_suppkey"),
        **{c: F.when(open_, F.when(piece, F.lit(" na ")) if c != "distance" else F.lit("NA")).otherwise(e)
           for c, e in tail.items()},
    )


def split_row_repair(spark, folder):
    return r.repair_split_rows(_torn_rows(spark, folder)).select("row_id", *BASE)


def repair_log(spark, folder):
    return r.repair_log(_torn_rows(spark, folder))


def repair_changes(spark, folder):
    return r.repair_changes(_torn_rows(spark, folder))


def adjacent_duplicates(spark, folder):
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_discount"],
    )
    rows = as_stops(
        lines,
        train_no=F.col("l_orderkey"), seq=F.col("l_linenumber"), station_code=F.col("l_returnflag"),
        arrival=F.when(F.col("l_discount") > 0.03, F.col("l_linestatus")),
        departure=F.when(F.col("l_discount") > 0.07, F.lit("late")),
        distance=F.when(F.col("l_quantity") > 40, F.lit("far")),
    )
    kept = r.merge_adjacent_duplicates(rows)
    return kept.select("row_id", "train_no", "seq", "arrival", "departure", "distance", "adjacent_kind")


def code_suggestion(spark, folder):
    """One-letter codes of customer names; customers in debt share one reference name."""
    orders = numbered(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast(S), 9, "0"))
    rows = as_stops(
        orders, train_no=F.col("o_orderkey"), station_name=name,
        station_code=F.when(F.col("o_orderstatus") == "P", F.lit("X")).otherwise(F.lit("C")),
    )
    reference = table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit("Customer#000000001")).otherwise(F.col("c_name")).alias("name"),
        F.concat("c_mktsegment", F.lit("/"), F.col("c_custkey")).alias("code"),
    )
    return r.suggest_codes(rows, reference).select("row_id", "station_code", "code_suggestion")


QUERIES = {
    f.__name__: f
    for f in (
        validate_stops, validate_trains, quality_score, station_crossref, secondary_names, crossref_status_counts,
        enrich, train_crossref, split_row_repair, repair_log, repair_changes, adjacent_duplicates, code_suggestion,
    )
}

# ---------------------------------------------------------------- SQL twins

_VIEWS = {
    "per_stop": """SELECT CAST(l_orderkey AS VARCHAR) AS t, CAST(l_linenumber AS VARCHAR) AS q,
      CASE WHEN l_linestatus = 'O' THEN ' ' ELSE l_returnflag END AS c FROM lineitem""",
    "per_train": """SELECT CAST(o_custkey AS VARCHAR) AS t,
      CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS a, o_orderstatus AS b,
      replace(o_orderpriority, '-', '|') AS m FROM orders""",
    "stop_numbers": """
      SELECT (SELECT count(*) FROM per_stop)::DOUBLE AS total,
        (SELECT count(*) FROM per_stop WHERE trim(t) = '')::DOUBLE AS blank1,
        (SELECT count(*) FROM per_stop WHERE trim(c) = '')::DOUBLE AS blank2,
        (SELECT count(*) FROM per_stop WHERE trim(q) = '')::DOUBLE AS blank3,
        ((SELECT count(*) FROM per_stop) - (SELECT count(*) FROM (SELECT DISTINCT * FROM per_stop)))::DOUBLE AS copies,
        ((SELECT count(*) FROM per_stop) - (SELECT count(*) FROM (SELECT DISTINCT t, q FROM per_stop)))::DOUBLE AS clashes""",
    "train_numbers": """
      SELECT (SELECT count(*) FROM per_train)::DOUBLE AS total, 0::DOUBLE AS blank1,
        (SELECT count(*) FROM per_train WHERE trim(a) = '')::DOUBLE AS blank2,
        (SELECT count(*) FROM per_train WHERE trim(b) = '')::DOUBLE AS blank3,
        ((SELECT count(*) FROM per_train) - (SELECT count(*) FROM (SELECT DISTINCT * FROM per_train)))::DOUBLE AS copies,
        ((SELECT count(*) FROM per_train) - (SELECT count(DISTINCT t) FROM per_train))::DOUBLE AS clashes""",
    "primary_ref": """SELECT CAST(p_partkey AS VARCHAR) AS code,
      CASE WHEN p_size <= 10 THEN upper(p_name) WHEN p_size <= 20 THEN p_name || ' junction'
           WHEN p_size <= 25 THEN p_type END AS name, p_brand AS state, p_type AS zone
      FROM part WHERE p_size <= 30""",
    "secondary_ref": """SELECT CAST(p_partkey AS VARCHAR) AS code,
        CASE WHEN p_size <= 35 THEN substr(p_name, 1, 4) ELSE p_brand END AS name
      FROM part WHERE p_size > 30 AND p_size <= 40
      UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name || ' Town' FROM part WHERE p_size > 38 AND p_size <= 40""",
    "crossed": f"""
      SELECT station_code, station_name AS station_name_in_dataset, p.code IS NOT NULL AS found_in_primary_reference,
        p.name AS reference_name, p.state AS reference_state, p.zone AS reference_zone,
        {reference_form('station_name')} = {reference_form('p.name')} AS name_match,
        CASE WHEN p.code IS NULL THEN s.hit IS NOT NULL END AS found_in_secondary_reference,
        CASE WHEN p.code IS NULL THEN s.names END AS secondary_names_for_code,
        CASE WHEN p.code IS NOT NULL AND {reference_form('station_name')} = {reference_form('p.name')} THEN '{fv.VERIFIED}'
          WHEN p.code IS NOT NULL AND length(station_name) >= 12
            AND starts_with(upper(p.name), upper(station_name)) THEN '{fv.TRUNCATED}'
          WHEN p.code IS NOT NULL THEN '{fv.NAME_MISMATCH}'
          WHEN s.hit THEN '{fv.SECONDARY_ONLY}' WHEN NOT s.hit THEN '{fv.MANUAL}' ELSE '{fv.NOT_FOUND}' END AS status
      FROM (SELECT station_code, arg_min(station_name, row_id) AS station_name FROM stops GROUP BY 1) c
      LEFT JOIN primary_ref p ON p.code = station_code
      LEFT JOIN (SELECT code, count(*) || ' names: ' || min(name) || ' .. ' || max(name) AS names,
          bool_or(contains({reference_form('p_name')}, {reference_form('name')})
               OR contains({reference_form('name')}, {reference_form('p_name')})) AS hit
        FROM secondary_ref JOIN part ON code = CAST(p_partkey AS VARCHAR) GROUP BY code) s ON s.code = station_code""",
    "crossref": f"""SELECT *, CASE WHEN status IN ('{fv.TRUNCATED}', '{fv.NAME_MISMATCH}') THEN reference_name END
      AS suggested_full_name FROM crossed""",
    "order_numbers": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'K' || o_orderkey
        ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS train_no, o_orderpriority,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS key FROM orders""",
}


def _torn(column, expression):
    empty = "'NA'" if column == "distance" else "CASE WHEN l_returnflag = 'R' THEN ' na ' END"
    return f"CASE WHEN l_linestatus = 'O' THEN {empty} ELSE {expression} END AS {column}"


def _text(c):
    return f"CAST({c} AS VARCHAR)"


_VIEWS["torn"] = f"""SELECT row_id, CASE WHEN l_returnflag = 'R' THEN 'K' ELSE {_text('l_orderkey')} END AS train_no,
    l_returnflag AS train_name, {_text('l_linenumber')} AS seq, {_text('l_partkey')} AS station_code,
    {_text('l_suppkey')} AS station_name, {_torn('arrival', _text('CAST(l_quantity AS INTEGER)'))},
    {_torn('departure', _text('l_linenumber'))}, {_torn('distance', _text('l_partkey'))},
    {_torn('source_code', _text('l_suppkey'))}, {_torn('source_name', 'l_linestatus')},
    {_torn('dest_code', _text('l_suppkey'))}, {_torn('dest_name', 'l_returnflag')},
    l_linestatus, l_returnflag FROM lines"""
# An open row is completed by a piece behind it; every open row has a placeholder tail.
_VIEWS["neighbours"] = f"""SELECT a.*, b.row_id IS NOT NULL AND a.l_linestatus = 'O' AND b.l_returnflag = 'R' AS fixed,
    b.train_name AS n1, b.seq AS n2, b.station_code AS n3, b.station_name AS n4, b.arrival AS n5,
    b.departure AS n6, b.distance AS n7,
    p.row_id IS NOT NULL AND p.l_linestatus = 'O' AND a.l_returnflag = 'R' AS gone
    FROM torn a LEFT JOIN torn b ON b.row_id = a.row_id + 1 LEFT JOIN torn p ON p.row_id = a.row_id - 1"""
_TAIL = BASE[5:]

_SCORED = """
  SELECT '{label}' AS label, '{shape}' AS shape, CAST(total AS BIGINT) AS total_rows,
    greatest(0, 100 - p1 - p2 - p3)::BIGINT AS score, grade_of.g AS grade,
    concat_ws(',', CASE WHEN copies > 0 THEN {p1} END, CASE WHEN clashes > 0 THEN {p2} END,
      CASE WHEN blanks > 0 THEN {p3} END) AS points,
    (CASE WHEN copies > 0 THEN 1 ELSE 0 END + CASE WHEN clashes > 0 THEN 1 ELSE 0 END
     + CASE WHEN blank1 > 0 THEN 1 ELSE 0 END + CASE WHEN blank2 > 0 THEN 1 ELSE 0 END
     + CASE WHEN blank3 > 0 THEN 1 ELSE 0 END)::BIGINT AS warnings
  FROM (SELECT *, least(20, round_even(copies / total * 100, 0)) AS p1,
      least(30, round_even(clashes / total * 150, 0)) AS p2,
      least(30, round_even(blanks / (total * 3) * 100, 0)) AS p3
    FROM (SELECT *, blank1 + blank2 + blank3 AS blanks FROM {source})) n,
  LATERAL (SELECT CASE WHEN 100 - p1 - p2 - p3 >= 90 THEN 'A' WHEN 100 - p1 - p2 - p3 >= 75 THEN 'B'
    WHEN 100 - p1 - p2 - p3 >= 60 THEN 'C' WHEN 100 - p1 - p2 - p3 >= 40 THEN 'D' ELSE 'F' END AS g) grade_of"""


def _scored(label, shape, source):
    return _SCORED.format(
        label=label, shape=shape, source=source,
        **{p: f"CAST(CAST({p} AS BIGINT) AS VARCHAR)" for p in ("p1", "p2", "p3")},
    )


ORACLE = {
    "validate_stops": sql(
        """SELECT unnest(['total_rows', 'blank:train_number', 'blank:station_code', 'blank:sequence',
            'duplicate_rows', 'duplicate_train_sequence_pairs']) AS measure,
          unnest([total, blank1, blank2, blank3, copies, clashes]) AS value FROM stop_numbers
        UNION ALL SELECT 'unique_trains', count(DISTINCT t)::DOUBLE FROM per_stop
        UNION ALL SELECT 'unique_stations', count(DISTINCT c)::DOUBLE FROM per_stop
        UNION ALL SELECT unnest(['avg_stops_per_train', 'max_stops_for_a_train', 'min_stops_for_a_train']),
          unnest([round_even(avg(n)::DOUBLE, 2), max(n)::DOUBLE, min(n)::DOUBLE])
          FROM (SELECT count(q) AS n FROM per_stop GROUP BY t)""",
        _VIEWS,
    ),
    "validate_trains": sql(
        """SELECT unnest(['total_rows', 'blank:train_number', 'blank:source_station', 'blank:destination_station',
            'duplicate_rows', 'duplicate_train_number_rows']) AS measure,
          unnest([total, blank1, blank2, blank3, copies, clashes]) AS value FROM train_numbers
        UNION ALL SELECT 'unique_trains', count(DISTINCT t)::DOUBLE FROM per_train
        UNION ALL SELECT unnest(['avg_stops_per_train', 'max_stops_for_a_train', 'min_stops_for_a_train']),
          unnest([round_even(avg(n)::DOUBLE, 2), max(n)::DOUBLE, min(n)::DOUBLE])
          FROM (SELECT len(list_filter(string_split(m, '|'), lambda s: trim(s) <> '')) + 2 AS n FROM per_train)""",
        _VIEWS,
    ),
    "quality_score": sql(
        _scored("stops", "per_stop", "stop_numbers") + " UNION ALL " + _scored("trains", "per_train", "train_numbers"),
        _VIEWS,
    ),
    "station_crossref": sql("SELECT * FROM crossref", _VIEWS),
    "secondary_names": sql(
        "SELECT DISTINCT code AS station_code, name FROM secondary_ref WHERE code IN (SELECT station_code FROM stops)", _VIEWS
    ),
    "crossref_status_counts": sql("SELECT status, count(*) AS n FROM crossref GROUP BY 1", _VIEWS),
    "enrich": sql(
        f"""SELECT row_id, s.station_code, coalesce(status, '{fv.MANUAL}') AS validation_status,
          CASE WHEN status = '{fv.TRUNCATED}' THEN suggested_full_name ELSE '' END AS reference_name
        FROM stops s LEFT JOIN crossref c ON s.station_code = c.station_code""",
        _VIEWS,
    ),
    "train_crossref": sql(
        f"""SELECT train_no, o_orderpriority AS train_name_in_dataset, c_custkey IS NOT NULL AS found_in_reference,
          c_name AS reference_name, c_mktsegment AS reference_zone, CAST(c_nationkey AS VARCHAR) AS reference_from,
          CAST(NULL AS VARCHAR) AS reference_to,
          CASE WHEN c_custkey IS NOT NULL THEN '{fv.TRAIN_PRESENT}' ELSE '{fv.TRAIN_ABSENT}' END AS status
        FROM order_numbers LEFT JOIN customer ON key = c_custkey""",
        _VIEWS,
    ),
    "split_row_repair": sql(
        f"""SELECT row_id, {', '.join(BASE[:5])}, {', '.join(
            f"CASE WHEN fixed THEN n{i + 1} ELSE {c} END AS {c}" for i, c in enumerate(_TAIL))}
        FROM neighbours WHERE NOT gone""",
        _VIEWS,
    ),
    "repair_log": sql(
        """SELECT unnest(['rows_reconstructed', 'rows_removed_after_reconstruction', 'net_row_count_change',
            'original_row_count', 'cleaned_row_count']) AS measure,
          unnest([n, n, -n, total, total - n])::BIGINT AS value
        FROM (SELECT count(*) FILTER (fixed) AS n, count(*) AS total FROM neighbours)""",
        _VIEWS,
    ),
    "repair_changes": sql(
        f"""SELECT row_id, train_no, seq, station_code, {', '.join(f"{c} AS {c}_before" for c in _TAIL)},
          {', '.join(f"n{i + 1} AS {c}_after" for i, c in enumerate(_TAIL))}, row_id + 1 AS removed_row_id
        FROM neighbours WHERE fixed""",
        _VIEWS,
    ),
    "adjacent_duplicates": sql(
        """SELECT row_id, train_no, seq,
          CASE WHEN adjacent_kind = 'complementary' THEN lo_a ELSE arrival END AS arrival,
          CASE WHEN adjacent_kind = 'complementary' THEN lo_d ELSE departure END AS departure,
          CASE WHEN adjacent_kind = 'complementary' THEN lo_x ELSE distance END AS distance, adjacent_kind
        FROM (SELECT *, CASE WHEN n = 1 THEN NULL WHEN lo_a <> hi_a OR lo_d <> hi_d OR lo_x <> hi_x THEN 'conflicting'
              WHEN n_a IN (0, n) AND n_d IN (0, n) AND n_x IN (0, n) THEN 'identical'
              ELSE 'complementary' END AS adjacent_kind
          FROM (SELECT *, row_number() OVER (r ORDER BY CAST(seq AS BIGINT), row_id) AS place,
              count(*) OVER r AS n, min(arrival) OVER r AS lo_a, max(arrival) OVER r AS hi_a, count(arrival) OVER r AS n_a,
              min(departure) OVER r AS lo_d, max(departure) OVER r AS hi_d, count(departure) OVER r AS n_d,
              min(distance) OVER r AS lo_x, max(distance) OVER r AS hi_x, count(distance) OVER r AS n_x
            FROM (SELECT *, sum(starts) OVER (PARTITION BY train_no ORDER BY CAST(seq AS BIGINT), row_id) AS run
              FROM (SELECT *, CASE WHEN lag(code) OVER (PARTITION BY train_no ORDER BY CAST(seq AS BIGINT), row_id) = code
                  THEN 0 ELSE 1 END AS starts FROM paired))
            WINDOW r AS (PARTITION BY train_no, run)))
        WHERE adjacent_kind IS NULL OR adjacent_kind = 'conflicting' OR place = 1""",
        {**_VIEWS, "paired": """SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, CAST(l_linenumber AS VARCHAR) AS seq,
            l_returnflag AS code, CASE WHEN l_discount > 0.03 THEN l_linestatus END AS arrival,
            CASE WHEN l_discount > 0.07 THEN 'late' END AS departure,
            CASE WHEN l_quantity > 40 THEN 'far' END AS distance FROM lines"""},
    ),
    "code_suggestion": sql(
        """SELECT row_number() OVER () - 1 AS row_id, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE 'C' END AS station_code,
          CASE WHEN o_orderstatus <> 'P' AND o_custkey IN (SELECT k FROM listed) THEN
            (SELECT code FROM listed WHERE k = o_custkey) ELSE '' END AS code_suggestion FROM orders""",
        {"named": """SELECT CASE WHEN c_acctbal < 0 THEN 1 ELSE c_custkey END AS k,
            c_mktsegment || '/' || c_custkey AS code FROM customer""",
         "listed": "SELECT k, min(code) AS code FROM named GROUP BY k HAVING count(*) = 1"},
    ),
}
