"""Audit queries."""

from pyspark.sql import functions as F

from checks.tables import (
    as_stops, document_stops, event_stops, numbered, plain_stops, sql, status_stops, stops,
)
from waymend.operators import audit as a

FLAG = ["row_id", "train_no", "category", "detail", "severity"]


def _only(flags, *categories):
    return flags.where(F.col("category").isin(*categories)).select(*FLAG)


def audit_row_flags(spark, folder):
    return a.row_flags(stops(spark, folder)).select(*FLAG)


def audit_broken_rows(spark, folder):
    """Rows with a piece of text as number, a blank name or no SEQ, through the whole audit."""
    broken = stops(spark, folder).withColumns({
        "train_no": F.when(F.col("arrival").isNull(), F.concat(F.lit("K"), "train_no")).otherwise(F.col("train_no")),
        "station_name": F.when(F.col("departure").isNull(), " ").otherwise(F.col("station_name")),
        "seq": F.when(F.col("distance").isNotNull(), F.col("seq")),
    })
    return _only(
        a.audit(broken), "missing_required_value", "missing_optional_value", "malformed_row_non_numeric_train_no",
        "station_code_format", "encoding_or_whitespace_issue",
    )


def audit_document_flags(spark, folder):
    """Code format and encoding rules over whole document texts (texts not repeated)."""
    flags = a.row_flags(document_stops(spark, folder))
    return _only(flags, "station_code_format", "encoding_or_whitespace_issue").drop("detail")


def audit_ordered_flags(spark, folder):
    return a.ordered_flags(stops(spark, folder)).select(*FLAG)


def seq_discontinuity(spark, folder):
    return a.seq_discontinuity_flags(stops(spark, folder)).select(*FLAG)


def seq_values(spark, folder):
    """The whole numbering behind every discontinuity."""
    return a.seq_values(stops(spark, folder))


def clock_rules(spark, folder):
    return _only(
        a.ordered_flags(event_stops(spark, folder)),
        "departure_before_arrival", "origin_arrival_not_placeholder",
        "terminus_departure_not_placeholder", "distance_not_monotonic",
    )


def endpoint_integrity(spark, folder):
    """Declared ends against actual ends; 'O' and 'P' count as the same station."""
    return _only(
        a.ordered_flags(status_stops(spark, folder), alias_pairs=[("O", "P")]),
        "inconsistent_declared_src_dst", "source_station_mismatch",
        "destination_station_mismatch", "known_code_alias_inconsistency", "single_stop_train",
    )


def dup_exact(spark, folder):
    return a.duplicate_row_flags(plain_stops(spark, folder)).select(*FLAG)


def dup_seq(spark, folder):
    return a.duplicate_seq_flags(stops(spark, folder)).select(*FLAG)


def dup_stop(spark, folder):
    return a.duplicate_stop_flags(stops(spark, folder)).select(*FLAG)


def code_name_consistency(spark, folder):
    parts = numbered(spark, folder, "part", ["p_partkey", "p_brand", "p_type"])
    rows = as_stops(
        parts, train_no=F.col("p_partkey"), station_code=F.col("p_brand"), station_name=F.col("p_type")
    )
    return a.code_name_flags(rows).select(*FLAG)


def code_name_pairs(spark, folder):
    return a.code_name_pairs(stops(spark, folder))


def audit_flag_counts(spark, folder):
    return a.flag_counts(a.audit(stops(spark, folder)))


def audit_summary(spark, folder):
    rows = stops(spark, folder)
    return a.audit_summary(rows, a.audit(rows))


QUERIES = {
    f.__name__: f
    for f in (
        audit_row_flags, audit_broken_rows, audit_document_flags, audit_ordered_flags, seq_discontinuity, clock_rules,
        endpoint_integrity, dup_exact, dup_seq, dup_stop, code_name_consistency,
        seq_values, code_name_pairs,
        audit_flag_counts, audit_summary,
    )
}

# ---------------------------------------------------------------- SQL twins

_COLUMNS = {
    "Train No": "train_no", "Train Name": "train_name", "SEQ": "seq",
    "Station Code": "station_code", "Station Name": "station_name",
    "Arrival time": "arrival", "Departure Time": "departure", "Distance": "distance",
    "Source Station": "source_code", "Source Station Name": "source_name",
    "Destination Station": "dest_code", "Destination Station Name": "dest_name",
}


def _flag(source, rule, category, severity, detail, train="train_no"):
    return (
        f"SELECT row_id, {train} AS train_no, '{category}' AS category, {detail} AS detail, "
        f"'{severity}' AS severity FROM {source} WHERE {rule}"
    )


def _blank(c):
    return f"({c} IS NULL OR trim({c}) = '')"


def _row_rules(source):
    out = []
    for i, (header, c) in enumerate(_COLUMNS.items()):
        kind = ("required", "critical", "required column ") if i < 5 else ("optional", "warning", "column ")
        out.append(
            _flag(source, _blank(c), f"missing_{kind[0]}_value", kind[1],
                  f"'no value in {kind[2]}{header}'", "''" if c == "train_no" else "train_no")
        )
    out.append(
        _flag(source, "NOT coalesce(regexp_matches(train_no, '^[0-9]+$'), false)",
              "malformed_row_non_numeric_train_no", "critical",
              "'train number ' || coalesce(train_no, 'nan') || "
              "' is not a plain number; the row may be a split-off piece'")
    )
    out.append(
        _flag(source, "NOT regexp_matches(station_code, '^[A-Z0-9]{2,6}$')", "station_code_format",
              "warning", "'code ' || station_code || ' is not 2-6 capital letters or digits'")
    )
    out.append(_encoding(source))
    return out


def _encoding(source):
    return _flag(
        source,
        r"regexp_matches(station_name, '[\x00-\x08\x0b\x0c\x0e-\x1f]') OR station_name <> trim(station_name, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
        r" OR regexp_matches(station_name, '\s{2,}') OR regexp_matches(station_name, '[^\x00-\x7f]')",
        "encoding_or_whitespace_issue", "info",
        "'name ' || station_name || ' has control, stray blank or non-ASCII characters'",
    )


def _ranked(source):
    """Stops with place and neighbour, whatever columns the source has."""
    return f"""
      SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY train_no) AS n,
        lag(distance) OVER w AS before_distance, lag(seq) OVER w AS before_seq,
        min(source_code) OVER (PARTITION BY train_no) AS src_low,
        max(source_code) OVER (PARTITION BY train_no) AS src_high,
        min(dest_code) OVER (PARTITION BY train_no) AS dst_low,
        max(dest_code) OVER (PARTITION BY train_no) AS dst_high
      FROM {source} WHERE train_no IS NOT NULL
      WINDOW w AS (PARTITION BY train_no ORDER BY CAST(seq AS DOUBLE) NULLS LAST, row_id)"""


_TORN = "(coalesce(src_low <> src_high, false) OR coalesce(dst_low <> dst_high, false))"


def _end(source, place, label, declared, category, alias):
    d = f"{declared}_low"
    same = f"(least({d}, station_code) = '{alias[0]}' AND greatest({d}, station_code) = '{alias[1]}')"
    base = f"{place} AND n > 1 AND NOT {_TORN} AND {d} IS NOT NULL AND {d} <> station_code"
    detail = f"'declared {label} ' || {d} || ' but the stop there is ' || station_code"
    return [
        _flag(source, f"{base} AND NOT {same}", category, "critical", detail),
        _flag(source, f"{base} AND {same}", "known_code_alias_inconsistency", "info", detail),
    ]


def _endpoint_rules(source, alias=("CSMT", "CSTM")):
    return [
        _flag(source, "n = 1", "single_stop_train", "critical", "'the train has one stop only'"),
        _flag(source, f"pos = 1 AND n > 1 AND {_TORN}", "inconsistent_declared_src_dst", "critical",
              "'declared source ' || coalesce(src_low, 'nan') || '..' || coalesce(src_high, 'nan') || "
              "', declared destination ' || coalesce(dst_low, 'nan') || '..' || coalesce(dst_high, 'nan')"),
        *_end(source, "pos = 1", "source", "src", "source_station_mismatch", alias),
        *_end(source, "pos = n", "destination", "dst", "destination_station_mismatch", alias),
    ]


def _clock_rules(source):
    return [
        _flag(source, "n > 1 AND CAST(distance AS DOUBLE) < CAST(before_distance AS DOUBLE)",
              "distance_not_monotonic", "critical",
              "'distance ' || distance || ' at seq ' || seq || ' after ' || before_distance || "
              "' at seq ' || before_seq"),
        _flag(source, "n > 1 AND pos = 1 AND arrival NOT IN ('00:00:00', 'nan', 'None', '')",
              "origin_arrival_not_placeholder", "warning", "'first stop has arrival time ' || arrival"),
        _flag(source, "n > 1 AND pos = n AND departure NOT IN ('00:00:00', 'nan', 'None', '')",
              "terminus_departure_not_placeholder", "warning", "'last stop has departure time ' || departure"),
        _flag(source, "pos > 1 AND pos < n AND regexp_matches(arrival, '^[0-9]{2}:[0-9]{2}:[0-9]{2}$')"
              " AND regexp_matches(departure, '^[0-9]{2}:[0-9]{2}:[0-9]{2}$') AND departure < arrival",
              "departure_before_arrival", "info",
              "'departs ' || departure || ' before arriving ' || arrival || ' at seq ' || seq || "
              "'; a halt over midnight is possible'"),
    ]


_ORIGIN_DISTANCE = _flag(
    "ranked", "n > 1 AND pos = 1 AND CAST(distance AS DOUBLE) <> 0", "origin_distance_not_zero",
    "warning", "'first stop has distance ' || distance",
)
_ORDERED_RULES = _endpoint_rules("ranked") + _clock_rules("ranked") + [_ORIGIN_DISTANCE]
_SEQ_RULE = """
  SELECT first_row AS row_id, train_no, 'seq_discontinuity' AS category,
    CAST(different AS VARCHAR) || ' different seq values ' || CAST(low AS VARCHAR) || '..' || CAST(high AS VARCHAR)
      || ' is not 1..' || CAST(n AS VARCHAR) AS detail, 'critical' AS severity
  FROM (SELECT train_no, count(*) AS n, arg_min(row_id, pos) AS first_row,
          count(DISTINCT seq) AS different, min(CAST(seq AS BIGINT)) AS low, max(CAST(seq AS BIGINT)) AS high,
          count(*) FILTER (CAST(seq AS BIGINT) <> pos) AS wrong
        FROM ranked GROUP BY train_no) WHERE n > 1 AND wrong > 0"""


def _repeated(source, keys, category, severity, detail):
    counted = f"(SELECT *, count(*) OVER (PARTITION BY {keys}) AS copies FROM {source})"
    return _flag(counted, "copies > 1", category, severity, detail)


_DUP_SEQ = _repeated("stops", "train_no, seq", "duplicate_train_seq", "critical",
                     "'seq ' || seq || ' repeats on train ' || train_no")
_DUP_STOP = _repeated("stops", "train_no, station_code", "duplicate_stop_on_train", "warning",
                      "'station ' || station_code || ' repeats on train ' || train_no || '; a loop is possible'")


def _names(source):
    return f"""
  SELECT row_id, train_no, 'station_code_name_inconsistency' AS category,
    'code ' || station_code || ' goes with ' || CAST(n AS VARCHAR) || ' names: ' || low || ' .. ' || high AS detail,
    'warning' AS severity
  FROM {source} JOIN (SELECT station_code, count(DISTINCT station_name) AS n,
      min(station_name) AS low, max(station_name) AS high
    FROM {source} GROUP BY station_code HAVING count(DISTINCT station_name) > 1) USING (station_code)
  WHERE station_name IS NOT NULL"""


_MORE = {"ranked": _ranked("stops")}
_BRANDS = {
    "brands": """SELECT row_number() OVER () - 1 AS row_id, CAST(p_partkey AS VARCHAR) AS train_no,
      p_brand AS station_code, p_type AS station_name FROM part"""
}
_ALL = " UNION ALL ".join(
    _row_rules("stops")
    + [_repeated("stops", ", ".join(_COLUMNS.values()), "duplicate_exact_row", "critical",
                 "'all fields equal another row'"), _DUP_SEQ, _DUP_STOP]
    + _ORDERED_RULES + [_SEQ_RULE, _names("stops")]
)
_ALL_VIEWS = {**_MORE, "all_flags": _ALL}


def _sum(*categories):
    listed = ", ".join(f"'{c}'" for c in categories)
    return f"SELECT count(*) FROM all_flags WHERE category IN ({listed})"


_EVENTS = {
    "event_full": "SELECT *, CAST(NULL AS VARCHAR) AS source_code, CAST(NULL AS VARCHAR) AS dest_code FROM event_stops",
    "ranked_events": _ranked("event_full"),
}
_ENDS = {
    "status_full": "SELECT *, CAST(NULL AS VARCHAR) AS distance FROM status_stops",
    "ranked_ends": _ranked("status_full"),
}

ORACLE = {
    "audit_row_flags": sql(" UNION ALL ".join(_row_rules("stops"))),
    "audit_broken_rows": sql(" UNION ALL ".join(_row_rules("broken_stops")), {
        "broken_stops": """SELECT * REPLACE (CASE WHEN arrival IS NULL THEN 'K' || train_no ELSE train_no END AS train_no,
          CASE WHEN departure IS NULL THEN ' ' ELSE station_name END AS station_name,
          CASE WHEN distance IS NOT NULL THEN seq END AS seq) FROM stops"""
    }),
    "audit_document_flags": sql(
        "SELECT row_id, train_no, category, severity FROM ("
        + _row_rules("document_stops")[-2].replace("station_code || ", "'' || ")
        + " UNION ALL " + _encoding("document_stops") + ")"
    ),
    "audit_ordered_flags": sql(" UNION ALL ".join(_ORDERED_RULES), _MORE),
    "seq_discontinuity": sql(_SEQ_RULE, _MORE),
    "clock_rules": sql(" UNION ALL ".join(_clock_rules("ranked_events")), _EVENTS),
    "endpoint_integrity": sql(" UNION ALL ".join(_endpoint_rules("ranked_ends", ("O", "P"))), _ENDS),
    "dup_exact": sql(
        _repeated("plain_stops", "train_no, train_name, seq, station_code", "duplicate_exact_row",
                  "critical", "'all fields equal another row'")
    ),
    "dup_seq": sql(_DUP_SEQ),
    "dup_stop": sql(_DUP_STOP),
    "code_name_consistency": sql(_names("brands"), _BRANDS),
    "seq_values": sql("SELECT train_no, row_id, seq, CAST(seq AS DOUBLE) AS seq_num FROM stops WHERE train_no IS NOT NULL"),
    "code_name_pairs": sql(
        "SELECT DISTINCT station_code, station_name FROM stops WHERE station_code IS NOT NULL AND station_name IS NOT NULL"
    ),
    "audit_flag_counts": sql(
        "SELECT category, severity, count(*) AS n FROM all_flags GROUP BY 1, 2", _ALL_VIEWS
    ),
    "audit_summary": sql(
        f"""
        SELECT 'total_rows_analyzed' AS measure, (SELECT count(*) FROM stops) AS value
        UNION ALL SELECT 'total_unique_trains', (SELECT count(DISTINCT train_no) FROM stops)
        UNION ALL SELECT 'total_unique_station_codes', (SELECT count(DISTINCT station_code) FROM stops)
        UNION ALL SELECT 'total_flags_raised', (SELECT count(*) FROM all_flags)
        UNION ALL SELECT 'flags_by_category:' || category, count(*) FROM all_flags GROUP BY category
        UNION ALL SELECT 'flags_by_severity:' || severity, count(*) FROM all_flags GROUP BY severity
        UNION ALL SELECT 'single_stop_trains_count', ({_sum('single_stop_train')})
        UNION ALL SELECT 'trains_with_seq_discontinuity', ({_sum('seq_discontinuity')})
        UNION ALL SELECT 'rows_with_distance_not_monotonic', ({_sum('distance_not_monotonic')})
        UNION ALL SELECT 'arrival_departure_placeholder_issues',
          ({_sum('origin_arrival_not_placeholder', 'terminus_departure_not_placeholder')})
        UNION ALL SELECT 'source_dest_mismatches',
          ({_sum('inconsistent_declared_src_dst', 'source_station_mismatch', 'destination_station_mismatch')})
        UNION ALL SELECT 'malformed_non_numeric_train_no_rows', ({_sum('malformed_row_non_numeric_train_no')})
        UNION ALL SELECT 'station_codes_bad_format',
          (SELECT count(DISTINCT station_code) FROM all_flags JOIN stops USING (row_id)
           WHERE category = 'station_code_format')
        UNION ALL SELECT 'station_codes_with_inconsistent_names', (SELECT count(*) FROM
          (SELECT station_code FROM stops WHERE station_name IS NOT NULL GROUP BY 1
           HAVING count(DISTINCT station_name) > 1))
        UNION ALL SELECT 'station_names_with_inconsistent_codes', (SELECT count(*) FROM
          (SELECT station_name FROM stops WHERE station_name IS NOT NULL GROUP BY 1
           HAVING count(DISTINCT station_code) > 1))""",
        _ALL_VIEWS,
    ),
}
