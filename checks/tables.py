"""The given tables in the roles of a schedule: order = train, line = stop, part = station.

Each Spark view below has its SQL twin; ``sql(body)`` puts the twins a query needs in
front of it.
"""

import re

from pyspark.sql import functions as F

from waymend.roles import BASE
from waymend.sources.readers import read_parquet_with_row_id, spread  # noqa: F401 (spread: for checks.text)

S = "string"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered(spark, folder, name, columns=None):
    return read_parquet_with_row_id(spark, f"{folder}/{name}.parquet", columns)


def as_stops(df, **roles):
    """Role columns from expressions; roles that are not given are null."""
    return df.select(
        "row_id", *[roles.get(r, F.lit(None)).cast(S).alias(r) for r in BASE]
    )


def day(c):
    return F.date_format(c, "yyyy-MM-dd")


def whole(c):
    return F.col(c).cast("bigint").cast(S)


def stops(spark, folder):
    """One row per line item; the return flag decides which fields are missing."""
    lines = numbered(
        spark, folder, "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    # By the train's number as it will be called, so that rows that meet their order are together by train.
    lines, orders = lines.withColumn("l_orderkey", F.col("l_orderkey").cast(S)), orders.withColumn("o_orderkey", F.col("o_orderkey").cast(S))
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey, "left").join(
        orders, lines.l_orderkey == orders.o_orderkey, "left"
    )
    returned, open_ = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    return as_stops(
        joined,
        train_no=F.col("l_orderkey"),
        train_name=F.col("o_orderstatus"),
        seq=F.col("l_linenumber"),
        station_code=F.col("l_partkey"),
        station_name=F.col("p_name"),
        arrival=F.when(~returned, day("l_shipdate")),
        departure=F.when(~open_, day("l_shipdate")),
        distance=F.when(~(returned & open_), whole("l_quantity")),
        source_code=F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast(S)),
        dest_code=F.col("o_custkey"),
    )


def plain_stops(spark, folder):
    """Line items reduced to few columns, so that whole rows repeat."""
    lines = numbered(
        spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    )
    return as_stops(
        lines,
        train_no=F.col("l_orderkey"),
        train_name=F.col("l_returnflag"),
        seq=F.col("l_linenumber"),
        station_code=F.col("l_linestatus"),
    )


def status_stops(spark, folder):
    """Line status as station, declared ends from the order (and, at the far end, the line)."""
    lines = numbered(
        spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return as_stops(
        joined,
        train_no=F.col("l_orderkey"),
        seq=F.col("l_linenumber"),
        station_code=F.col("l_linestatus"),
        source_code=F.col("o_orderstatus"),
        dest_code=F.when(urgent, F.col("l_returnflag")).otherwise(F.col("o_orderstatus")),
    )


def event_stops(spark, folder):
    """Events of a user as stops; clock times are the event's and the user's next value."""
    events = numbered(spark, folder, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    minute = F.lpad(F.pmod(F.floor("value"), F.lit(60)).cast(S), 2, "0")
    clock = F.concat(F.date_format("ts", "HH:"), minute, F.lit(":00"))
    return as_stops(
        events,
        train_no=F.col("user_id"),
        seq=F.col("event_id"),
        station_code=F.col("event_type"),
        arrival=F.date_format("ts", "HH:mm:ss"),
        departure=F.when(F.col("event_type") != "error", clock),
        distance=F.col("event_id"),
    )


def document_stops(spark, folder):
    docs = numbered(spark, folder, "documents", ["doc_id", "text", "lang", "source"])
    return as_stops(
        docs, train_no=F.col("doc_id"), train_name=F.col("source"),
        station_code=F.col("lang"), station_name=F.col("text"),
    )


NO = "CAST(NULL AS VARCHAR)"
VIEWS = {
    "lines": "SELECT *, row_number() OVER () - 1 AS row_id FROM lineitem",
    "stops": f"""
      SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, o_orderstatus AS train_name,
        CAST(l_linenumber AS VARCHAR) AS seq, CAST(l_partkey AS VARCHAR) AS station_code,
        p_name AS station_name,
        CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS arrival,
        CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate, '%Y-%m-%d') END AS departure,
        CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O')
             THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS distance,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS source_code,
        {NO} AS source_name, CAST(o_custkey AS VARCHAR) AS dest_code, {NO} AS dest_name
      FROM lines LEFT JOIN part ON l_partkey = p_partkey
      LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "plain_stops": """
      SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, l_returnflag AS train_name,
        CAST(l_linenumber AS VARCHAR) AS seq, l_linestatus AS station_code
      FROM lines""",
    "status_stops": """
      SELECT row_id, CAST(l_orderkey AS VARCHAR) AS train_no, CAST(l_linenumber AS VARCHAR) AS seq,
        l_linestatus AS station_code, o_orderstatus AS source_code,
        CASE WHEN o_orderpriority = '1-URGENT' THEN l_returnflag ELSE o_orderstatus END AS dest_code
      FROM lines JOIN orders ON l_orderkey = o_orderkey""",
    "event_stops": """
      SELECT row_number() OVER () - 1 AS row_id, CAST(user_id AS VARCHAR) AS train_no,
        CAST(event_id AS VARCHAR) AS seq, event_type AS station_code,
        strftime(ts, '%H:%M:%S') AS arrival,
        CASE WHEN event_type <> 'error' THEN
          strftime(ts, '%H:') || lpad(CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR), 2, '0') || ':00'
        END AS departure, CAST(event_id AS VARCHAR) AS distance
      FROM events""",
    "document_stops": """
      SELECT row_number() OVER () - 1 AS row_id, CAST(doc_id AS VARCHAR) AS train_no,
        source AS train_name, lang AS station_code, text AS station_name FROM documents""",
}


def with_views(body, views, recursive=False):
    """``body`` with the named queries it (transitively) mentions in front of it."""
    needed, pending = [], [body]
    while pending:
        text = pending.pop()
        for name, query in views.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                needed.append(name)
                pending.append(query)
    if not needed:
        return body
    ordered = [n for n in views if n in needed]
    parts = [f"{n} AS MATERIALIZED ({views[n]})" for n in ordered]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def sql(body, more=None, recursive=False):
    return with_views(body, {**VIEWS, **(more or {})}, recursive)
