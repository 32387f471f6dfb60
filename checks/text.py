"""Text function queries."""

from pyspark.sql import functions as F

from checks.tables import spread, table
from waymend.functions import text as t
from waymend.functions.similarity import similarity_ratio


def normalize_names(spark, folder):
    """The three name forms over whole document texts."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        t.normalize_name("text").alias("plain_form"),
        t.norm_ref_name("text").alias("reference_form"),
        t.norm_endpoint_name("text").alias("endpoint_form"),
    )


def normalize_part_names(spark, folder):
    parts = table(spark, folder, "part")
    label = F.concat(
        F.initcap("p_name"), F.lit(" Jn. ("), F.col("p_brand"), F.lit(") & Madras-"),
        F.col("p_type"), F.lit(" Rd, T J"),
    )
    return parts.select(
        "p_partkey", t.normalize_name(label).alias("plain_form"),
        t.norm_ref_name(label).alias("reference_form"),
        t.norm_endpoint_name(label).alias("endpoint_form"),
    )


def split_station(spark, folder):
    parts = table(spark, folder, "part")
    dashed = F.when(
        F.col("p_size") > 5, F.concat("p_name", F.lit(" - "), "p_type", F.lit(" - "), "p_brand")
    ).otherwise(F.col("p_brand"))
    name, code = t.split_station(dashed)
    return parts.select("p_partkey", name.alias("name"), code.alias("code"))


def clock_parse(spark, folder):
    """H:MM texts of event times; every third kind of text is none."""
    events = table(spark, folder, "events")
    raw = (
        F.when(F.col("event_type") == "click", F.date_format("ts", "HH:mm:ss"))
        .when(F.col("event_type") == "error", F.lit(None))
        .otherwise(F.date_format("ts", "H:mm"))
    )
    return events.select(
        "event_id", t.norm_time(raw).alias("clock"), t.reformat_clock(raw).alias("reformatted"),
        t.is_clock(raw).alias("is_clock"),
        t.endpoint_arrival(F.when(F.col("value") < 5, F.lit("Source")).otherwise(raw)).alias("arrival"),
    )


def distance_parse(spark, folder):
    lines = table(spark, folder, "lineitem")
    raw = F.concat(
        F.col("l_quantity").cast("int").cast("string"),
        F.when(F.col("l_returnflag") == "A", " kms").when(F.col("l_returnflag") == "N", " KM")
        .otherwise(" miles"),
    )
    return lines.groupBy(t.parse_distance(raw).alias("km"), "l_returnflag").agg(F.count("*").alias("n"))


def number_keys(spark, folder):
    orders = table(spark, folder, "orders")
    padded = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    mixed = F.when(F.col("o_orderstatus") == "P", F.concat(padded, F.lit("X"))).otherwise(padded)
    return orders.select(
        "o_orderkey", t.number_key(mixed).alias("key"), t.digits_key(mixed).alias("digits")
    )


def truncation(spark, folder):
    parts = table(spark, folder, "part")
    full = F.concat("p_name", F.lit(" "), F.lower("p_type"))
    cut = F.upper(F.substring(full, 1, 12))
    return parts.select(
        "p_partkey", t.is_truncation_of(cut, full).alias("cut"),
        t.is_truncation_of("p_name", F.col("p_brand")).alias("other"),
        t.strip_train_suffix(F.concat("p_brand", F.lit(" Train"))).alias("trimmed"),
    )


def packed_counts(spark, folder):
    """Stops in packed texts: urls cut at '/' stand in for the bars."""
    pages = table(spark, folder, "pages")
    return pages.select("page_id", t.count_packed_stops(F.replace("url", F.lit("/"), F.lit("|"))).alias("stops"))


def similarity(spark, folder):
    """Similarity of customer names and their segment/nation texts, whole tables."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    joined = spread(customers).join(nations, customers.c_nationkey == nations.n_nationkey)
    left = F.concat("c_mktsegment", F.lit(" "), "n_name")
    score = similarity_ratio(left, F.concat("c_name", F.lit(" "), "c_mktsegment"))
    return joined.select("c_custkey", F.round(score, 6).alias("score"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_names, normalize_part_names, split_station, clock_parse, distance_parse,
        number_keys, truncation, packed_counts, similarity,
    )
}


def plain_form(c):
    """SQL of the name normalisation."""
    out = f"trim(lower({c}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    for old, new in ((".", " "), (",", " "), ("&", " and "), ("-", " ")):
        out = f"replace({out}, '{old}', '{new}')"
    out = rf"' ' || regexp_replace({out}, '\([^\n]*?\)', '', 'g') || ' '"
    for old, new in (
        ("bombay", "mumbai"), ("madras", "chennai"), ("bangalore", "bengaluru"),
        ("calcutta", "kolkata"), (" jn ", " junction "), (" j ", " junction "),
        (" cantt ", " cantonment "), (" rd ", " road "), (" hal ", " halt "),
        (" t ", " terminus "), (" intl ", " international "),
    ):
        out = f"replace({out}, '{old}', '{new}')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def reference_form(c):
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace(upper(replace({c}, 'ß', 'SS')), '[.\-]', '', 'g'),"
        rf" '\bJUNCTION\b', 'JN', 'g'), '\s+', ' ', 'g'))"
    )


def endpoint_form(c):
    return (
        rf"regexp_replace(regexp_replace(upper(replace({c}, 'ß', 'SS')),"
        rf" '\b(JN|JUNCTION|CITY|CENTRAL|CNTL|TOWN|TERMINUS|TERM)\b', '', 'g'), '[^A-Z]', '', 'g')"
    )


def _clock(c):
    return (
        f"CASE WHEN regexp_matches({c}, '^[0-9]{{1,2}}:[0-9]{{2}}$') THEN "
        f"lpad(split_part({c}, ':', 1), 2, '0') || ':' || split_part({c}, ':', 2) || ':00' ELSE '' END"
    )


def common_length(a, b):
    """Bit recurrence for the longest common subsequence, as a fold in SQL."""
    mask = (
        f"coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i: "
        f"CASE WHEN {a}[i] = c THEN CAST(1 AS BIGINT) << CAST(i - 1 AS INTEGER) ELSE 0 END)), 0)::BIGINT"
    )
    full = f"((CAST(1 AS BIGINT) << CAST(length({a}) AS INTEGER)) - 1)"
    steps = f"list_transform(string_split({b}, ''), lambda c: {mask})"
    fold = (
        f"list_reduce({steps}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}, {full})"
    )
    return f"(length({a}) - bit_count({fold}))"


def ratio_sql(a, b):
    """Similarity 0-100 of two texts of at most 61 characters."""
    total = f"(length({a}) + length({b}))"
    return (
        f"CASE WHEN {total} = 0 THEN 100.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE "
        f"(1.0::DOUBLE - ({total} - 2 * {common_length(a, b)})::DOUBLE / {total}) * 100 END"
    )


_LABEL = """(SELECT *, list_aggregate(list_transform(string_split(p_name, ' '),
    lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')
    || ' Jn. (' || p_brand || ') & Madras-' || p_type || ' Rd, T J' AS label FROM part)"""
_RAW_CLOCK = """(SELECT *, CASE WHEN event_type = 'click' THEN strftime(ts, '%H:%M:%S')
    WHEN event_type = 'error' THEN NULL
    ELSE CAST(CAST(strftime(ts, '%H') AS INTEGER) AS VARCHAR) || strftime(ts, ':%M') END AS raw FROM events)"""

ORACLE = {
    "normalize_names": f"""SELECT doc_id, {plain_form('text')} AS plain_form,
        {reference_form('text')} AS reference_form, {endpoint_form('text')} AS endpoint_form FROM documents""",
    "normalize_part_names": f"""SELECT p_partkey, {plain_form('label')} AS plain_form,
        {reference_form('label')} AS reference_form, {endpoint_form('label')} AS endpoint_form FROM {_LABEL}""",
    "split_station": """SELECT p_partkey,
        CASE WHEN p_size > 5 THEN p_name || ' - ' || p_type ELSE '' END AS name, p_brand AS code FROM part""",
    "clock_parse": f"""SELECT event_id, coalesce({_clock('raw')}, '') AS clock,
        CASE WHEN regexp_matches(raw, '^[0-9]{{1,2}}:[0-9]{{2}}$') THEN {_clock('raw')} ELSE raw END AS reformatted,
        coalesce(regexp_matches(raw, '^[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$'), false) AS is_clock,
        CASE WHEN value < 5 THEN '' ELSE coalesce({_clock('raw')}, '') END AS arrival FROM {_RAW_CLOCK}""",
    "distance_parse": """SELECT CASE WHEN l_returnflag IN ('A', 'N') THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
        ELSE '' END AS km, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "number_keys": """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN (CASE WHEN o_orderkey = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END) || 'X'
             ELSE CAST(o_orderkey AS VARCHAR) END AS key,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS digits FROM orders""",
    "truncation": """SELECT p_partkey, length(p_name || ' ' || p_type) >= 12 AS cut,
        length(p_name) >= 12 AND (starts_with(upper(p_brand), upper(p_name))) AS other,
        p_brand AS trimmed FROM part""",
    "packed_counts": """SELECT page_id, CAST(len(list_filter(string_split(url, '/'),
        lambda s: trim(s) <> '')) + 2 AS INTEGER) AS stops FROM pages""",
    "similarity": f"""SELECT c_custkey, round({ratio_sql('a', 'b')}, 6) AS score FROM
        (SELECT c_custkey, c_mktsegment || ' ' || n_name AS a, c_name || ' ' || c_mktsegment AS b
         FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
}
