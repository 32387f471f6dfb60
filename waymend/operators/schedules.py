"""Two kinds of schedule files as flat stop rows: train, place, stop.

Output of both: train_no, train_name, pos (0..n-1), seq, station_code, station_name,
arrival, departure, distance, source_code, dest_code. Blanks are ''. The ``seq`` of
per-stop files is a text of digits (any number of them, no leading zeros).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions.text import cell_text, parse_packed_stops, strip_control_prefix
from waymend.operators.keyed import top_per_key
from waymend.operators.ordered import HOT_ROWS, position, with_ordered
from waymend.operators.resolve import NAME_GROUPS, resolve_names
from waymend.roles import find_column, quoted

UNKNOWN = "UNKNOWN"
STOP = [
    "train_no", "train_name", "pos", "seq", "station_code", "station_name",
    "arrival", "departure", "distance", "source_code", "dest_code",
]


def _digits():
    """SEQ texts that number a stop."""
    return F.col("seq").rlike(r"^\d+\z")


def old_schedule(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per-stop rows (role columns, row_id): stops with an all-digit SEQ, numbered.

    ``pos`` is the place after sorting by SEQ, equal ones by row; it may differ from
    SEQ. Trains without a valid row disappear.
    """
    text = df.select(
        "row_id",
        *[cell_text(c).alias(c) for c in STOP if c != "pos"],
    ).where(_digits())
    # Texts without leading zeros sort as numbers of any length: by length, then as text.
    bare = F.regexp_replace("seq", r"^0+(?=\d)", "")
    numbered = text.withColumn("seq", bare).withColumn("_digits", F.length("seq"))
    placed = with_ordered(numbered, ["train_no"], ["_digits", "seq", "row_id"], {"pos": position()}, hot_rows)
    return placed.withColumn("pos", F.col("pos") - 1).select(*STOP)


def skipped_rows(df: DataFrame, shown: int = 5) -> DataFrame:
    """Values of SEQ that do not number a stop: rows, trains, the first trains."""
    skipped = df.select(
        cell_text("train_no").alias("train_no"), cell_text("seq").alias("seq")
    ).where(~_digits())
    pairs = skipped.groupBy("seq", "train_no").agg(F.count("*").alias("rows"))
    totals = pairs.groupBy("seq").agg(F.sum("rows").alias("rows"), F.count("*").alias("trains"))
    first = top_per_key(pairs.select("seq", "train_no"), ["seq"], [F.asc("train_no")], shown, "rank")
    listed = first.groupBy("seq").agg(
        F.array_join(F.array_sort(F.collect_list("train_no")), ", ").alias("first_trains")
    )
    return totals.join(listed, "seq")


def packed_trains(df: DataFrame) -> DataFrame:
    """Per-train rows under fixed names; of a repeated train the last row counts.

    ``df`` needs ``row_id`` and a number, name, source and destination column.
    """
    fields = {
        "train_no": "train_number", "train_name": "train_name", "source": "source_station",
        "destination": "destination_station", "classes": "classes", "running_days": "running_days",
    }
    found = {name: find_column(df, field) for name, field in fields.items()}
    lost = [n for n in ("train_no", "train_name", "source", "destination") if not found[n]]
    if lost:
        raise ValueError(f"no column found for {', '.join(lost)}")
    for literal in ("departure_time", "arrival_time", "distance", "intermediate_stops"):
        found[literal] = literal if literal in df.columns else None
    columns = [
        (cell_text(quoted(c)) if c else F.lit("")).alias(name) for name, c in found.items()
    ]
    rows = df.select("row_id", *columns)
    return top_per_key(rows, ["train_no"], [F.desc("row_id")], 1, "_rank").drop("_rank")


def packed_stops(trains: DataFrame) -> DataFrame:
    """Flat rows with the names as written: source, kept intermediates, destination.

    Intermediates named like the source or destination (any case, control prefix of
    the end removed) are skipped. Other columns of ``trains`` are carried along.
    """
    ends = [F.lower(strip_control_prefix("source")), F.lower(strip_control_prefix("destination"))]
    blank = F.lit("")

    def stop(name, arrival, departure, distance):
        return F.struct(
            name.alias("name"), arrival.alias("arrival"), departure.alias("departure"),
            distance.alias("distance"),
        )

    middle = F.transform(
        F.filter(
            parse_packed_stops("intermediate_stops"),
            lambda s: (F.lower(s["name"]) != ends[0]) & (F.lower(s["name"]) != ends[1]),
        ),
        lambda s: stop(s["name"], s["arrival"], s["departure"], blank),
    )
    first = F.array(stop(F.col("source"), blank, F.col("departure_time"), blank))
    last = F.array(stop(F.col("destination"), F.col("arrival_time"), blank, F.col("distance")))
    used = ("row_id", "intermediate_stops", "departure_time", "arrival_time", "distance")
    keep = [c for c in trains.columns if c not in used]
    return trains.select(*keep, F.posexplode(F.concat(first, middle, last)).alias("pos", "stop")).select(
        *keep, F.col("pos").cast("bigint").alias("pos"), "stop.*"
    )


def _attach(df: DataFrame, matches: DataFrame, column: str, code: str, shown: str) -> DataFrame:
    """Code and display name of a name column; an unresolved name stays as written."""
    known = matches.where("station_code <> ''").select(
        F.col("name").alias("_key"), F.col("station_code").alias("_code"),
        F.col("canonical_name").alias("_name"),
    )
    joined = df.withColumn("_key", strip_control_prefix(column)).join(known, "_key", "left")
    return joined.withColumns(
        {code: F.coalesce("_code", F.lit(UNKNOWN)), shown: F.coalesce("_name", F.col(column))}
    ).drop("_key", "_code", "_name")


def named_stops(trains: DataFrame, matches: DataFrame) -> DataFrame:
    """Flat, resolved stop rows. The two ends are looked up once per train, before the
    stops are unpacked. matches: name, station_code, canonical_name."""
    ends = _attach(trains, matches, "source", "source_code", "source_name")
    ends = _attach(ends, matches, "destination", "dest_code", "dest_name")
    out = _attach(packed_stops(ends), matches, "name", "station_code", "station_name")
    return out.withColumn("seq", F.col("pos") + 1).select(
        *STOP, "source_name", "dest_name", "classes", "running_days", "name"
    )


def station_names(stops: DataFrame) -> DataFrame:
    """Distinct names to resolve, control prefixes removed."""
    return stops.select(strip_control_prefix("name").alias("name")).distinct()


def new_schedule(df: DataFrame, master: DataFrame, groups: int = NAME_GROUPS) -> DataFrame:
    """Per-train rows with packed stops as flat, resolved stop rows."""
    trains = packed_trains(df)
    names = station_names(packed_stops(trains))
    return named_stops(trains, resolve_names(names, master, groups=groups))


def unresolved_names(stops: DataFrame) -> DataFrame:
    """Sorted distinct names without a station."""
    return (
        stops.where(F.col("station_code") == UNKNOWN).select(F.col("name").alias("Station"))
        .distinct().orderBy("Station")
    )
