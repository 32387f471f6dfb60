"""What changed between two schedules, and the rows to import because of it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.operators.ordered import HOT_ROWS, Ordered, with_ordered

# Kinds of change, header kinds first, in reporting order.
HEADER_KINDS = ["TRAIN_NAME", "SOURCE", "DESTINATION", "STOP_COUNT"]
STOP_KINDS = ["ROUTE", "ARRIVAL", "DEPARTURE", "DISTANCE"]

IMPORT_HEADERS = {
    "train_no": "Train No", "train_name": "Train Name", "seq": "SEQ",
    "station_code": "Station Code", "station_name": "Station Name",
    "arrival": "Arrival Time", "departure": "Departure Time", "distance": "Distance",
    "source_code": "Source Station", "source_name": "Source Station Name",
    "dest_code": "Destination Station", "dest_name": "Destination Station Name",
    "classes": "Classes", "running_days": "Running Days",
}


HEADER = ["train_name", "source_code", "dest_code"]
FIELDS = ["station_code", "arrival", "departure", "distance"]


def tagged_stops(old: DataFrame, new: DataFrame) -> DataFrame:
    """What a difference looks at, of both schedules (``side`` old or new). Header fields count on
    the first stop, which every train has."""
    first = F.col("pos") == 0

    def side(stops, name):
        return stops.select("train_no", "pos", F.lit(name).alias("side"), *[F.when(first, F.col(h)).alias(h) for h in HEADER], *FIELDS)

    return side(old, "old").unionByName(side(new, "new"))


SIDES = ("old", "new")


def fingerprints(stops: DataFrame) -> DataFrame:
    """train_no, old_stops, new_stops, same: whether both schedules have the very same stops.

    A stop's hash covers its place, so the xor of a train's hashes depends on the order of its
    stops; it is one aggregate with partial sums. Two hashes and the number of stops have to agree.
    """
    values = [F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in (*HEADER, *FIELDS)]
    hashed = stops.select(
        "train_no", "side", F.xxhash64("pos", *values).alias("h"), F.xxhash64(F.lit(7), *values, "pos").alias("g")
    )

    def of(name, value):
        return F.when(F.col("side") == name, value)

    per_train = hashed.groupBy("train_no").agg(*[
        x.alias(f"{name}_{what}") for name in SIDES for what, x in (
            ("stops", F.count(of(name, 1))), ("h", F.bit_xor(of(name, F.col("h")))), ("g", F.bit_xor(of(name, F.col("g")))),
        )
    ])
    same = [F.col(f"old_{x}").eqNullSafe(F.col(f"new_{x}")) for x in ("stops", "h", "g")]
    return per_train.select("train_no", "old_stops", "new_stops", (same[0] & same[1] & same[2]).alias("same"))


def _both():
    return (F.col("old_stops") > 0) & (F.col("new_stops") > 0)


def stops_to_compare(stops: DataFrame) -> DataFrame:
    """All stops of trains of both tables whose fingerprints differ; of other trains the first stop."""
    return stops.join(fingerprints(stops), "train_no").where((_both() & ~F.col("same")) | (F.col("pos") == 0))


def schedule_status(old: DataFrame, new: DataFrame) -> DataFrame:
    """train_no, status (new, updated, unchanged, missing), changes (array).

    Only trains that changed are compared place by place (places are unique on both sides). Stop
    kinds come in the order of the place they first differ at.
    """
    both, compared = _both(), stops_to_compare(tagged_stops(old, new))
    fields = F.struct(*HEADER, *FIELDS)
    per_place = compared.groupBy("train_no", "pos").agg(
        *[F.max(F.when(F.col("side") == name, fields)).alias(name) for name in SIDES],
        F.max("old_stops").alias("old_stops"), F.max("new_stops").alias("new_stops"),
    )

    def differs(f):
        return F.col(f"old.{f}") != F.col(f"new.{f}")

    tests = {kind: differs(f) for kind, f in zip(STOP_KINDS, FIELDS, strict=True)}
    tests["DISTANCE"] = tests["DISTANCE"] & (F.col("old.distance") != "") & (F.col("new.distance") != "")
    per_train = per_place.groupBy("train_no").agg(
        F.max("old_stops").alias("old_stops"), F.max("new_stops").alias("new_stops"),
        *[F.min(F.when(differs(h), F.lit(-1).cast("bigint"))).alias(k) for k, h in zip(HEADER_KINDS, HEADER)],
        *[F.min(F.when(test, F.col("pos"))).alias(kind) for kind, test in tests.items()],
    ).withColumn(
        "STOP_COUNT", F.when(F.col("old_stops") != F.col("new_stops"), F.lit(-1).cast("bigint"))
    )
    entries = [
        F.when(
            F.col(kind).isNotNull(),
            F.struct(F.col(kind).alias("pos"), F.lit(i).alias("rank"), F.lit(kind).alias("kind")),
        )
        for i, kind in enumerate(HEADER_KINDS + STOP_KINDS)
    ]
    found = F.array_sort(F.filter(F.array(*entries), lambda x: x.isNotNull()))
    changes = F.when(both, F.transform(found, lambda x: x["kind"])).otherwise(F.array().cast("array<string>"))
    status = (
        F.when(F.col("old_stops") == 0, "new").when(F.col("new_stops") == 0, "missing")
        .when(F.size("changes") > 0, "updated").otherwise("unchanged")
    )
    return per_train.withColumn("changes", changes).select("train_no", status.alias("status"), "changes")


def status_totals(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"))


def import_rows(new: DataFrame, status: DataFrame) -> DataFrame:
    """All stops of new and updated trains, ends taken from the first and last stop."""
    wanted = status.where(F.col("status").isin("new", "updated")).select("train_no")
    placeholder = {
        "arrival": F.when(F.lower("arrival") == "first", "").otherwise(F.col("arrival")),
        "departure": F.when(F.lower("departure") == "last", "").otherwise(F.col("departure")),
    }
    rows = new.join(wanted, "train_no", "left_semi").withColumns(placeholder)
    return rows.select(*[F.col(c).alias(h) for c, h in IMPORT_HEADERS.items()])


def with_stop_ends(stops: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Source and destination columns from the first and last stop of each train, for
    schedules whose declared ends may differ from them."""
    stop = F.struct("pos", "station_code", "station_name")
    ends = {"_a": Ordered("whole_min", stop), "_b": Ordered("whole_max", stop)}
    names = {
        "source_code": F.col("_a.station_code"), "source_name": F.col("_a.station_name"),
        "dest_code": F.col("_b.station_code"), "dest_name": F.col("_b.station_name"),
    }
    known = stops.where("train_no is not null")
    return with_ordered(known, ["train_no"], ["pos"], ends, hot_rows).withColumns(names).drop("_a", "_b")
