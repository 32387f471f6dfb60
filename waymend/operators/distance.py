"""Missing distances from known segment lengths, accepted only between two anchors.

``known`` has rows with a distance, ``needed`` rows without one; both in role columns
with ``row_id`` (dense in ``known``, whose file order defines the segments). Lengths
are whole micro-kilometres, so sums are exact and independent of any row order.

Both tables go through one ordered pass by train: (place, known before needed, later rows first).
The first row of a place speaks for it; the others only learn that they are not alone. The
needed rows carry their own columns, so nothing is joined back.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymend.functions import fixed_values as fv
from waymend.functions.text import cell_text, number_place, to_number, whole_digits
from waymend.operators.measures import measures, report, total
from waymend.operators.ordered import (
    HOT_ROWS, Ordered, hot_keys, previous_in_file, with_ordered,
)
from waymend.roles import BASE
from waymend.session import frozen

MICRO = 1_000_000


def micro(km):
    return F.bround(km * MICRO, 0).cast("bigint")


def segments(known: DataFrame) -> DataFrame:
    """(a, b, km): every pair of neighbouring file rows of a train with both distances.

    The pair of codes is unordered; km keeps its sign. A blank code in front yields
    no segment.
    """
    rows = known.select(
        "row_id", F.coalesce("train_no", F.lit("")).alias("train_no"),
        cell_text("station_code").alias("code"), to_number("distance").alias("dist"),
    )
    pairs = previous_in_file(rows, "row_id", ["train_no", "code", "dist"], "before")
    usable = (
        (F.col("before.train_no") == F.col("train_no"))
        & F.col("dist").isNotNull() & F.col("before.dist").isNotNull()
        & (F.col("before.code") != "")
    )
    return pairs.where(usable).select(
        F.least("code", "before.code").alias("a"),
        F.greatest("code", "before.code").alias("b"),
        F.bround(F.col("dist") - F.col("before.dist"), 2).alias("km"),
    )


def segment_lookup(known: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b, km): exact median per pair, from counts of equal lengths."""
    lengths = segments(known).groupBy("a", "b", "km").agg(F.count("*").alias("n"))
    placed = with_ordered(
        lengths, ["a", "b"], ["km"],
        {"upto": Ordered("running", F.col("n")), "all": Ordered("whole_sum", F.col("n"))},
        hot_rows,
    )
    low, high = F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1
    start = F.col("upto") - F.col("n")

    def holds(place):
        return (start < place) & (place <= F.col("upto"))

    return (
        placed.groupBy("a", "b")
        .agg(F.max(F.when(holds(low), F.col("km"))).alias("x"), F.max(F.when(holds(high), F.col("km"))).alias("y"))
        .select("a", "b", ((F.col("x") + F.col("y")) / 2).alias("km"))
    )


def tagged(needed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of both tables: ``train``, ``side`` (1 known), ``place`` (whole-number SEQ; null if the row is
    no stop of the route), ``code``, ``dist``, and the whole needed row as ``row``."""
    def read(df):
        """The number of a place stands in a column of its own: the sort key names it many times."""
        return df.withColumns({"_whole": whole_digits("seq"), "_dist": micro(to_number("distance"))})

    columns = [F.coalesce("train_no", F.lit("")).alias("train"), cell_text("station_code").alias("code")]
    place = number_place(F.col("_whole"))
    open_ = read(needed).select(
        *columns, place.alias("place"), F.lit(None).cast("bigint").alias("dist"), F.lit(0).alias("side"),
        # Known rows first, then the later row first.
        F.lit(0).alias("later"), (-F.col("row_id")).alias("back"), F.struct(*needed.columns).alias("row"),
    )
    dist = F.col("_dist")
    anchors = read(known).select(
        *columns, F.when(dist.isNotNull(), place).alias("place"), dist.alias("dist"), F.lit(1).alias("side"),
        F.lit(-1).alias("later"), (-F.col("row_id")).alias("back"), F.lit(None).cast(open_.schema["row"].dataType).alias("row"),
    )
    return open_.unionByName(anchors)


ORDER = ["place", "later", "back"]


def _chain(rows: DataFrame, lookup: DataFrame, verify_first: bool, hot_rows: int, hot) -> DataFrame:
    """One ordered pass; between its steps the rows of long trains are written."""
    def step(df, specs):
        out = with_ordered(df, ["train"], ORDER, specs, hot_rows, hot)
        return frozen(out) if hot[1] else out

    place, is_stop = F.col("place"), F.col("place").isNotNull()
    seen = step(rows, {
        "before": Ordered("previous", F.struct("place")), "behind": Ordered("following", F.struct("place")),
        "known_place": Ordered("last_before", F.when(F.col("side") == 1, place)),
    })
    after_same = is_stop & F.col("before.place").eqNullSafe(place)
    seen = seen.withColumns({
        "leads": is_stop & ~F.col("before.place").eqNullSafe(place),
        "several": after_same | (is_stop & F.col("behind.place").eqNullSafe(place)),
        "covered": is_stop & F.col("known_place").eqNullSafe(place),
    }).drop("before", "behind", "known_place")
    leads = F.col("leads")
    paced = step(seen, {
        "pos": Ordered("running", leads.cast("bigint")), "last": Ordered("last_before", F.when(leads, F.struct("code"))),
    })
    first = F.col("pos") == 1
    start = F.col("dist") if verify_first else F.when(first, F.coalesce("dist", F.lit(0))).otherwise(F.col("dist"))
    linked = leads & ~first
    keyed = paced.withColumns({
        "dist": F.when(leads, start),
        # Rows without a segment match nothing (no ``b``); a hash in place of ``a`` keeps them from meeting in one task.
        "a": F.when(linked, F.least("code", "last.code")).otherwise(F.xxhash64("train", *ORDER).cast("string")),
        "b": F.when(linked, F.greatest("code", "last.code")),
    }).drop("last")
    measured = keyed.join(lookup.select("a", "b", micro(F.col("km")).alias("step")), ["a", "b"], "left")
    summed = step(measured, {
        "upto": Ordered("running", F.col("step")),
        "gaps": Ordered("running", (linked & F.col("step").isNull()).cast("bigint")),
    })
    anchor = F.when(F.col("dist").isNotNull(), F.struct(F.col("place.whole").alias("place"), "pos", "dist", "upto", "gaps"))
    return step(summed, {"opener": Ordered("last_before", anchor), "closer": Ordered("next_after", anchor)})


def chained(needed, known, lookup, verify_first=False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows of both tables with the anchors around them and the lengths summed so far.

    A first stop without distance is an anchor at 0 unless ``verify_first``.
    """
    rows = tagged(needed, known)
    hot, total = hot_keys(rows.select("train"), ["train"], hot_rows)
    if not total:
        return _chain(rows, lookup, verify_first, hot_rows, (hot, 0))
    small, large = rows.join(hot, "train", "left_anti"), rows.join(hot, "train", "left_semi")
    return _chain(small, lookup, verify_first, hot_rows, (hot, 0)).unionByName(
        _chain(large, lookup, verify_first, hot_rows, (hot, total))
    )


def _chain_columns(end):
    """Sum, known gap and status of the chain from ``opener`` to the struct/row ``end``."""
    total = end("upto") - F.col("opener.upto")
    gap = end("dist") - F.col("opener.dist")
    complete = end("gaps") == F.col("opener.gaps")
    close = F.abs(total - gap) <= int(fv.DISTANCE_TOLERANCE_KM * MICRO)
    status = (
        F.when(~complete, fv.CHAIN_GAP)
        .when(close, fv.CHAIN_FILLED)
        .otherwise(fv.CHAIN_INCONSISTENT)
    )
    return total, gap, complete, status


def _chain_ends():
    """Rows that close a chain with at least one stop between its two anchors."""
    return F.col("dist").isNotNull() & F.col("opener").isNotNull() & (F.col("pos") - F.col("opener.pos") > 1)


def chain_log(chains: DataFrame) -> DataFrame:
    """One row per chain with at least one stop between its two anchors, of trains that need something.

    Trains without needed rows have anchors only, so no stop lies between two of theirs.
    """
    total, gap, complete, status = _chain_columns(F.col)
    return chains.where(_chain_ends()).select(
        F.col("train").alias("train_no"),
        F.col("opener.place").alias("from_seq"),
        F.col("place.whole").alias("to_seq"),
        status.alias("status"),
        F.when(complete, F.bround(total / MICRO, 2)).alias("chain_sum"),
        F.when(complete, F.bround(gap / MICRO, 2)).alias("known_gap"),
    )


def filled_value() -> Column:
    """Micro-km of a place that is resolved: its own distance, or the sum of a verified chain."""
    _, _, _, status = _chain_columns(lambda c: F.col(f"closer.{c}"))
    between = F.col("opener").isNotNull() & F.col("closer").isNotNull() & (status == fv.CHAIN_FILLED)
    return F.when(F.col("dist").isNotNull(), F.col("dist")).when(
        between, F.col("opener.dist") + F.col("upto") - F.col("opener.upto")
    )


def whole_km(value):
    """Micro-km to the nearest whole number, halves to the even one, as text."""
    down = F.floor(value / F.lit(MICRO)).cast("bigint")
    rest = value - down * MICRO
    up = (rest > MICRO // 2) | ((rest == MICRO // 2) & (F.pmod(down, F.lit(2)) == 1))
    return (down + up.cast("bigint")).cast("string")


def fill_status() -> Column:
    return (
        F.when(F.col("place").isNull(), "bad_seq")
        .when(F.col("covered"), "already_known")
        .when(F.col("several"), "duplicate_seq")
        .when(filled_value().isNull(), "open")
        .otherwise("filled")
    )


def fill_distances(chains: DataFrame) -> DataFrame:
    """The needed rows of ``chained`` with ``fill_status`` and, where filled, the new distance text.

    filled; open (no verified chain); already_known (a known row has this SEQ);
    duplicate_seq (several needed rows share the SEQ); bad_seq (no whole number).
    Only ``filled`` rows may move.
    """
    columns = chains.schema["row"].dataType.names
    rows = chains.where("side = 0").select(
        "row.*", fill_status().alias("fill_status"), whole_km(filled_value()).alias("_new")
    )
    distance = F.when(F.col("fill_status") == "filled", F.col("_new")).otherwise(F.col("distance"))
    return rows.withColumn("distance", distance).select(*columns, "fill_status")


def placed_rows(known: DataFrame, filled: DataFrame) -> DataFrame:
    """Rows of both tables with ``table``: the one (known, needed) that each belongs to now."""
    place = F.when(F.col("fill_status") == "filled", "known").otherwise("needed")
    return known.select(*BASE, F.lit("known").alias("table")).unionByName(filled.select(*BASE, place.alias("table")))


def move_filled(known: DataFrame, filled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known with the filled rows appended, needed rows that stay)."""
    rows = placed_rows(known, filled)
    return rows.where("table = 'known'").select(*BASE), rows.where("table = 'needed'").select(*BASE)


FILL_STATUSES = ["filled", "open", "already_known", "duplicate_seq", "bad_seq"]


def fill_log(chains: DataFrame, lookup: DataFrame) -> DataFrame:
    """(measure, value) rows of a distance fill: one roll-up of the pass, by train and then over all.

    Statuses that no row or chain has are left out.
    """
    needed, status = F.col("side") == 0, fill_status()
    _, _, _, chain_status = _chain_columns(F.col)
    chain_kinds = (fv.CHAIN_GAP, fv.CHAIN_FILLED, fv.CHAIN_INCONSISTENT)
    number = F.when(needed, F.struct(F.col("row.train_no").alias("n")))
    per_train = chains.withColumns({"_status": F.when(needed, status), "_number": number}).groupBy("train", "_number").agg(
        *[total(F.col("_status") == s).alias(s) for s in FILL_STATUSES],
        total(~needed).alias("known"),
        *[total(_chain_ends() & (chain_status == s)).alias(f"chain_{s}") for s in chain_kinds],
    )
    rows = reduce(lambda a, b: a + b, [F.col(s) for s in FILL_STATUSES])
    of_rows = measures(
        per_train,
        {
            "trains_processed": total(rows > 0), "trains_with_at_least_one_fill": total(F.col("filled") > 0),
            "rows_before": F.sum(rows), "known_rows_before": F.sum("known"),
            "known_rows_after": F.sum(F.col("known") + F.col("filled")),
            **{f"rows:{s}": F.sum(s) for s in FILL_STATUSES},
            **{f"chains:{s}": F.sum(f"chain_{s}") for s in chain_kinds},
        },
    ).where(~F.col("measure").rlike("^(rows|chains):") | (F.col("value") > 0))
    return report(measures(lookup, {"segment_lookup_size": total()}), of_rows)
