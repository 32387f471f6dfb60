"""Fill two sibling tables from each other and merge them, whole trains at a time.

Both tables are brought together by train, tagged and united. One narrow aggregate over
(train, station) finds what each side has to offer and what each side lacks; its roll-up by train
decides which side keeps a train. The whole rows travel by train once: what a pair's other side
offers is a window over the pair, the decision is joined by train, and equal rows, which are rows
of one train, are dropped without another shuffle. So each table is read twice.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymend.functions import fixed_values as fv
from waymend.operators.keyed import drop_duplicates_keep_first
from waymend.operators.measures import measures, total
from waymend.roles import BASE, align_schema

FIELDS = ["arrival", "departure", "distance"]
KEY = ["train_no", "station_code"]
MERGED_COLUMNS = BASE + [
    "source_dataset", "timing_source", "validation_status", "reference_name", "code_suggestion",
]


def unique_lookup(df: DataFrame) -> DataFrame:
    """Fields of the (train, station) pairs that occur exactly once; no null keys."""
    return (
        df.where("train_no is not null and station_code is not null")
        .groupBy(*KEY)
        .agg(F.count("*").alias("n"), *[F.max(f).alias(f"other_{f}") for f in FIELDS])
        .where("n = 1").drop("n")
    )


def _fills(field):
    return F.col(field).isNull() & F.col(f"other_{field}").isNotNull()


def cross_fill(df: DataFrame, sibling: DataFrame) -> DataFrame:
    """Null fields from the sibling's unambiguous row; ``filled`` lists what was filled."""
    joined = df.join(unique_lookup(sibling), KEY, "left")
    filled = F.filter(
        F.array(*[F.when(_fills(f), F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull()
    )
    return joined.withColumn("filled", filled).withColumns(
        {f: F.coalesce(f, f"other_{f}") for f in FIELDS}
    ).select(
        *df.columns,
        F.when(F.size("filled") > 0, fv.FILLED).otherwise(fv.ORIGINAL).alias("timing_source"),
        "filled",
    )


def fill_counts(filled: DataFrame) -> DataFrame:
    """(field, n): values filled per field."""
    return filled.agg(
        *[F.coalesce(F.sum(F.array_contains("filled", f).cast("long")), F.lit(0)).alias(f) for f in FIELDS]
    ).select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in FIELDS])).alias("x")
    ).select("x.*")


def tagged(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows of both tables with ``side`` 1 or 2 and ``of_side``, how many rows their train has on that side.

    Counted before the union, so that a table that comes by train is not shuffled again.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy("train_no"))
    first, second = [df.withColumns({"side": F.lit(i), "of_side": count}) for i, df in ((1, one), (2, two))]
    return first.unionByName(second, allowMissingColumns=True)


def _added(values) -> Column:
    return reduce(lambda a, b: a + b, values)


def pair_sides(rows: DataFrame) -> DataFrame:
    """One row per (train, station) of the tagged rows: what each side offers, lacks and gets.

    only1_*, only2_*: fields of the side's row if it is the only one (never for a null key); rows1, rows2;
    of_train1, of_train2: rows of the whole train (null if none);
    missing1, missing2: null fields after filling (0 without a train number); fills1_*, fills2_*:
    values filled by field; filled1, filled2: rows that got any.
    """
    lacks = _added(F.when(F.col(f).isNull(), 1 << i).otherwise(0) for i, f in enumerate(FIELDS))
    marked = rows.select(*KEY, "side", "of_side", *FIELDS, lacks.alias("lacks"))
    patterns = range(1, 1 << len(FIELDS))
    counts = []
    for side in (1, 2):
        own = F.col("side") == side
        counts += [total(own).alias(f"rows{side}"), *[F.max(F.when(own, F.col(f))).alias(f"{f}{side}") for f in FIELDS]]
        counts += [total(own & (F.col("lacks") == p)).alias(f"lacks{side}_{p}") for p in patterns]
        counts += [F.max(F.when(own, F.col("of_side"))).alias(f"of_train{side}")]
    pairs = marked.groupBy(*KEY).agg(*counts)
    keyed = F.col("train_no").isNotNull() & F.col("station_code").isNotNull()
    pairs = pairs.withColumns({
        f"only{side}_{f}": F.when(keyed & (F.col(f"rows{side}") == 1), F.col(f"{f}{side}")) for side in (1, 2) for f in FIELDS
    })
    values = {}
    for side, other in ((1, 2), (2, 1)):
        offered = [F.col(f"only{other}_{f}").isNotNull() for f in FIELDS]

        def rows_lacking(p, side=side):
            return F.col(f"lacks{side}_{p}")

        lacking = [_added(rows_lacking(p) for p in patterns if p >> i & 1) for i in range(len(FIELDS))]
        open_ = _added(F.when(o, 0).otherwise(n) for o, n in zip(offered, lacking, strict=True))
        values[f"missing{side}"] = F.when(F.col("train_no").isNull(), 0).otherwise(open_)
        values |= {f"fills{side}_{f}": F.when(o, n).otherwise(0) for f, o, n in zip(FIELDS, offered, lacking, strict=True)}
        values[f"filled{side}"] = _added(
            F.when(reduce(lambda a, b: a | b, [o for i, o in enumerate(offered) if p >> i & 1]), rows_lacking(p)).otherwise(0)
            for p in patterns
        )
    return pairs.withColumns(values)


SIDE_SUMS = [x for side in (1, 2) for x in (f"missing{side}", *[f"fills{side}_{f}" for f in FIELDS], f"filled{side}")]


def train_sides(rows: DataFrame) -> DataFrame:
    """One row per train of the tagged rows: its rows1, rows2 and the sums of ``pair_sides`` (rows without a train
    number are one train)."""
    return pair_sides(rows).groupBy("train_no").agg(
        *[F.coalesce(F.max(f"of_train{side}"), F.lit(0)).alias(f"rows{side}") for side in (1, 2)],
        *[F.sum(c).alias(c) for c in SIDE_SUMS],
    )


def kept_side() -> Column:
    """Which side keeps a train of both tables: the one with fewer missing fields; 0 for other trains."""
    shared = (F.col("rows1") > 0) & (F.col("rows2") > 0)
    return F.when(shared, F.when(F.col("missing1") <= F.col("missing2"), 1).otherwise(2)).otherwise(0)


def overlap_decisions(one: DataFrame, two: DataFrame) -> DataFrame:
    """Trains of both tables, their missing fields, and which table keeps the train."""
    names = {1: "dataset1", 2: "dataset2"}
    decided = train_sides(tagged(one, two)).withColumn("kept", kept_side()).where("kept > 0")
    first = F.col("kept") == 1
    return decided.select(
        "train_no",
        F.when(first, names[1]).otherwise(names[2]).alias("kept_source"),
        F.when(first, names[2]).otherwise(names[1]).alias("dropped_source"),
        F.col("missing1").alias("dataset1_missing_fields"), F.col("missing2").alias("dataset2_missing_fields"),
    )


def united(one: DataFrame, two: DataFrame) -> DataFrame:
    """All rows of both tables, filled from each other: ``side``, ``timing_source``, ``filled`` and
    ``kept`` (the side that keeps the row's train, 0 if only one table has it)."""
    rows = tagged(one, two)
    # A key that only the decided trains have: nothing to filter before the shuffles, so both tables share theirs.
    second = train_sides(rows).select(F.when(kept_side() == 2, F.col("train_no")).alias("second")).where("second is not null")
    of_both = F.count(F.lit(1)).over(Window.partitionBy("train_no"))
    pair, keyed = Window.partitionBy(*KEY), F.col("train_no").isNotNull() & F.col("station_code").isNotNull()
    first, sides = F.col("side") == 1, {side: F.col("side") == side for side in (1, 2)}
    offered = rows.withColumns({
        **{f"rows{side}": total(own).over(pair) for side, own in sides.items()},
        **{f"{f}{side}": F.max(F.when(own, F.col(f))).over(pair) for side, own in sides.items() for f in FIELDS},
    }).withColumns({
        f"other_{f}": F.when(first & keyed & (F.col("rows2") == 1), F.col(f"{f}2"))
        .when(~first & keyed & (F.col("rows1") == 1), F.col(f"{f}1")) for f in FIELDS
    })
    # A tie is kept by the first side, and so are the rows without a train number, which miss nothing.
    kept = F.when(F.col("of_side") < of_both, F.when(F.col("second").isNotNull(), 2).otherwise(1)).otherwise(0)
    joined = offered.join(second, F.col("train_no") == F.col("second"), "left").withColumn("kept", kept)
    filled = F.filter(F.array(*[F.when(_fills(f), F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull())
    return joined.withColumn("filled", filled).withColumns({f: F.coalesce(f, f"other_{f}") for f in FIELDS}).select(
        *[c for c in rows.columns if c != "of_side"],
        F.when(F.size("filled") > 0, fv.FILLED).otherwise(fv.ORIGINAL).alias("timing_source"), "filled", "kept",
    )


def _stays() -> Column:
    return (F.col("kept") == 0) | (F.col("kept") == F.col("side"))


def merge_sources(rows: DataFrame) -> DataFrame:
    """The merged table of ``united`` rows: no two rows equal on the twelve base columns."""
    source = F.when(F.col("side") == 1, fv.FIRST_SOURCE).otherwise(fv.SECOND_SOURCE)
    stay = rows.where(_stays()).withColumn("source_dataset", source)
    both = align_schema(stay, MERGED_COLUMNS + ["side", "row_id"])
    return drop_duplicates_keep_first(both, BASE, ["side", "row_id"]).select(MERGED_COLUMNS)


def merge_log(rows: DataFrame) -> DataFrame:
    """(measure, value) rows of the merge of ``united`` rows.

    One chain of roll-ups: equal rows, then each train and each station, then the table.
    """
    sides = {side: F.col("side") == side for side in (1, 2)}
    touched = F.col("timing_source") == fv.FILLED
    sums = {
        "kept_rows": total(_stays()), "filled2": total(sides[2] & touched),
        **{f"rows{side}": total(own) for side, own in sides.items()},
        **{f"fills{side}_{f}": total(own & F.array_contains("filled", f)) for side, own in sides.items() for f in FIELDS},
    }
    equal = rows.groupBy(*BASE).agg(F.max("kept").alias("kept"), *[v.alias(k) for k, v in sums.items()])
    merged = (F.col("kept_rows") > 0).cast("long").alias("merged")
    # Each distinct row belongs to a train and to a station; only the train carries the counts.
    keys = equal.select(F.explode(F.array(
        F.struct(F.lit("train").alias("kind"), F.col("train_no").alias("key"), merged, "kept", *sums),
        F.struct(F.lit("station").alias("kind"), F.col("station_code").alias("key"), merged, F.lit(0).alias("kept"),
                 *[F.lit(0).cast("long").alias(c) for c in sums]),
    )).alias("k")).select("k.*")
    per_key = keys.groupBy("kind", "key").agg(
        F.max("kept").alias("kept"), *[F.sum(c).alias(c) for c in ("merged", *sums)]
    )
    train, first = F.col("kind") == "train", F.col("kept") == 1

    def summed(c, condition=None):
        return F.coalesce(F.sum(F.when(train if condition is None else train & condition, F.col(c))), F.lit(0))

    of_table = {
        fv.MERGE_BOTH: total(train & (F.col("kept") > 0)), fv.MERGE_KEPT[1]: total(train & first),
        fv.MERGE_KEPT[2]: total(train & (F.col("kept") == 2)),
    }
    for side in (1, 2):
        of_table[fv.MERGE_ROWS[side]] = summed(f"rows{side}")
        of_table[fv.MERGE_TRAINS[side]] = total(train & (F.col(f"rows{side}") > 0))
        of_table |= {f"{fv.MERGE_FILLS[side]}:{f}": summed(f"fills{side}_{f}") for f in FIELDS}
    present = (F.col("merged") > 0) & F.col("key").isNotNull()
    of_table |= {
        fv.MERGE_FILLED_DROPPED: summed("filled2", first), fv.MERGE_FILLED_RETAINED: summed("filled2", ~first),
        fv.MERGE_REMOVED: summed("kept_rows") - summed("merged"),
        fv.MERGED_ROWS: summed("merged"), fv.MERGED_TRAINS: total(train & present),
        fv.MERGED_STATIONS: total(~train & present),
    }
    return measures(per_key, of_table)


def decision_sample(decisions: DataFrame, count: int = 25) -> DataFrame:
    """First decisions by train number, for the log."""
    return decisions.orderBy("train_no").limit(count)
