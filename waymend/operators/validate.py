"""Structural report of a table of unknown layout: shape, counts, statistics, score."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions.fixed_values import REQUIRED_FIELDS
from waymend.functions.text import cell_text, count_packed_stops, grade
from waymend.roles import detect_columns, detect_shape



def statistics(df: DataFrame) -> DataFrame:
    """(measure, value) of a table whose shape is known; blanks are 'blank:<field>'.

    One chain of roll-ups over one scan: equal rows, then (train, sequence), then trains, then the
    table. Each distinct row is also a row of its station, which rides along as another kind of key.
    """
    shape, found = detect_shape(df), detect_columns(df)
    if shape is None:
        raise ValueError("the table is neither per stop nor per train")
    fields, per_stop = REQUIRED_FIELDS[shape], shape == "per_stop"
    names = {header: f"c{i}" for i, header in enumerate(df.columns)}

    def column(header):
        return F.col(names[header])

    equal = df.toDF(*names.values()).groupBy(*names.values()).agg(F.count(F.lit(1)).alias("n"))
    n, zero = F.col("n"), F.lit(0).cast("long")
    packed = not per_stop and "intermediate_stops" in df.columns
    stops = count_packed_stops(column("intermediate_stops")) if packed else F.lit(None).cast("long")
    blanks = {f"blank_{f}": F.when(cell_text(column(found[f])) == "", n).otherwise(zero) for f in fields}
    keys = [F.struct(
        F.lit("train").alias("kind"), column(found["train_number"]).cast("string").alias("key"),
        (column(found["sequence"]) if per_stop else F.lit(None)).cast("string").alias("seq"),
        n.alias("rows"), (n - 1).alias("copies"), stops.cast("long").alias("stops"), *[v.alias(k) for k, v in blanks.items()],
    )]
    if found["station_code"]:
        nothing = F.lit(None).cast("string")
        keys.append(F.struct(
            F.lit("station").alias("kind"), column(found["station_code"]).cast("string").alias("key"), nothing.alias("seq"),
            zero.alias("rows"), zero.alias("copies"), F.lit(None).cast("long").alias("stops"), *[zero.alias(k) for k in blanks],
        ))
    carried = ["rows", "copies", *blanks]
    # Packed stops: their sum, how many rows have them, and the extremes.
    extremes = [F.max("most").alias("most"), F.min("fewest").alias("fewest")]
    per_pair = equal.select(F.explode(F.array(*keys)).alias("k")).select("k.*").groupBy("kind", "key", "seq").agg(
        *[F.sum(c).alias(c) for c in carried], F.sum(F.col("stops") * F.col("rows")).alias("stops"),
        F.sum(F.when(F.col("stops").isNotNull(), F.col("rows"))).alias("counted"),
        F.max("stops").alias("most"), F.min("stops").alias("fewest"),
    )
    per_key = per_pair.groupBy("kind", "key").agg(
        *[F.sum(c).alias(c) for c in carried], F.sum(F.col("rows") - 1).alias("clashes"),
        F.coalesce(F.sum(F.when(F.col("seq").isNotNull(), F.col("rows"))), F.lit(0)).alias("length"),
        F.sum("stops").alias("stops"), F.sum("counted").alias("counted"), *extremes,
    )
    train, known = F.col("kind") == "train", F.col("key").isNotNull()

    def of_trains(value, condition=None):
        return F.when(train if condition is None else train & condition, value)

    def total(value, condition=None):
        return F.coalesce(F.sum(of_trains(value, condition)), F.lit(0))

    values = {
        "total_rows": total(F.col("rows")), **{k.replace("blank_", "blank:", 1): total(F.col(k)) for k in blanks},
        "duplicate_rows": total(F.col("copies")), "unique_trains": F.count(of_trains(F.lit(1), known)),
    }
    if found["station_code"]:
        values["unique_stations"] = F.count(F.when(~train & known, 1))
    if per_stop:
        values["duplicate_train_sequence_pairs"] = total(F.col("clashes"))
        length = of_trains(F.col("length"), known)
        values |= {
            "avg_stops_per_train": F.bround(F.avg(length), 2), "max_stops_for_a_train": F.max(length),
            "min_stops_for_a_train": F.min(length),
        }
    else:
        values["duplicate_train_number_rows"] = total(F.col("rows") - 1)
        if packed:
            values |= {
                "avg_stops_per_train": F.bround(F.sum(of_trains(F.col("stops"))) / F.sum(of_trains(F.col("counted"))), 2),
                "max_stops_for_a_train": F.max(of_trains(F.col("most"))), "min_stops_for_a_train": F.min(of_trains(F.col("fewest"))),
            }
    one = per_key.agg(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values.values())])
    pairs = [F.struct(F.lit(m).alias("measure"), F.col(f"v{i}").alias("value")) for i, m in enumerate(values)]
    return one.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def _points(count, base, factor, most):
    return F.least(F.lit(most), F.bround(count / base * factor, 0)).cast("bigint")


def score(stats: DataFrame, required: list) -> DataFrame:
    """One row: statistics, warnings and the 0-100 score, from (measure, value) rows."""
    one = stats.agg(F.map_from_entries(F.collect_list(F.struct("measure", "value"))).alias("s"))

    def value(name):
        return F.coalesce(F.try_element_at("s", F.lit(name)), F.lit(0.0))

    def number(c):
        return c.cast("bigint").cast("string")

    rows = F.greatest(value("total_rows"), F.lit(1.0))
    copies = value("duplicate_rows")
    clashes = F.coalesce(
        F.try_element_at("s", F.lit("duplicate_train_sequence_pairs")),
        F.try_element_at("s", F.lit("duplicate_train_number_rows")), F.lit(0.0),
    )
    blank = {f: value(f"blank:{f}") for f in required}
    blanks = sum(blank.values(), F.lit(0.0))
    listed = F.array_join(
        F.array(*[F.when(b > 0, F.concat(F.lit(f"{f}="), number(b))) for f, b in blank.items()]), ", "
    )

    def deduction(count, points, *reason):
        text = F.concat(*[F.lit(r) if isinstance(r, str) else r for r in reason])
        return F.when(count > 0, F.struct(text.alias("reason"), points.alias("points")))

    pair = F.try_element_at("s", F.lit("duplicate_train_sequence_pairs")).isNotNull()
    clash_text = F.when(pair, F.lit(" row(s) repeat a (train number, sequence) pair")).otherwise(
        F.lit(" row(s) repeat a train number")
    )
    warnings = [
        F.when(copies > 0, F.concat(number(copies), F.lit(" fully duplicated row(s)"))),
        F.when(clashes > 0, F.concat(number(clashes), clash_text)),
    ] + [
        F.when(b > 0, F.concat(number(b), F.lit(f" row(s) with a blank {f}"))) for f, b in blank.items()
    ]
    deductions = [
        deduction(copies, _points(copies, rows, 100, 20), number(copies), " fully duplicated row(s)"),
        deduction(clashes, _points(clashes, rows, 150, 30), number(clashes), " row(s) collide on the unique key"),
        deduction(
            blanks, _points(blanks, rows * max(len(required), 1), 100, 30),
            number(blanks), " blank required value(s): ", listed,
        ),
    ]

    def present(items):
        return F.filter(F.array(*items), lambda x: x.isNotNull())

    scored = one.select(
        F.col("s").alias("statistics"),
        present(warnings).alias("warnings"),
        present(deductions).alias("deductions"),
    )
    lost = F.aggregate("deductions", F.lit(0).cast("bigint"), lambda t, d: t + d["points"])
    return scored.withColumn("score", F.greatest(F.lit(0), F.lit(100) - lost).cast("bigint")).withColumn(
        "grade", grade("score")
    )


def validate(df: DataFrame, label: str = "dataset") -> DataFrame:
    """One-row report. An unrecognised layout is reported without reading the rows
    (apart from counting them)."""
    shape, found = detect_shape(df), detect_columns(df)
    detected = F.map_from_arrays(
        F.array(*[F.lit(k) for k in found]), F.array(*[F.lit(v).cast("string") for v in found.values()])
    )
    none = F.array().cast("array<string>")
    if shape is None:
        reason = "the layout is neither per stop (code and sequence) nor per train (source and destination)"
        quality = F.struct(
            F.lit(0).cast("bigint").alias("score"), F.lit("F").alias("grade"),
            F.array(F.struct(F.lit(reason).alias("reason"), F.lit(100).cast("bigint").alias("points"))).alias("deductions"),
        )
        out = df.agg(F.count("*").alias("total_rows")).select(
            F.lit(label).alias("label"), "total_rows", F.lit(len(df.columns)).alias("total_columns"),
            F.lit("unknown").alias("shape"), detected.alias("detected_columns"),
            none.alias("missing_required_fields"), F.array(F.lit(reason)).alias("errors"),
            none.alias("warnings"), F.create_map().cast("map<string,double>").alias("statistics"),
            quality.alias("quality_score"),
        )
    else:
        out = score(statistics(df), REQUIRED_FIELDS[shape]).select(
            F.lit(label).alias("label"),
            F.col("statistics")["total_rows"].cast("bigint").alias("total_rows"),
            F.lit(len(df.columns)).alias("total_columns"),
            F.lit(shape).alias("shape"), detected.alias("detected_columns"),
            none.alias("missing_required_fields"), none.alias("errors"), "warnings", "statistics",
            F.struct("score", "grade", "deductions").alias("quality_score"),
        )
    return out
