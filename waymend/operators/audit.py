"""Row-level audit of a per-stop table: flags with category, detail and severity.

Input: the role columns of ``waymend.roles.BASE`` (only the empty text is null) and
``row_id``. Every rule yields rows (row_id, train_no, category, detail, severity).
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymend.functions.text import (
    cell_text, codes_are_aliases, has_encoding_issue, is_blank, is_clock, number_place, to_number, whole_text,
)
from waymend.operators.keyed import join_on_keys, repeated_rows, rows_of_repeated_keys
from waymend.operators.ordered import HOT_ROWS, Ordered, hot_keys, position, with_ordered
from waymend.roles import BASE, BASE_HEADERS

REQUIRED = ["train_no", "train_name", "seq", "station_code", "station_name"]
OPTIONAL = [c for c in BASE if c not in REQUIRED]

CRITICAL, WARNING, INFO = "critical", "warning", "info"
FLAG_COLUMNS = ["row_id", "train_no", "category", "detail", "severity"]


def shown(c):
    """Text of a value inside a detail; null prints as 'nan'."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("nan"))


def _flag(rule, category, severity, *detail):
    parts = [F.lit(d) if isinstance(d, str) else d for d in detail]
    return F.when(
        rule,
        F.struct(
            F.lit(category).alias("category"),
            F.concat(*parts).alias("detail"),
            F.lit(severity).alias("severity"),
        ),
    )


def _exploded(df: DataFrame, rules: list) -> DataFrame:
    """All rules in one pass over the rows."""
    hits = F.filter(F.array(*rules), lambda r: r.isNotNull())
    flags = df.select("row_id", "train_no", F.explode(hits).alias("_f")).select(
        "row_id", "train_no", "_f.category", "_f.detail", "_f.severity"
    )
    # A train number that is missing is reported as the empty text.
    no_number = (F.col("category") == "missing_required_value") & F.col("detail").endswith(BASE_HEADERS["train_no"])
    return flags.withColumn("train_no", F.when(no_number, F.lit("")).otherwise(F.col("train_no")))


def code_format_rule():
    return F.col("station_code").isNotNull() & ~F.col("station_code").rlike(r"^[A-Z0-9]{2,6}$")


def malformed_train_rule():
    return F.coalesce(~F.col("train_no").rlike(r"^\d+$"), F.lit(True))


def row_rules() -> list:
    """Rules that look at one row only."""
    return [
        _flag(is_blank(c), "missing_required_value", CRITICAL, f"no value in required column {BASE_HEADERS[c]}")
        for c in REQUIRED
    ] + [
        _flag(is_blank(c), "missing_optional_value", WARNING, f"no value in column {BASE_HEADERS[c]}")
        for c in OPTIONAL
    ] + [
        _flag(
            malformed_train_rule(), "malformed_row_non_numeric_train_no", CRITICAL,
            "train number ", shown("train_no"), " is not a plain number; the row may be a split-off piece",
        ),
        _flag(
            code_format_rule(), "station_code_format", WARNING,
            "code ", shown("station_code"), " is not 2-6 capital letters or digits",
        ),
        _flag(
            has_encoding_issue("station_name"), "encoding_or_whitespace_issue", INFO,
            "name ", shown("station_name"), " has control, stray blank or non-ASCII characters",
        ),
    ]


def row_flags(df: DataFrame) -> DataFrame:
    return _exploded(df, row_rules())


def _constant_flags(rows: DataFrame, category, severity, *detail) -> DataFrame:
    parts = [F.lit(d) if isinstance(d, str) else d for d in detail]
    return rows.select(
        "row_id", "train_no",
        F.lit(category).alias("category"),
        F.concat(*parts).alias("detail"),
        F.lit(severity).alias("severity"),
    )


# What the duplicate rules say; used by the pass over trains and by the rules on their own.
REPEATED_ROW = ["duplicate_exact_row", CRITICAL, "all fields equal another row"]


def repeated_seq():
    return [
        "duplicate_train_seq", CRITICAL, "seq ", shown("seq"), " repeats on train ", shown("train_no")
    ]


def repeated_stop():
    return [
        "duplicate_stop_on_train", WARNING,
        "station ", shown("station_code"), " repeats on train ", shown("train_no"), "; a loop is possible",
    ]


def duplicate_row_flags(df: DataFrame) -> DataFrame:
    """Only rows whose hash repeats are compared in full, so unique rows never travel."""
    return _constant_flags(repeated_rows(df, BASE), *REPEATED_ROW)


def duplicate_seq_flags(df: DataFrame) -> DataFrame:
    rows = rows_of_repeated_keys(df.select("row_id", "train_no", "seq"), ["train_no", "seq"])
    return _constant_flags(rows, *repeated_seq())


def duplicate_stop_flags(df: DataFrame) -> DataFrame:
    rows = rows_of_repeated_keys(
        df.select("row_id", "train_no", "station_code"), ["train_no", "station_code"]
    )
    return _constant_flags(rows, *repeated_stop())


def seq_order():
    """``seq_num`` and, where a double cannot tell whole numbers apart, ``seq_long``."""
    text = cell_text("seq")
    digits = F.regexp_replace(text, "^0+(?=.)", "")
    long = text.rlike(r"^\d{16,}\z")
    return [
        to_number("seq").alias("seq_num"),
        F.when(long, F.struct(F.length(digits).alias("n"), digits.alias("digits"))).alias("seq_long"),
    ]


def ordered_stops(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with a train number plus what the ordered rules need to know.

    Stops are ordered by numeric SEQ of any length (nulls last), equal ones by ``row_id``.
    """
    stops = df.where(F.col("train_no").isNotNull()).select(
        "row_id", "train_no", "seq", "station_code", "arrival", "departure", "distance",
        "source_code", "dest_code",
        *seq_order(),
        to_number("distance").alias("dist_num"),
    )
    seen = F.struct("seq", "distance", "dist_num")
    return with_ordered(
        stops, ["train_no"], ["seq_num", "seq_long", "row_id"],
        {
            "pos": position(),
            "before": Ordered("previous", seen),
            "stops": Ordered("whole_sum", F.lit(1)),
            "src_low": Ordered("whole_min", F.col("source_code")),
            "src_high": Ordered("whole_max", F.col("source_code")),
            "dst_low": Ordered("whole_min", F.col("dest_code")),
            "dst_high": Ordered("whole_max", F.col("dest_code")),
        },
        hot_rows,
    )


def ordered_rules(alias_pairs=None) -> list:
    """Rules along the stops of a train, except the numbering rule; for the columns of ``ordered_stops``.

    A train with one row gets ``single_stop_train`` and nothing else.
    """
    many = F.col("stops") > 1
    first, last = (F.col("pos") == 1) & many, (F.col("pos") == F.col("stops")) & many
    middle = (F.col("pos") > 1) & (F.col("pos") < F.col("stops"))
    dist, before = F.col("dist_num"), F.col("before.dist_num")

    def real_time(c):
        return F.coalesce(~F.col(c).isin("00:00:00", "nan", "None", ""), F.lit(False))

    torn = F.coalesce(F.col("src_low") != F.col("src_high"), F.lit(False)) | F.coalesce(
        F.col("dst_low") != F.col("dst_high"), F.lit(False)
    )

    def end_differs(declared):
        d, actual = F.col(declared), F.col("station_code")
        return ~torn & F.coalesce(d != "", F.lit(False)) & ~d.eqNullSafe(actual)

    def end_detail(label, declared):
        return [f"declared {label} ", shown(declared), " but the stop there is ", shown("station_code")]

    def end_rules(place, label, declared, category):
        alias = codes_are_aliases(F.col(declared), F.col("station_code"), alias_pairs)
        differs = place & end_differs(declared)
        return [
            _flag(differs & ~alias, category, CRITICAL, *end_detail(label, declared)),
            _flag(differs & alias, "known_code_alias_inconsistency", INFO, *end_detail(label, declared)),
        ]

    return [
        _flag(F.col("stops") == 1, "single_stop_train", CRITICAL, "the train has one stop only"),
        _flag(
            many & dist.isNotNull() & (dist < before), "distance_not_monotonic", CRITICAL,
            "distance ", shown("distance"), " at seq ", shown("seq"),
            " after ", shown("before.distance"), " at seq ", shown("before.seq"),
        ),
        _flag(
            first & (dist != 0), "origin_distance_not_zero", WARNING,
            "first stop has distance ", shown("distance"),
        ),
        _flag(
            first & real_time("arrival"), "origin_arrival_not_placeholder", WARNING,
            "first stop has arrival time ", shown("arrival"),
        ),
        _flag(
            last & real_time("departure"), "terminus_departure_not_placeholder", WARNING,
            "last stop has departure time ", shown("departure"),
        ),
        _flag(
            middle & is_clock("arrival") & is_clock("departure")
            & (F.col("departure") < F.col("arrival")),
            "departure_before_arrival", INFO,
            "departs ", shown("departure"), " before arriving ", shown("arrival"),
            " at seq ", shown("seq"), "; a halt over midnight is possible",
        ),
        _flag(
            first & torn, "inconsistent_declared_src_dst", CRITICAL,
            "declared source ", shown("src_low"), "..", shown("src_high"),
            ", declared destination ", shown("dst_low"), "..", shown("dst_high"),
        ),
        *end_rules(first, "source", "src_low", "source_station_mismatch"),
        *end_rules(last, "destination", "dst_low", "destination_station_mismatch"),
    ]


def ordered_flags(df: DataFrame, hot_rows: int = HOT_ROWS, alias_pairs=None) -> DataFrame:
    return _exploded(ordered_stops(df, hot_rows), ordered_rules(alias_pairs))


def seq_values(df: DataFrame) -> DataFrame:
    """(train_no, row_id, seq, seq_num): the numbering behind any discontinuity."""
    return df.where(F.col("train_no").isNotNull()).select(
        "train_no", "row_id", "seq", to_number("seq").alias("seq_num")
    )


def numbering_fails():
    """For the columns stops, different, low, high of a train: its whole numbers are not exactly 1..n."""
    last = F.col("stops").cast("string")
    whole = (F.col("different") == F.col("stops")) & (F.col("low.whole") == "1") & (F.col("high.whole") == last)
    return (F.col("stops") > 1) & ~F.coalesce(whole, F.lit(False))


def broken_numbering():
    return [
        "seq_discontinuity", CRITICAL,
        F.col("different").cast("string"), " different seq values ", shown("low.whole"), "..", shown("high.whole"),
        " is not 1..", F.col("stops").cast("string"),
    ]


def seq_discontinuities(df: DataFrame) -> DataFrame:
    """Trains whose whole-number SEQ values are not exactly 1..n, one row each.

    n values within 1..n, all different, are 1..n. ``seq_values`` lists the values.
    """
    numbered = seq_values(df).withColumn("whole", whole_text("seq"))
    per_number = numbered.groupBy("train_no", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct("seq_num", "row_id")).alias("first")
    )
    known = F.col("whole").isNotNull()
    per_train = per_number.groupBy("train_no").agg(
        F.sum("n").alias("stops"),
        F.count("whole").alias("different"),
        F.min(number_place(F.col("whole"))).alias("low"),
        F.max(number_place(F.col("whole"))).alias("high"),
        F.coalesce(
            F.min(F.when(known, F.col("first"))).getField("row_id"),
            F.min(F.when(~known, F.col("first"))).getField("row_id"),
        ).alias("row_id"),
    )
    return per_train.where(numbering_fails())


def seq_discontinuity_flags(df: DataFrame) -> DataFrame:
    return _constant_flags(seq_discontinuities(df), *broken_numbering())


def code_name_pairs(df: DataFrame) -> DataFrame:
    """Distinct (station_code, station_name) with both present."""
    return df.select("station_code", "station_name").where(
        F.col("station_code").isNotNull() & F.col("station_name").isNotNull()
    ).distinct()


def ambiguous(pairs: DataFrame, key: str) -> DataFrame:
    """Keys with more than one partner in a table of distinct pairs: ``n``, ``low``, ``high``."""
    partner = next(c for c in pairs.columns if c != key)
    return pairs.groupBy(key).agg(
        F.count("*").alias("n"), F.min(partner).alias("low"), F.max(partner).alias("high")
    ).where("n > 1")


def code_name_texts(df: DataFrame) -> DataFrame:
    """station_code, ``names_text``: what to say about a code that goes with several names."""
    detail = F.concat(
        F.lit("code "), F.col("station_code"), F.lit(" goes with "), F.col("n").cast("string"),
        F.lit(" names: "), F.col("low"), F.lit(" .. "), F.col("high"),
    )
    return ambiguous(code_name_pairs(df), "station_code").select("station_code", detail.alias("names_text"))


SEVERAL_NAMES = ["station_code_name_inconsistency", WARNING]


def _code_name_flags(df: DataFrame, texts: DataFrame) -> DataFrame:
    rows = df.where("station_name is not null").select("row_id", "train_no", "station_code")
    return _constant_flags(rows.join(texts, "station_code"), *SEVERAL_NAMES, F.col("names_text"))


def code_name_flags(df: DataFrame) -> DataFrame:
    """Every row of a code that goes with several names; ``code_name_pairs`` lists them."""
    return _code_name_flags(df, code_name_texts(df))


#: Texts of up to so many bytes are sent to all tasks; the stops would have to travel by code otherwise.
TEXT_BYTES = 4_000_000


def _with_few(texts: DataFrame):
    """The texts and whether they are few; runs one small job. Only few carry the hint to be broadcast."""
    size = texts.agg(F.sum(F.octet_length("station_code") + F.octet_length("names_text") + 64)).first()[0] or 0
    return (F.broadcast(texts), True) if size <= TEXT_BYTES else (texts, False)


def _by_rule(df: DataFrame, hot_rows: int, alias_pairs) -> DataFrame:
    """The rules along and across trains one by one: the way for trains of more than ``hot_rows`` rows."""
    parts = [
        row_flags(df), duplicate_row_flags(df), duplicate_seq_flags(df), duplicate_stop_flags(df),
        ordered_flags(df, hot_rows, alias_pairs), seq_discontinuity_flags(df),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _train_pass(df: DataFrame, texts: DataFrame | None, alias_pairs) -> DataFrame:
    """All rules from one shuffle by train: every window below is of a train or of a part of one.

    Rows that are together by train already (joined with something by its number) are not shuffled again.
    """
    rows = df.select("row_id", *BASE).repartition("train_no")
    # Numbers and the digest are worked out once the rows are with their train, and where they are needed: on the way and in
    # the sorts before they would only take room. The texts come last for the same reason.
    rows = rows.withColumns({"whole": whole_text("seq"), "digest": F.xxhash64(*BASE)})
    train = Window.partitionBy("train_no")
    along = train.orderBy(*[F.col(c).asc_nulls_last() for c in ("seq_num", "seq_long", "row_id", "same_stop")])
    several, one = ["train_no", "whole", "seq"], F.lit(1)
    whole = F.col("whole")

    def least_and_most(c):
        return F.min(c).over(train), F.max(c).over(train)

    src_low, src_high = least_and_most("source_code")
    dst_low, dst_high = least_and_most("dest_code")
    low, high = [F.struct(x["whole"].alias("whole")) for x in least_and_most(number_place(whole))]
    first = F.struct("seq_num", "row_id")
    numbered, earliest = F.min(F.when(whole.isNotNull(), first)).over(train), F.min(first).over(train)
    # Windows of one order follow each other, so that whole rows are sorted three times only, and those that add much come
    # last, so that it is not sorted. Spark would put windows over fewer columns first, unless they read a result of
    # the ones before: so counts go over those results, which are never 0, and one ends the order along a train.
    s = rows.withColumn(
        # The digest only makes the sort cheap; all fields have to agree.
        "same_row", F.count(one).over(Window.partitionBy(*several, "digest", *[c for c in BASE if c not in several])),
    ).withColumns({
        "same_seq": F.count(F.nullif("same_row", F.lit(0))).over(Window.partitionBy(*several)),
        "new_number": F.lag("same_row").over(Window.partitionBy("train_no", "whole").orderBy("seq")).isNull(),
    }).withColumn("different", F.count(F.when(whole.isNotNull() & F.col("new_number"), one)).over(train)).withColumn(
        "same_stop", F.count(F.nullif("different", F.lit(-1))).over(Window.partitionBy("train_no", "station_code"))
    ).withColumns({
        **dict(zip(("seq_num", "seq_long"), seq_order(), strict=True)), "dist_num": to_number("distance"),
    }).withColumns({
        "pos": F.row_number().over(along).cast("long"),
        "before": F.lag(F.struct("seq", "distance", "dist_num")).over(along),
        # Rows without a train number are no train.
        "stops": F.when(F.col("train_no").isNotNull(), F.count(F.nullif("same_stop", F.lit(0))).over(train)),
        "src_low": src_low, "src_high": src_high, "dst_low": dst_low, "dst_high": dst_high, "low": low, "high": high,
        "spokesman": F.coalesce(numbered["row_id"], earliest["row_id"]) == F.col("row_id"),
    })
    s = s.withColumn("names_text", F.lit(None).cast("string")) if texts is None else s.join(texts, "station_code", "left")
    across = [
        _flag(F.col("same_row") > 1, *REPEATED_ROW),
        _flag(F.col("same_seq") > 1, *repeated_seq()),
        _flag(F.col("same_stop") > 1, *repeated_stop()),
        _flag(F.col("spokesman") & numbering_fails(), *broken_numbering()),
        _flag(F.col("names_text").isNotNull() & F.col("station_name").isNotNull(), *SEVERAL_NAMES, F.col("names_text")),
    ]
    return _exploded(s, row_rules() + ordered_rules(alias_pairs) + across)


def audit(df: DataFrame, hot_rows: int = HOT_ROWS, alias_pairs=None) -> DataFrame:
    """All flags of all rules.

    Trains of up to ``hot_rows`` rows take one pass with a single shuffle; larger ones (and the
    rows without a number, if there are as many) go rule by rule, each of which can cut them.
    What to say about codes with several names comes to the rows by broadcast if it is little; else
    rows go to it with their number, train and code only, besides the pass.
    """
    hot, total = hot_keys(df, ["train_no"], hot_rows)
    texts, few = _with_few(code_name_texts(df))
    parts = [_train_pass(join_on_keys(df, hot, ["train_no"], "left_anti") if total else df, texts if few else None, alias_pairs)]
    large = join_on_keys(df, hot, ["train_no"], "left_semi") if total else None
    if total:
        parts.append(_by_rule(large, hot_rows, alias_pairs))
    # Rows the pass over trains did not join with the texts: all of them, or those of large trains.
    unnamed = large if few else df
    if unnamed is not None:
        parts.append(_code_name_flags(unnamed, texts))
    return reduce(lambda a, b: a.unionByName(b), parts)


# Summary measures that add up several categories.
SUMMED_CATEGORIES = {
    "single_stop_trains_count": ["single_stop_train"],
    "trains_with_seq_discontinuity": ["seq_discontinuity"],
    "rows_with_distance_not_monotonic": ["distance_not_monotonic"],
    "arrival_departure_placeholder_issues": [
        "origin_arrival_not_placeholder", "terminus_departure_not_placeholder",
    ],
    "source_dest_mismatches": [
        "inconsistent_declared_src_dst", "source_station_mismatch", "destination_station_mismatch",
    ],
    "malformed_non_numeric_train_no_rows": ["malformed_row_non_numeric_train_no"],
}


def flag_counts(flags: DataFrame) -> DataFrame:
    return flags.groupBy("category", "severity").agg(F.count("*").alias("n"))


ROLLED_UP = [
    "total_rows_analyzed", "total_unique_trains", "total_unique_station_codes", "station_codes_bad_format",
    "station_codes_with_inconsistent_names", "station_names_with_inconsistent_codes",
]


def _measured(rows: DataFrame, values: list) -> DataFrame:
    """(measure, value) for every (name, value) pair whose value is not null."""
    pairs = F.array(*[
        F.struct((F.lit(n) if isinstance(n, str) else n).alias("measure"), v.cast("long").alias("value")) for n, v in values
    ])
    return rows.select(F.explode(pairs).alias("m")).select("m.*").where("value is not null")


def audit_summary(df: DataFrame, flags: DataFrame) -> DataFrame:
    """(measure, value) rows; categories and severities as flags_by_...:name.

    Flags: one aggregate over the grouping sets category, severity and all. Rows: every row is a row
    of its train, of its code and of its name; keys are rolled up first, then the kinds of key.
    """
    n, category, severity = F.col("n"), F.col("category"), F.col("severity")
    sets = flags.groupingSets([["category"], ["severity"], []], "category", "severity").agg(F.count(F.lit(1)).alias("n"))
    of_flags = _measured(sets, [
        ("total_flags_raised", F.when(category.isNull() & severity.isNull(), n)),
        (F.concat(F.lit("flags_by_category:"), category), F.when(category.isNotNull(), n)),
        (F.concat(F.lit("flags_by_severity:"), severity), F.when(severity.isNotNull(), n)),
        *[(name, F.when(category.isin(categories), n)) for name, categories in SUMMED_CATEGORIES.items()],
    ])

    def key(kind, value, partner=None, bad=None):
        partner = F.lit(None).cast("string") if partner is None else F.col(partner)
        return F.struct(
            F.lit(kind).alias("kind"), F.col(value).alias("key"), partner.alias("partner"),
            F.coalesce(F.lit(False) if bad is None else bad, F.lit(False)).alias("bad"),
        )

    keys = df.select(F.explode(F.array(
        key("train", "train_no"), key("code", "station_code", "station_name", code_format_rule()),
        key("name", "station_name", "station_code"),
    )).alias("k")).select("k.*")
    per_key = keys.groupBy("kind", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("partner").alias("low"), F.max("partner").alias("high"), F.max("bad").alias("bad")
    )
    several = F.count(F.when(F.col("key").isNotNull() & (F.col("low") < F.col("high")), 1))
    per_kind = per_key.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("key").alias("keys"), several.alias("several"), F.count(F.when(F.col("bad"), 1)).alias("bad")
    )

    def of(kind, column):
        return F.when(F.col("kind") == kind, F.col(column))

    of_rows = _measured(per_kind, list(zip(
        ROLLED_UP, [of("train", "n"), of("train", "keys"), of("code", "keys"), of("code", "bad"), of("code", "several"),
                    of("name", "several")], strict=True,
    )))
    always = ["total_flags_raised", *SUMMED_CATEGORIES, *ROLLED_UP]
    zeros = df.sparkSession.createDataFrame([(m, 0) for m in always], "measure string, value long")
    return of_flags.unionByName(of_rows).unionByName(zeros).groupBy("measure").agg(F.sum("value").alias("value"))
