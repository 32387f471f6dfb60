"""Every flag category on a hand-made table, and hot keys against plain windows."""

import random

from tests.helpers import stops, table
from waymend.operators import audit as a
from waymend.operators.ordered import Ordered, position, previous_in_file, with_ordered

import pyspark.sql.functions as F


def full(train, seq, code, **more):
    base = dict(
        train_no=train, train_name="T", seq=seq, station_code=code, station_name=f"name {code}",
        arrival="00:00:00", departure="00:00:00", distance="0", source_code="AA", source_name="A",
        dest_code="BB", dest_name="B",
    )
    return {**base, **more}


ROWS = [
    full("1", "1", "AA"),                                              # 0 clean train
    full("1", "2", "BB", distance="5"),                                # 1
    full("2", "1", "AA"),                                              # 2 single stop
    full("3", "1", "AA", distance="7", arrival="01:00:00"),            # 3 origin distance and arrival
    full("3", "2", "CC", arrival="10:00:00", departure="09:00:00", distance="9"),   # 4 departs early
    full("3", "4", "BB", distance="8", departure="03:00:00"),          # 5 gap, not monotonic, terminus
    full("K", "1", "AA", dest_code="AA", source_code=None),            # 6 malformed number, single
    full("4", "1", "AA", source_code="XX"),                            # 7 torn declared source
    full("4", "2", "BB", distance=""),                                 # 8 missing distance
    full("5", "1", "CSMT", source_code="CSTM"),                        # 9 alias at the source
    full("5", "2", "DD", dest_code="EE"),                              # 10 destination mismatch (torn? no)
    full("6", "1", "GG"),                                              # 11 source mismatch
    full("6", "1", "BB", source_code="AA"),                            # 12 duplicate seq
    full("7", "1", "AA", source_code="AA"),                            # 13
    full("7", "2", "AA", dest_code="AA"),                              # 14 duplicate stop
    full(None, "1", "a1", station_name="bad  blanks"),                 # 15 no number, bad code, encoding
    full("8", "1", "AA", station_name="other"),                        # 16 second name for AA; exact duplicate
    full("8", "1", "AA", station_name="other"),                        # 17
    full("9", "x", "AA"),                                              # 18 SEQ not a number
    full("9", "1", "BB", station_name=" "),                            # 19 blank name
]
# One declared destination per train where the case above is not about it.
for i in (9, 10):
    ROWS[i]["dest_code"] = "EE"
    ROWS[i]["source_code"] = "CSTM"
for i in (13, 14):
    ROWS[i]["dest_code"] = "AA"

EXPECTED = {
    "missing_required_value": {15, 19},
    "missing_optional_value": {6, 8},
    "malformed_row_non_numeric_train_no": {6, 15},
    "station_code_format": {15},
    "encoding_or_whitespace_issue": {15, 19},
    "duplicate_exact_row": {16, 17},
    "duplicate_train_seq": {11, 12, 16, 17},
    "duplicate_stop_on_train": {13, 14, 16, 17},
    "single_stop_train": {2, 6},
    "seq_discontinuity": {3, 11, 16, 19},
    "distance_not_monotonic": {5},
    "origin_distance_not_zero": {3},
    "origin_arrival_not_placeholder": {3},
    "terminus_departure_not_placeholder": {5},
    "departure_before_arrival": {4},
    "inconsistent_declared_src_dst": {7},
    "known_code_alias_inconsistency": {9},
    "source_station_mismatch": {11, 19},
    "destination_station_mismatch": {10, 17, 18},
    "station_code_name_inconsistency": {0, 2, 3, 6, 7, 13, 14, 16, 17, 18, 1, 5, 8, 12, 19},
}


def by_category(flags):
    out = {}
    for row in flags.collect():
        out.setdefault(row.category, set()).add(row.row_id)
    return out


def test_all_categories(spark):
    flags = a.audit(stops(spark, ROWS))
    assert by_category(flags) == EXPECTED
    severities = {(r.category, r.severity) for r in flags.collect()}
    assert len(severities) == 20
    missing = flags.where("row_id = 15 and category = 'missing_required_value'").first()
    assert missing.train_no == ""


def test_order_and_partitions_do_not_matter(spark):
    df = stops(spark, ROWS)
    one = table(a.audit(df))
    assert table(a.audit(df.orderBy(F.desc("row_id")).repartition(5))) == one
    assert table(a.audit(df, hot_rows=1)) == one


def test_summary(spark):
    df = stops(spark, ROWS)
    got = {r.measure: r.value for r in a.audit_summary(df, a.audit(df)).collect()}
    assert got["total_rows_analyzed"] == 20
    assert got["total_unique_trains"] == 10
    assert got["single_stop_trains_count"] == 2
    assert got["source_dest_mismatches"] == 6
    assert got["arrival_departure_placeholder_issues"] == 2
    assert got["station_codes_with_inconsistent_names"] == 2
    assert got["malformed_non_numeric_train_no_rows"] == 2
    assert got["flags_by_severity:info"] == 4
    assert got["total_flags_raised"] == sum(v for k, v in got.items() if k.startswith("flags_by_category:"))


def test_clean_table_has_zero_counts(spark):
    df = stops(spark, ROWS[:2])
    flags = a.audit(df)
    assert flags.count() == 0
    got = {r.measure: r.value for r in a.audit_summary(df, flags).collect()}
    assert got["total_flags_raised"] == 0 and got["trains_with_seq_discontinuity"] == 0


def test_texts_have_one_form_and_lists_are_tables(spark):
    long = [full("1", str(i), f"C{i}") for i in range(2, 1500)]
    df = stops(spark, long + [full("2", "1", "AA"), full("2", "3", "AA")])
    details = {r.train_no: r.detail for r in a.seq_discontinuity_flags(df).collect()}
    assert details == {
        "1": "1498 different seq values 2..1499 is not 1..1498", "2": "2 different seq values 1..3 is not 1..2",
    }
    assert a.seq_values(df).count() == 1500
    names = stops(spark, [full(str(i), "1", "AA", station_name=f"n{i % 1200:04d}") for i in range(1300)])
    assert {r.detail for r in a.code_name_flags(names).collect()} == {"code AA goes with 1200 names: n0000 .. n1199"}
    assert a.code_name_pairs(names).count() == 1200


def test_seq_beyond_doubles_is_not_merged(spark):
    big = 2**60
    df = stops(spark, [full("1", str(big), "AA"), full("1", str(big + 1), "BB")])
    (flag,) = a.seq_discontinuity_flags(df).collect()
    assert flag.detail == f"2 different seq values {big}..{big + 1} is not 1..2"


def test_hot_keys_equal_plain_windows(spark):
    rng = random.Random(11)
    data = [
        (i, rng.choice(["hot"] * 6 + ["a", "b", "c"]), rng.choice([None, 1.0, 2.0, 3.0, 9.5]), rng.choice([None, 1, 2, 3]))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "row_id bigint, k string, o double, v bigint")
    v = F.col("v")
    specs = {
        "pos": position(),
        "prev": Ordered("previous", F.struct("row_id", "v")),
        "next": Ordered("following", F.struct("row_id", "v")),
        "total": Ordered("running", v),
        "before": Ordered("last_before", v),
        "after": Ordered("next_after", v),
        "all": Ordered("whole_sum", v),
        "low": Ordered("whole_min", v),
        "high": Ordered("whole_max", v),
    }
    plain = table(with_ordered(df, ["k"], ["o", "row_id"], specs))
    for limit in (200, 100, 37, 5):
        assert table(with_ordered(df, ["k"], ["o", "row_id"], specs, hot_rows=limit)) == plain


def test_previous_in_file(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") * 2).alias("v")).repartition(7)
    got = previous_in_file(df, "row_id", ["v"], "p", block=64)
    bad = got.where(~F.col("p.v").eqNullSafe(F.when(F.col("row_id") > 0, F.col("v") - 2)))
    assert got.count() == 1000 and bad.count() == 0


def test_numbers_of_any_length(spark):
    big = 10**44
    rows = [
        full("1", str(big + 2), "AA", distance="5"), full("1", str(big + 1), "BB", distance="9"), full("1", f"00{big + 3}", "CC", distance="7"),
        full("2", "+1", "AA"), full("2", "02", "BB"), full("2", "3.0", "CC"), full("2", "4e0", "DD"),  # whole numbers all the same
        full("3", "-1", "AA"), full("3", "2", "BB"), full("3", "-12", "CC"),
        full("4", "0", "AA"), full("4", "-0", "BB"),
    ]
    df = stops(spark, rows)
    for hot in (a.HOT_ROWS, 2):
        flags = {(r.train_no, r.category): (r.row_id, r.detail) for r in a.audit(df, hot_rows=hot).collect()}
        # The double of all three numbers is the same; the order is theirs all the same.
        assert flags["1", "distance_not_monotonic"][0] in (0, 2)
        assert flags["1", "seq_discontinuity"][1] == f"3 different seq values {big + 1}..{big + 3} is not 1..3"
        assert ("2", "seq_discontinuity") not in flags
        assert flags["3", "seq_discontinuity"][1] == "3 different seq values -12..2 is not 1..3"
        assert flags["4", "seq_discontinuity"][1] == "1 different seq values 0..0 is not 1..2"
    steps = [r.row_id for r in a.ordered_stops(df.where("train_no = '1'")).orderBy("pos").collect()]
    assert steps == [1, 0, 2]


def test_repeated_rows_compare_fields_not_hashes(spark, monkeypatch):
    from waymend.operators import keyed

    monkeypatch.setattr(keyed.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("c", "x"), (None, None)], "p string, q string")
    assert table(keyed.repeated_rows(df, ["p", "q"])) == [("a", None), ("a", None)]


def test_summary_of_no_rows(spark):
    df = stops(spark, [])
    got = {r.measure: r.value for r in a.audit_summary(df, a.audit(df)).collect()}
    assert set(got.values()) == {0} and "total_rows_analyzed" in got


def test_borders_below(spark):
    from waymend.operators.ordered import _borders_below

    rows = [(v, sorted(random.Random(n).sample(range(60), n))) for n in (0, 1, 2, 5, 16, 17, 40) for v in range(-1, 61, 3)]
    df = spark.createDataFrame(rows, "v long, b array<long>")
    got = [r[0] for r in df.select(_borders_below(F.col("v"), F.col("b"))).collect()]
    assert got == [sum(x <= v for x in b) for v, b in rows]


def test_the_digest_does_not_travel(spark):
    """Random bytes do not compress: the digest is worked out behind the shuffle by train."""
    import re

    rows = stops(spark, [dict(train_no=str(i), seq="1", station_code="AB") for i in range(5)])
    plan = a.audit(rows)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    by_train = next(i for i, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(train_no[^\n]*REPARTITION_BY_COL", x))
    assert any("xxhash64" in x for x in lines[:by_train]) and not any("xxhash64" in x for x in lines[by_train:])


def test_stops_joined_by_train_are_not_shuffled_again(spark):
    """Neither to the texts about codes nor to their train: both took the whole rows before."""
    import re

    orders = spark.createDataFrame([(n, "T") for n in {r["train_no"] for r in ROWS} if n], "number string, called string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = stops(spark, ROWS)
        joined = df.join(orders, df.train_no == orders.number, "left")
        flags = a.audit(joined.withColumn("train_name", F.coalesce("called", "train_name")).select(df.columns))
        plan = flags._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_COL" not in plan and len(re.findall(r"Exchange hashpartitioning\(train_no", plan)) == 1
        assert "SortMergeJoin [station_code" not in plan
        assert by_category(flags) == EXPECTED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_do_not_travel(spark):
    plan = a.audit(stops(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("REPARTITION_BY_COL")
    assert "seq_num" in above and "seq_num" not in below and "dist_num" not in below


def test_whole_rows_are_sorted_three_times(spark):
    plan = a.audit(stops(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("REPARTITION_BY_COL")[0].count("Sort [train_no") == 3


def test_many_texts_about_codes(spark, monkeypatch):
    df = stops(spark, ROWS)
    few = table(a.audit(df))
    monkeypatch.setattr(a, "TEXT_BYTES", 0)
    for hot in (a.HOT_ROWS, 2, 1):
        assert table(a.audit(df, hot_rows=hot)) == few
    assert "BroadcastHint" not in a.audit(df)._jdf.queryExecution().analyzed().toString()


def test_borders_are_found_by_halves(spark):
    """Thousands of borders, and values that are structs with nulls last, as a place is."""
    from waymend.operators.ordered import _borders_below, _place

    n = 5000
    borders = spark.range(1, n + 1).select(F.when(F.col("id") < n, F.col("id") * 2).alias("o")).select(
        _place(["o"]).alias("p")
    ).agg(F.array_sort(F.collect_list("p")).alias("b"))
    rows = spark.range(0, 2 * n + 50, 7).select(F.col("id").alias("o")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = rows.crossJoin(borders).select("o", _borders_below(_place(["o"]), F.col("b")).alias("n")).collect()
    assert all(r.n == (n if r.o is None else min(r.o // 2, n - 1)) for r in got)


def test_what_windows_add_is_not_sorted(spark):
    """The windows that add wide columns come behind the last sort, and so do the texts about codes."""
    import re

    plan = a.audit(stops(spark, ROWS))._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_COL")[0]
    last, *before = re.split(r"Sort \[train_no", plan)
    assert "row_number" in last and "BroadcastHashJoin [station_code" in last and len(before) == 3
    assert not any("row_number" in x or "HashJoin" in x for x in before)
