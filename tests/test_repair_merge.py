"""Cross-reference, repair, cleaning and merging on small tables."""

from tests.helpers import stops, table
from waymend.functions import fixed_values as fv
from waymend.operators import crossref as x
from waymend.operators import merge as m
from waymend.operators import repair as r
from waymend.roles import BASE


def test_station_statuses(spark):
    names = {
        "A": "Agra Jn", "B": "ABCDEFGHIJKL", "C": "Other", "D": "Delhi", "E": "Elsewhere", "F": "None", "G": "Empty",
        None: "nowhere",
    }
    df = stops(spark, [dict(train_no="1", station_code=c, station_name=n) for c, n in names.items()]
               + [dict(train_no="2", station_code="A", station_name="later name")])
    reference = spark.createDataFrame(
        [("A", "AGRA JUNCTION", "UP", "N"), ("B", "Abcdefghijklmnop", None, None), ("C", "Cee", None, None), ("G", "", None, None)],
        "code string, name string, state string, zone string",
    )
    secondary = spark.createDataFrame(
        [("D", "New Delhi"), ("D", "Zzz"), ("E", "Unlike"), ("A", "unused")], "code string, name string"
    )
    got = {c.station_code: c for c in x.station_crossref(df, reference, secondary).collect()}
    assert {k: v.status for k, v in got.items()} == {
        "A": fv.VERIFIED, "B": fv.TRUNCATED, "C": fv.NAME_MISMATCH, "D": fv.SECONDARY_ONLY, "E": fv.MANUAL,
        "F": fv.NOT_FOUND, "G": fv.NAME_MISMATCH, None: fv.NOT_FOUND,
    }
    assert got["A"].station_name_in_dataset == "Agra Jn" and got["A"].suggested_full_name is None
    assert got["B"].suggested_full_name == "Abcdefghijklmnop" and got["D"].secondary_names_for_code == "2 names: New Delhi .. Zzz"
    assert got["G"].name_match is None and got["F"].found_in_secondary_reference is False
    enriched = {(e.station_code, e.validation_status, e.reference_name) for e in x.enrich(df, x.station_crossref(df, reference, secondary)).collect()}
    assert (None, fv.MANUAL, "") in enriched and ("B", fv.TRUNCATED, "Abcdefghijklmnop") in enriched
    assert ("C", fv.NAME_MISMATCH, "") in enriched


def test_train_statuses(spark):
    df = stops(spark, [dict(train_no=t) for t in ("00123", "000", "12K", None, "9")])
    reference = spark.createDataFrame(
        [("123", "n", "z", "f", "t"), ("0", "zero", None, None, None)],
        "number_key string, name string, zone string, from_code string, to_code string",
    )
    got = {r.train_no: r.found_in_reference for r in x.train_crossref(df, reference).collect()}
    assert got == {"00123": True, "000": True, "12K": False, None: False, "9": False}


def row(train, **more):
    return {**dict(zip(BASE, [train, "n", "1", "C", "S", "a", "d", "1", "sc", "sn", "dc", "dn"])), **more}


NO_TAIL = dict.fromkeys(BASE[5:12], "NA")
PIECE = dict(zip(BASE, ["K", "ar", "de", "12", "SRC", "Source", "DST", "Dest", None, None, None, None]))


def test_split_rows(spark):
    rows = [
        PIECE,                                   # 0 first row: nothing in front of it
        row("1"), PIECE,                         # 2 the row in front is complete
        row("2", **NO_TAIL), PIECE,              # 4 repairable
        row("3", **{**NO_TAIL, "arrival": None, "departure": " nan "}), PIECE, {**PIECE, "train_no": "K2"},  # 7 behind a piece
        row("4"),
    ]
    df = stops(spark, rows)
    fixed = {r.row_id: r for r in r_rows(r.repair_split_rows(df))}
    assert sorted(fixed) == [0, 1, 2, 3, 5, 7, 8]
    for i in (3, 5):
        assert tuple(fixed[i][c] for c in BASE[5:12]) == ("ar", "de", "12", "SRC", "Source", "DST", "Dest")
    log = {e.measure: e.value for e in r.repair_log(df).collect()}
    assert log == {
        "rows_reconstructed": 2, "rows_removed_after_reconstruction": 2, "net_row_count_change": -2,
        "original_row_count": 9, "cleaned_row_count": 7,
    }


def r_rows(df):
    return df.collect()


def test_adjacent_duplicates(spark):
    def s(train, seq, code, a=None, d=None, km=None):
        return dict(train_no=train, seq=str(seq), station_code=code, arrival=a, departure=d, distance=km)

    rows = [
        s("1", 1, "A", "1", "2", None), s("1", 2, "A", "1", "2", None),          # identical
        s("1", 3, "B", None, "5", None), s("1", 4, "B", "4", None, "9"),         # complementary
        s("1", 5, "C", "1"), s("1", 6, "C", "2"),                                # conflicting
        s("1", 7, "A", "8"),                                                     # not adjacent
        s("2", 1, "D", "1"), s("2", 2, "D", None, "2"), s("2", 3, "D", None, None, "3"),  # three in a row
        s(None, 1, "A"), s(None, 2, "A"),
    ]
    df = stops(spark, rows)
    for hot in (1000, 2):
        got = table(r.merge_adjacent_duplicates(df, hot_rows=hot), "row_id", "arrival", "departure", "distance", "adjacent_kind")
        assert got == sorted([
            (0, "1", "2", None, "identical"), (2, "4", "5", "9", "complementary"), (4, "1", None, None, "conflicting"),
            (5, "2", None, None, "conflicting"), (6, "8", None, None, None), (7, "1", "2", "3", "complementary"),
            (10, None, None, None, None), (11, None, None, None, None),
        ], key=repr)


def test_code_suggestions(spark):
    df = stops(spark, [dict(station_code=c, station_name=n) for c, n in
                       [("J", "Jalna"), ("J", "Jaipur Jn"), ("S", "Saoner"), ("X", "Jalna"), ("JN", "Jalna")]])
    reference = spark.createDataFrame(
        [("JLN", "JALNA"), ("JP", "Jaipur Junction"), ("SA", "Saoner"), ("SB", "SAONER")], "code string, name string"
    )
    got = [e.code_suggestion for e in r.suggest_codes(df, reference).orderBy("row_id").collect()]
    assert got == ["JLN", "JP", "", "", ""]


def test_format(spark):
    df = stops(spark, [dict(train_name="BJU EXP Train", arrival="7:24", departure=None), dict(train_name="Train X", arrival="")])
    got = table(r.normalize_format(df), "train_name", "arrival", "departure")
    assert got == [("BJU EXP", "07:24:00", None), ("Train X", "", None)]


def test_merge(spark):
    def s(train, code, a=None, d=None, km=None, seq="1"):
        return dict(train_no=train, seq=seq, station_code=code, arrival=a, departure=d, distance=km)

    one = stops(spark, [
        s("1", "A", "1", None, "5"), s("1", "B", None, "2", "6"),        # filled, then complete
        s("2", "A", None, None, None), s("2", "C", None, None, None),    # the sibling is fuller
        s("3", "A", "1", "1", None),                                     # tie
        s("4", "A", "only"), s("4", "A", "only"),                        # one side, exact copies
        s(None, "A"),
    ])
    two = stops(spark, [
        s("1", "A", "9", "8", "7"), s("1", "B", "x", None, None), s("1", "B", "y", None, None),
        s("2", "D", "1", "2", "3"),
        s("3", "A", None, "1", "1"),
        s("5", "A", None), s(None, "B"),
    ])
    filled1, filled2 = m.cross_fill(one, two), m.cross_fill(two, one)
    got1 = table(filled1, "row_id", "arrival", "departure", "distance", "timing_source")
    assert got1[:2] == [(0, "1", "8", "5", fv.FILLED), (1, None, "2", "6", fv.ORIGINAL)]
    assert got1[4] == (4, "1", "1", "1", fv.FILLED)
    rows = m.united(one, two)
    for side, filled in ((1, filled1), (2, filled2)):  # the same as filling one table alone
        assert table(rows.where(f"side = {side}"), *filled.columns) == table(filled)
    decisions = m.overlap_decisions(one, two)
    kept = {d.train_no: (d.kept_source, d.dataset1_missing_fields, d.dataset2_missing_fields) for d in decisions.collect()}
    assert kept == {"1": ("dataset2", 1, 0), "2": ("dataset2", 6, 0), "3": ("dataset1", 0, 0), None: ("dataset1", 0, 0)}
    merged = m.merge_sources(rows)
    got = table(merged, "train_no", "station_code", "source_dataset")
    assert got == sorted([
        ("1", "A", fv.SECOND_SOURCE), ("1", "B", fv.SECOND_SOURCE), ("1", "B", fv.SECOND_SOURCE), ("2", "D", fv.SECOND_SOURCE), ("3", "A", fv.FIRST_SOURCE),
        ("4", "A", fv.FIRST_SOURCE), ("5", "A", fv.SECOND_SOURCE), (None, "A", fv.FIRST_SOURCE),
    ], key=repr)
    assert merged.columns == m.MERGED_COLUMNS
    log = {e.measure: e.value for e in m.merge_log(rows).collect()}
    assert log["exact_duplicate_rows_removed_in_final_pass"] == 1 and log["trains_present_in_both"] == 4
    assert log["dataset1_cross_fill_counts:departure"] == 1 and log["final_merged_row_count"] == 8
    assert log["dataset2_filled_rows_dropped"] + log["dataset2_filled_rows_retained"] == filled2.where(f"timing_source = '{fv.FILLED}'").count()


def test_merge_sends_rows_by_train_only(spark):
    """Pairs, decisions and equal rows need no shuffle of their own."""
    import re

    one = stops(spark, [dict(train_no=t, station_code=c) for t in ("1", "2", None) for c in ("A", "B", None)])
    two = stops(spark, [dict(train_no=t, station_code=c, arrival="1") for t in ("2", "3", None) for c in ("A", None)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = m.merge_sources(m.united(one, two))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        got = table(merged, "train_no", "station_code", "source_dataset")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\)", plan)
    assert len(keys) == plan.count("Exchange hashpartitioning(") and set(keys) <= {"train_no", "second"}
    assert len(keys) == 5  # each table for the decisions, each for the rows, and the decisions
    first, second = fv.FIRST_SOURCE, fv.SECOND_SOURCE
    assert got == sorted(
        [("1", c, first) for c in ("A", "B", None)] + [("2", c, second) for c in ("A", None)]
        + [("3", c, second) for c in ("A", None)] + [(None, c, first) for c in ("A", "B", None)], key=repr,
    )


def test_stations_are_looked_up_in_one_reading_of_the_stops(spark, tmp_path):
    path = str(tmp_path / "stops")
    rows = [dict(train_no="1", station_code=c, station_name=n) for c, n in (("A", "x"), ("B", "Bee"), ("B", "later"), (None, "y"), ("C", None))]
    stops(spark, rows).coalesce(1).write.parquet(path)
    reference = spark.createDataFrame([("A", "X", None, None)], "code string, name string, state string, zone string")
    secondary = spark.createDataFrame([("B", "bee town"), ("B", "Zed"), ("B", "Zed"), ("C", "Cee"), (None, "y")], "code string, name string")
    got = x.station_crossref(spark.read.parquet(path), reference, secondary)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex") == 1
    assert table(got, "station_code", "status", "secondary_names_for_code") == sorted([
        ("A", fv.VERIFIED, None), ("B", fv.SECONDARY_ONLY, "2 names: Zed .. bee town"),
        # Nothing is contained in a name as the empty text is.
        ("C", fv.SECONDARY_ONLY, "1 names: Cee .. Cee"), (None, fv.NOT_FOUND, None),
    ], key=repr)
