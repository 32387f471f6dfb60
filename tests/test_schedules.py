"""Name resolution against a plain loop, both schedule formats, and their difference."""

import random

import pytest

from tests.helpers import stops, table
from tests.test_similarity import random_text, weighted
from waymend.functions.fixed_values import extra_aliases
from waymend.operators import diff as d
from waymend.operators import resolve as rs
from waymend.operators import schedules as sc

MASTER = "code string, canonical_name string, aliases array<string>, ord bigint"


def master_table(spark, rows):
    return spark.createDataFrame([(c, n, a, i) for i, (c, n, a) in enumerate(rows)], MASTER)


def loop_resolve(query, rows):
    """The cascade as a plain loop; names here are in normal form already."""
    if not query:
        return (False, "", "", 0.0, None)
    canonical, alias = {}, {}
    for code, name, names in rows:
        canonical[name] = (code, name)
        for a in names:
            alias[a] = (code, name)
    for index, method in ((canonical, "EXACT"), (alias, "ALIAS")):
        if query in index:
            return (True, index[query][0], method, 100.0, None)
    close = [r for r in rows if r[1].startswith(query) or query.startswith(r[1])]
    if len(close) == 1:
        return (True, close[0][0], "PREFIX", 100.0, None)
    names = list(canonical)
    scores = [(-weighted(query, n), i) for i, n in enumerate(names)]
    ranked = sorted(scores)
    if -ranked[0][0] >= 80:
        return (True, canonical[names[ranked[0][1]]][0], "FUZZY", round(-ranked[0][0], 2), None)
    return (False, "", "", 0.0, [canonical[names[i]][1] for _, i in ranked[:5]])


@pytest.mark.parametrize("with_empty", [False, True])
def test_cascade_equals_loop(spark, monkeypatch, with_empty):
    monkeypatch.setattr(rs, "BLOCK_NAMES", 9)
    rng = random.Random(29)
    words = ["agra", "pune", "fort", "new", "delhi", "road", "junction", "cant", "xy"]

    def name():
        return " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))

    rows = [(f"C{i}", name(), [name()] if i % 3 == 0 else []) for i in range(40)]
    if with_empty:
        rows.append(("E", "", []))
    queries = sorted({name() for _ in range(40)} | {random_text(rng, 14, "agrpune ") for _ in range(30)} | {"ag", "pune fort x", "zq"})
    names = spark.createDataFrame([(q,) for q in queries], "name string")
    got = {r.name: r for r in rs.resolve_names(names, master_table(spark, rows), groups=5).collect()}
    assert len(got) == len(queries)
    for q in queries:
        r = got[q]
        assert (r.matched, r.station_code, r.method, r.confidence, r.suggestions) == loop_resolve(q, rows), q


def test_well_known_aliases(spark):
    assert (len(extra_aliases()), len({c for c, _ in extra_aliases()})) == (176, 174)
    master = master_table(spark, [("DLI", "Delhi Main", []), ("CSMT", "Mumbai CSMT", ["Victoria T"]), ("X", "Xylo", [])])
    names = spark.createDataFrame([("Delhi Jn.",), ("victoria  terminus",), ("C Shivaji Maharaj T",)], "name string")
    got = {r.name: (r.station_code, r.method) for r in rs.resolve_names(names, master).collect()}
    assert got == {
        "Delhi Jn.": ("DLI", "ALIAS"), "victoria  terminus": ("CSMT", "ALIAS"), "C Shivaji Maharaj T": ("CSMT", "ALIAS"),
    }


def test_codes(spark):
    master = master_table(spark, [("A", "one", []), ("A", "two", []), ("B", "three", [])])
    codes = spark.createDataFrame([("A",), ("Z",)], "code string")
    assert table(rs.resolve_codes(codes, master), "code", "canonical_name") == [("A", "two"), ("Z", None)]


def test_old_schedule(spark):
    df = stops(spark, [
        dict(train_no=" 7 ", train_name=" T ", seq="10", station_code="C"), dict(train_no="7", train_name="U", seq="2", station_code="B"),
        dict(train_no="7", seq="x", station_code="?"), dict(train_no="7", train_name="V", seq="2", station_code="B2"),
        dict(train_no="8", seq=""), dict(train_no="9", seq="x"),
    ])
    for hot in (1000, 2):
        flat = sc.old_schedule(df, hot_rows=hot)
        assert table(flat, "train_no", "pos", "seq", "station_code", "train_name") == [
            ("7", 0, "2", "B", "U"), ("7", 1, "2", "B2", "V"), ("7", 2, "10", "C", "T"),
        ]
    assert table(sc.skipped_rows(df), "seq", "rows", "trains", "first_trains") == [("", 1, 1, "8"), ("x", 2, 2, "7, 9")]


def test_old_schedule_orders_numbers_of_any_length(spark):
    long = "1" + "0" * 29
    df = stops(spark, [dict(train_no="1", seq=s, station_code=c) for s, c in (
        (long + "1", "D"), (long, "B"), ("007", "A"), ("0" * 40 + long[:-1] + "1", "C"))])
    flat = sc.old_schedule(df)
    assert table(flat, "pos", "seq", "station_code") == [
        (0, "7", "A"), (1, long, "B"), (2, long[:-1] + "1", "C"), (3, long + "1", "D"),
    ]


def new_table(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "row_id bigint, train_number string, train_name string, source string, destination string,"
        " departure_time string, arrival_time string, distance string, intermediate_stops string, classes string",
    )


STATIONS = [("AG", "Agra", []), ("PU", "Pune", []), ("GO", "Goa", []), ("", "Nocode", [])]


def test_new_schedule(spark):
    df = new_table(spark, [
        ("1", "old", "Agra", "Pune", "1", "2", "3", "", "x"),
        ("1", "N", "RL Agra", "Pune", "06:00", "09:00", "99", "Goa(arr=07:00,dep=07:05)|agra(arr=1)|PUNE(x)|bad|PQ Goa(dep=8)|Zzyzx()", "SL"),
        ("2", "M", "Nocode", "Qqqq", "1", "2", "", "", ""),
    ])
    flat = sc.new_schedule(df, master_table(spark, STATIONS), groups=2)
    got = table(flat, "train_no", "pos", "seq", "station_code", "station_name", "arrival", "departure", "distance", "source_code", "dest_code")
    assert got == [
        ("1", 0, 1, "AG", "Agra", "", "06:00", "", "AG", "PU"),
        ("1", 1, 2, "GO", "Goa", "07:00", "07:05", "", "AG", "PU"),
        ("1", 2, 3, "GO", "Goa", "", "8", "", "AG", "PU"),
        ("1", 3, 4, "UNKNOWN", "Zzyzx", "", "", "", "AG", "PU"),
        ("1", 4, 5, "PU", "Pune", "09:00", "", "99", "AG", "PU"),
        ("2", 0, 1, "UNKNOWN", "Nocode", "", "1", "", "UNKNOWN", "UNKNOWN"),
        ("2", 1, 2, "UNKNOWN", "Qqqq", "2", "", "", "UNKNOWN", "UNKNOWN"),
    ]
    assert [r[0] for r in sc.unresolved_names(flat).collect()] == ["Nocode", "Qqqq", "Zzyzx"]
    with pytest.raises(ValueError):
        sc.packed_trains(df.drop("source"))


FLAT = ("train_no string, pos bigint, seq bigint, train_name string, station_code string, station_name string, arrival string,"
        " departure string, distance string, source_code string, dest_code string")


def flat(spark, trains):
    rows = []
    for train, name, src, dst, listed in trains:
        for i, (code, arr, dep, km) in enumerate(listed):
            rows.append((train, i, i + 1, name, code, code.lower(), arr, dep, km, src, dst))
    return spark.createDataFrame(rows, FLAT)


def test_difference(spark):
    route = [("A", "", "1", "0"), ("B", "2", "3", "5"), ("C", "4", "", "9")]

    def changed(i, field, value):
        rows = [list(r) for r in route]
        rows[i][field] = value
        return [tuple(r) for r in rows]

    old = flat(spark, [(t, "n", "A", "C", route) for t in ("same", "name", "src", "dst", "count", "route", "arr", "dep", "km", "km-empty", "two", "gone")])
    new = flat(spark, [
        ("same", "n", "A", "C", route), ("name", "m", "A", "C", route), ("src", "n", "X", "C", route), ("dst", "n", "A", "X", route),
        ("count", "n", "A", "C", route[:2]), ("route", "n", "A", "C", changed(1, 0, "Z")), ("arr", "n", "A", "C", changed(1, 1, "9")),
        ("dep", "n", "A", "C", changed(1, 2, "9")), ("km", "n", "A", "C", changed(1, 3, "6")), ("km-empty", "n", "A", "C", changed(1, 3, "")),
        ("two", "m", "A", "C", [("A", "", "8", "1"), ("Q", "2", "3", "5"), ("C", "0", "", "9"), ("D", "", "", "")]),
        ("born", "n", "A", "C", [("A", "FIRST", "1", ""), ("C", "2", "Last", "7")]),
    ])
    status = d.schedule_status(old, new)
    got = {r.train_no: (r.status, r.changes) for r in status.collect()}
    assert got == {
        "same": ("unchanged", []), "name": ("updated", ["TRAIN_NAME"]), "src": ("updated", ["SOURCE"]),
        "dst": ("updated", ["DESTINATION"]), "count": ("updated", ["STOP_COUNT"]), "route": ("updated", ["ROUTE"]),
        "arr": ("updated", ["ARRIVAL"]), "dep": ("updated", ["DEPARTURE"]), "km": ("updated", ["DISTANCE"]),
        "km-empty": ("unchanged", []),
        "two": ("updated", ["TRAIN_NAME", "STOP_COUNT", "DEPARTURE", "DISTANCE", "ROUTE", "ARRIVAL"]),
        "gone": ("missing", []), "born": ("new", []),
    }
    assert table(d.status_totals(status)) == [("missing", 1), ("new", 1), ("unchanged", 2), ("updated", 9)]
    full = d.with_stop_ends(new.selectExpr("*", "'' AS classes", "'' AS running_days"))
    rows = table(d.import_rows(full, status).where("`Train No` = 'born'"))
    assert rows == [
        ("born", "n", 1, "A", "a", "", "1", "", "A", "a", "C", "c", "", ""),
        ("born", "n", 2, "C", "c", "2", "", "7", "A", "a", "C", "c", "", ""),
    ]


def test_unchanged_trains_are_not_compared(spark):
    from waymend.operators import diff

    columns = "train_no string, pos long, train_name string, source_code string, dest_code string, station_code string, arrival string, departure string, distance string"

    def train(number, *codes):
        return [(number, i, "n", "s", "d", c, None, "", str(i)) for i, c in enumerate(codes)]

    old = train("1", *"ABCD") + train("2", *"ABCD") + train("3", *"AB") + train("4", *"AB")
    new = train("1", *"ABCD") + train("2", *"ACBD") + train("3", *"ABC") + train("5", *"AB")
    one, two = spark.createDataFrame(old, columns), spark.createDataFrame(new, columns)
    kept = diff.stops_to_compare(diff.tagged_stops(one, two)).groupBy("train_no").count().collect()
    assert {r[0]: r[1] for r in kept} == {"1": 2, "2": 8, "3": 5, "4": 1, "5": 1}
    got = {r.train_no: (r.status, r.changes) for r in diff.schedule_status(one, two).collect()}
    assert got == {
        "1": ("unchanged", []), "2": ("updated", ["ROUTE"]), "3": ("updated", ["STOP_COUNT"]), "4": ("missing", []), "5": ("new", []),
    }


def test_prefixes_against_a_loop(spark):
    rng = random.Random(7)

    def name():
        return "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 7))).strip()

    for nameless in ([], [("E", "", [])], [("E", "", []), ("G", " ", [])]):
        rows = [(f"C{i}", name(), []) for i in range(25)] + nameless
        queries = sorted({q for q in (" ".join(name().split()) for _ in range(60)) if q})
        master = master_table(spark, rows)
        df = spark.createDataFrame([(q,) for q in queries], "query string")
        stations = [(c, " ".join(n.split())) for c, n, _ in rows]
        want = {}
        for q in queries:
            fits = [c for c, n in stations if n.startswith(q) or q.startswith(n)]
            if len(fits) == 1:
                want[q] = fits[0]
        for hot in (2_000_000, 10):
            assert {r["query"]: r["code"] for r in rs.resolve_prefix(df, master, hot).collect()} == want


def test_stop_ends_read_the_stops_once(spark, tmp_path):
    from waymend.operators import diff

    path = str(tmp_path / "stops")
    rows = [("1", 1, "B", "bee"), ("1", 0, "A", "a"), ("1", 2, "C", None), ("2", 0, "D", "d"), (None, 0, "E", "e")]
    spark.createDataFrame(rows, "train_no string, pos long, station_code string, station_name string").coalesce(1).write.parquet(path)
    want = [("1", i, "A", "a", "C", None) for i in range(3)] + [("2", 0, "D", "d", "D", "d")]
    for hot in (1000, 2):
        got = diff.with_stop_ends(spark.read.parquet(path), hot)
        assert table(got, "train_no", "pos", "source_code", "source_name", "dest_code", "dest_name") == sorted(want, key=repr)
    plan = diff.with_stop_ends(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex") == 1


def test_cell_text_trims_every_white_space(spark):
    from pyspark.sql import functions as F

    from waymend.functions.text import WHITE_SPACE, cell_text, trim_ws

    edges = ["", *WHITE_SPACE, "!", "~", "\x7f", "é", "​", "\U0001f600", "\x00"]
    texts = [a + m + b for a in edges for m in ("", "x", "a b") for b in edges]
    df = spark.createDataFrame([(t,) for t in (*texts, None)], "t string")
    assert df.where(~cell_text("t").eqNullSafe(F.coalesce(trim_ws("t"), F.lit("")))).count() == 0


def test_prefixes_of_one_letter_do_not_meet_in_one_task(spark, tmp_path):
    """Rows of a long letter are cut where they are read, and names are read from what was written once."""
    import re

    path = str(tmp_path / "names")
    spark.range(60).selectExpr("concat('b', id) AS query").coalesce(1).write.parquet(path)
    master = master_table(spark, [(f"C{i}", f"b{i} x", []) for i in range(0, 60, 2)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rs.resolve_prefix(spark.read.parquet(path), master, 10)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"SortMergeJoin \[letter#\d+\],", plan)
        assert path not in plan and "regexp_replace" not in plan
        names = [f"b{i} x" for i in range(0, 60, 2)]
        fits = {f"b{i}": [n for n in names if n.startswith(f"b{i}")] for i in range(60)}
        want = {q: f"C{n[0].split()[0][1:]}" for q, n in fits.items() if len(n) == 1}
        assert {r["query"]: r["code"] for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
