"""Gated replacement and distance fill against plain loops."""

import random
import statistics

from tests.helpers import stops, table
from waymend.operators import distance as dist
from waymend.operators import replace as rep
from waymend.roles import BASE
from waymend.sources.readers import last_routes, needed_meta

ROUTES = (
    "file_no int, pos bigint, trainNumber string, trainName string,"
    " trainRoute array<struct<sno: string, stationName: string, arrives: string, departs: string, distance: string>>"
)


def route(*names):
    last = len(names) - 1
    return [
        (str(i + 1), n, "Source" if i == 0 else "7:05", "Destination" if i == last else "17:06", f"{i * 10} kms")
        for i, n in enumerate(names)
    ]


def test_replace(spark):
    rows = [
        (0, 0, "00101", "first", route("X - X", "Y - Y")),
        (1, 0, "101", "Good", route("PUNE JN - PUNE", "LONAVLA - LNL", "MUMBAI CENTRAL - MMCT")),
        (1, 1, "102", "One end", route("PUNE - PUNE", "DELHI - DLI")),
        (1, 2, "103", "Empty", []),
        (1, 3, "104", "Blank", route("PUNE - PUNE", "MUMBAI - MMCT")),
        (1, 4, "105", "Unasked", route("A - A", "B - B")),
        (1, 5, "106", "No code", route("PUNE", "MUMBAI")),
    ]
    routes, duplicates = last_routes(spark.createDataFrame(rows, ROUTES))
    assert table(duplicates) == [("101", 1)]
    needed = stops(spark, [
        dict(train_no="0101", source_name="Pune", dest_name="Mumbai Ctr"), dict(train_no="101", source_name="Zzz", dest_name="Zzz"),
        dict(train_no="102", source_name="Pune", dest_name="Goa"), dict(train_no="103", source_name="Pune", dest_name="Mumbai"),
        dict(train_no="104", source_name="", dest_name="Mumbai"), dict(train_no="999", source_name="A", dest_name="B"),
        dict(train_no="106", source_name="Pune", dest_name="Mumbai"),
    ])
    decisions = rep.match_routes(needed_meta(needed), routes)
    got = {d.number: (d.matched, d.reason, d.src_score, d.dst_score) for d in decisions.collect()}
    assert got["101"] == (True, None, 100.0, 80.0)
    assert got["102"][:3] == (False, "endpoint_mismatch", 100.0)
    assert got["103"] == (False, "empty_route_in_source", None, None)
    assert got["104"] == (False, "endpoint_mismatch", 0.0, 100.0)
    assert got["106"] == (False, "endpoint_mismatch", 0.0, 0.0)
    assert set(got) == {"101", "102", "103", "104", "106"}
    old = stops(spark, [dict(train_no=t, station_code="O") for t in ("101", " 00101 ", "102", "7", None)])
    new, still = rep.replace_trains(old, needed, routes, decisions)
    assert table(new, "train_no", "train_name", "seq", "station_code", "station_name", "arrival", "departure", "distance", "source_code", "dest_name")[1:4] == [
        ("101", "Good", "2", "LNL", "LONAVLA", "07:05:00", "17:06:00", "10", "PUNE", "MUMBAI CENTRAL"),
        ("101", "Good", "3", "MMCT", "MUMBAI CENTRAL", "07:05:00", "", "20", "PUNE", "MUMBAI CENTRAL"),
        ("102", None, None, "O", None, None, None, None, None, None),
    ]
    assert new.columns == BASE and new.count() == 6
    assert sorted(r.train_no for r in still.collect()) == ["102", "103", "104", "106", "999"]
    log = {m.measure: m.value for m in rep.replace_log(old, needed, needed_meta(needed), routes, duplicates, decisions).collect()}
    assert (log["table_rows_dropped_old_fragments"], log["table_rows_added_new"], log["table_rows_after"]) == (2, 3, 6)
    assert log["source_duplicate_train_numbers"] == 1 and log["needed_rows_dropped_resolved"] == 2
    assert [r.number for r in rep.rejected_sample(decisions, 2).collect()] == ["102", "103"]


def loop_segments(known):
    found, last = {}, None
    for r in known:
        d = float(r["distance"]) if r["distance"] else None
        if last and last[0] == r["train_no"] and d is not None and last[2] is not None and last[1]:
            found.setdefault(tuple(sorted((last[1], r["station_code"]))), []).append(round(d - last[2], 2))
        last = (r["train_no"], r["station_code"], d)
    return {k: statistics.median(v) for k, v in found.items()}


def loop_fill(needed, known, lookup):
    """(train, seq) -> distance for open rows, written from the description."""
    out = {}
    for train in {r["train_no"] for r in needed}:
        place = {int(r["seq"]): [r["station_code"], None] for r in needed if r["train_no"] == train}
        place |= {int(r["seq"]): [r["station_code"], float(r["distance"])] for r in known if r["train_no"] == train and r["distance"]}
        order = sorted(place)
        if place[order[0]][1] is None:
            place[order[0]][1] = 0.0
        value = {s: place[s][1] for s in order}
        anchors = [i for i, s in enumerate(order) if value[s] is not None]
        for i, j in zip(anchors, anchors[1:]):
            total, path = value[order[i]], {}
            for k in range(i, j):
                step = lookup.get(tuple(sorted((place[order[k]][0], place[order[k + 1]][0]))))
                total = None if total is None or step is None else total + step
                path[order[k + 1]] = total
            if j - i > 1 and total is not None and abs(total - value[order[j]]) <= 3.0:
                for k in range(i + 1, j):
                    value[order[k]] = path[order[k]]
        out |= {(train, s): value[s] for s in order}
    return out


def make_tables(rng):
    codes = [f"S{i}" for i in range(9)]
    at = {c: i * 10 + (i % 3) for i, c in enumerate(codes)}
    known, needed = [], []
    for t in range(60):
        path = codes[rng.randint(0, 3): rng.randint(5, 9)]
        for i, c in enumerate(path):
            km = at[c] - at[path[0]] + rng.choice([0, 0, 0, 1, 6])
            if rng.random() < 0.45:
                code = c if rng.random() < 0.8 else f"U{t}"
                needed.append(dict(train_no=str(t), seq=str(i + 1), station_code=code))
            else:
                known.append(dict(train_no=str(t), seq=str(i + 1), station_code=c, distance=str(km)))
    return known, needed


def test_distance_fill_equals_loop(spark):
    known, needed = make_tables(random.Random(4))
    k, n = stops(spark, known), stops(spark, needed)
    lookup = dist.segment_lookup(k)
    plain = loop_segments(known)
    assert {(r.a, r.b): r.km for r in lookup.collect()} == plain
    want = loop_fill(needed, known, plain)
    for hot in (10_000, 3):
        chains = dist.chained(n, k, lookup, hot_rows=hot)
        got = dist.fill_distances(chains)
        for r in got.collect():
            value = want[(r.train_no, int(r.seq))]
            if value is None:
                assert (r.fill_status, r.distance) == ("open", None)
            else:
                assert (r.fill_status, r.distance) == ("filled", str(round(value)))
    statuses = {r.status for r in dist.chain_log(chains).collect()}
    assert statuses == {"verified_and_filled", "rejected_inconsistent", "rejected_gap_in_segment_lookup"}
    log = {m.measure: m.value for m in dist.fill_log(chains, lookup).collect()}
    moved, stay = dist.move_filled(k, got)
    assert moved.count() == log["known_rows_after"] and moved.count() + stay.count() == len(known) + len(needed)


def test_segments_of_hot_pairs(spark):
    rows = []
    for i in range(400):
        rows += [dict(train_no=str(i), seq="1", station_code="A", distance="0"),
                 dict(train_no=str(i), seq="2", station_code="B", distance=str(i % 37 + 0.25))]
    df = stops(spark, rows)
    want = statistics.median([i % 37 + 0.25 for i in range(400)])
    for hot in (1000, 5):
        assert table(dist.segment_lookup(df, hot_rows=hot)) == [("A", "B", want)]


def test_quarantine(spark):
    known = stops(spark, [
        dict(train_no="1", seq="1", station_code="A", distance="0"), dict(train_no="1", seq="5", station_code="C", distance="20"),
        dict(train_no="1", seq="x", station_code="C", distance="20"), dict(train_no="1", seq="7", station_code="C", distance=""),
    ])
    needed = stops(spark, [
        dict(train_no="1", seq="5", station_code="C"), dict(train_no="1", seq="3", station_code="B"),
        dict(train_no="1", seq="4", station_code="B"), dict(train_no="1", seq="4", station_code="B"),
        dict(train_no="1", seq="y", station_code="B"), dict(train_no="1", seq="9", station_code="B"),
        dict(train_no="2", seq="2", station_code="A"), dict(train_no="2", seq="3", station_code="A"),
    ])
    lookup = spark.createDataFrame([("A", "B", 10.5), ("B", "B", 0.0), ("B", "C", 9.5)], "a string, b string, km double")
    got = dist.fill_distances(dist.chained(needed, known, lookup))
    assert [(r.fill_status, r.distance) for r in got.orderBy("row_id").collect()] == [
        ("already_known", None), ("filled", "10"), ("duplicate_seq", None), ("duplicate_seq", None),
        ("bad_seq", None), ("open", None), ("filled", "0"), ("open", None),
    ]
    strict = dist.fill_distances(dist.chained(needed, known, lookup, verify_first=True))
    assert strict.where("train_no = '2' and fill_status = 'filled'").count() == 0


def test_rows_without_a_segment_spread(spark):
    """No null in the first key of the join with the lengths: such rows would all meet in one task."""
    from tests.helpers import stops
    from waymend.operators import distance

    known = stops(spark, [dict(train_no=str(t), seq="1", station_code="A", distance="0") for t in range(50)])
    needed = stops(spark, [dict(train_no=str(t), seq="2", station_code="B") for t in range(50)])
    lookup = spark.createDataFrame([("A", "B", 5.0)], "a string, b string, km double")
    chains = distance.chained(needed, known, lookup)
    keys = [r["a"] for r in chains.where("b is null").collect()]
    assert len(keys) == 50 and None not in keys and len(set(keys)) == 50
    assert chains.where("b is not null and step = 5000000").count() == 50


def test_a_place_is_parsed_once(spark):
    from tests.helpers import stops
    from waymend.operators import distance

    rows = stops(spark, [dict(train_no="1", seq="+007", station_code="A", distance="1")])
    out = distance.tagged(rows, rows)
    assert {r["place"]["whole"] for r in out.select("place").collect()} == {"7"}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 20
