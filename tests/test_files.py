"""Readers, writers and the whole jobs through files."""

import json

import pytest

from tests.helpers import table
from waymend.plans import jobs
from waymend.roles import BASE, BASE_HEADERS
from waymend.sources import readers, versions, writers


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_two_null_conventions(spark, tmp_path):
    path = write(tmp_path / "a.csv", ' Train No ,x,Arrival time,Arrival Time\n1,,NA,""\n"2, ""b""",y,,z\n')
    blank = readers.read_schedule(spark, path)
    assert blank.columns == ["Train No", "x", "Arrival time", "Arrival Time"]
    assert table(blank) == [("1", "", "NA", ""), ('2, "b"', "y", "", "z")]
    null = readers.read_stops_null_blank(spark, path)
    assert table(null) == [("1", None, "NA", None), ('2, "b"', "y", None, "z")]


def test_row_ids_over_splits_and_files(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 5000)):
        lines = "\n".join(f"{i},text {i}" for i in range(start, start + 5000))
        write(tmp_path / name, "n,t\n" + lines + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.with_csv_row_id(readers.read_schedule_with_place(spark, str(tmp_path)))
        assert df.columns == ["n", "t", "row_id"]
        assert df.count() == 10_000 and df.where("cast(n as bigint) <> row_id").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_row_ids(spark, tmp_path):
    whole = spark.range(0, 3000, 1, 1).selectExpr("id", "id * 2 as v")
    whole.write.parquet(str(tmp_path / "one"))
    one = readers.read_parquet_with_row_id(spark, str(tmp_path / "one"), ["id"])
    assert one.where("id <> row_id").count() == 0 and one.columns == ["id", "row_id"]
    spark.range(0, 3000, 1, 4).write.parquet(str(tmp_path / "many"))
    many = readers.read_parquet_with_row_id(spark, str(tmp_path / "many"))
    assert sorted(r.row_id for r in many.collect()) == list(range(3000))


def test_reference_lists(spark, tmp_path):
    def features(*items):
        return json.dumps({"features": [{"properties": i, "geometry": None} for i in items]}, indent=1)

    stations = write(tmp_path / "s.json", features({"code": "A", "name": "old"}, {"code": "", "name": "none"}, {"code": None},
                                                   {"code": "A", "name": "new", "state": "S", "zone": "Z"}))
    assert table(readers.read_station_reference(spark, stations)) == [("A", "new", "S", "Z")]
    trains = write(tmp_path / "t.json", features({"number": "007", "name": "x"}, {"number": "7", "name": "y", "from_station_code": "F"}, {"number": "00"}))
    got = table(readers.read_train_reference(spark, trains), "number_key", "name", "from_code")
    assert got == [("0", None, None), ("7", "y", "F")]
    secondary = write(tmp_path / "c.json", json.dumps([{"Agra": "AG", "Agra Fort": "AG"}, {"ignored": "X"}]))
    assert set(table(readers.read_secondary_codes(spark, secondary), "code", "name")) == {("AG", "Agra"), ("AG", "Agra Fort")}
    assert readers.read_secondary_codes(spark, write(tmp_path / "e.json", "[]")).count() == 0


def test_route_files(spark, tmp_path):
    def train(number, name, *stops):
        return {"trainNumber": number, "trainName": name, "trainRoute": [
            {"sno": str(i), "stationName": s, "arrives": "Source", "departs": "1:00", "distance": "1 kms"} for i, s in enumerate(stops)]}

    one = write(tmp_path / "1.json", json.dumps([train("00012", "a", "X - X"), train("13", "b"), train("12", "c", "Y - Y")], indent=1))
    two = write(tmp_path / "2.json", json.dumps([train("13", "d", "Z - Z")]))
    routes, duplicates = readers.read_route_json(spark, [one, two])
    assert table(routes, "number", "train_name") == [("12", "c"), ("13", "d")]
    assert table(duplicates) == [("12", 1), ("13", 1)]


HEADER = ",".join(BASE_HEADERS.values())


def test_clean_and_merge_files(spark, tmp_path):
    one = write(tmp_path / "one.csv", HEADER + "\n"
                "1,T,1,AG,Agra,00:00:00,01:00:00,0,AG,Agra,PU,Pune\n"
                "1,T,2,PU,ABCDEFGHIJKL,NA,NA,NA,NA,NA,NA,NA\n"
                "K,05:00:00,00:00:00,9,AG,Agra,PU,Pune,,,,\n"
                "2,T,1,AG,Agra,,01:00:00,,AG,Agra,PU,Pune\n")
    two = write(tmp_path / "two.csv", HEADER.replace("Arrival time", "Arrival Time") + "\n"
                "2,U Train,1,AG,Agra,7:24,8:00,4,AG,Agra,PU,Pune\n3,U Train,1,P,Pune,,9:00,,P,Pune,PU,Pune\n")
    stations = spark.createDataFrame([("AG", "AGRA", None, None), ("PU", "Abcdefghijklmnop", None, None), ("PUN", "PUNE", None, None)],
                                     "code string, name string, state string, zone string")
    trains = spark.createDataFrame([("1", "n", "z", "f", "t")], "number_key string, name string, zone string, from_code string, to_code string")
    secondary = spark.createDataFrame([], "code string, name string")
    first = jobs.clean(jobs.read_stops(spark, one), stations, trains, secondary)
    jobs.write_cleaned(first, str(tmp_path / "clean"))
    cleaned = readers.read_schedule(spark, str(tmp_path / "clean" / "cleaned"))
    assert cleaned.count() == 3 and cleaned.columns[-2:] == ["Validation Status", "Station Name (Community Reference)"]
    fixed = cleaned.where("SEQ = '2'").first()
    assert (fixed["Arrival time"], fixed["Station Name (Community Reference)"]) == ("05:00:00", "Abcdefghijklmnop")
    assert spark.read.json(str(tmp_path / "clean" / "audit_summary")).count() > 10

    second = jobs.normalize_second(jobs.read_stops(spark, two), stations)
    result = jobs.fill_and_merge(first.cleaned, second)
    jobs.write_merged(result, str(tmp_path / "merged"))
    merged = readers.read_schedule(spark, str(tmp_path / "merged" / "merged"))
    assert merged.columns == list(jobs.MERGED_HEADERS.values())
    rows = {(r["Train No"], r["SEQ"]): r for r in merged.collect()}
    assert rows[("2", "1")]["Timing Source"] == "filled_from_sibling_dataset"
    assert rows[("2", "1")]["Arrival time"] == "07:24:00" and rows[("2", "1")]["Source Dataset"] == "dataset1_original"
    assert rows[("3", "1")]["Station Code (Community Reference Suggestion)"] == "PUN" and rows[("3", "1")]["Train Name"] == "U"
    assert len(rows) == 4


def test_migration_files(spark, tmp_path):
    old = write(tmp_path / "old.csv", HEADER + "\n1,N,1,AG,Agra,,06:00,,AG,Agra,PU,Pune\n1,N,2,PU,Pune,09:00,,99,AG,Agra,PU,Pune\n"
                "2,Gone,1,AG,Agra,,,,AG,Agra,PU,Pune\n3,N,x,AG,Agra,,,,AG,Agra,PU,Pune\n")
    new = write(tmp_path / "new.csv", "train_no,train_name,source,destination,departure_time,arrival_time,distance,intermediate_stops,days\n"
                "1,N,Agra,Pune,06:00,09:00,99,,Mon\n4,New,Agra,Nowhere at all,1,2,3,Pune(arr=First),Tue\n")
    master_file = write(tmp_path / "m.csv", "Station Code,Canonical Name,Aliases\nAG,Agra,\nPU,Pune,Poona; Puna ;\n")
    master = readers.read_station_master(spark, master_file)
    assert table(master, "code", "canonical_name", "aliases", "ord") == [("AG", "Agra", [], 0), ("PU", "Pune", ["Poona", "Puna"], 1)]
    result = jobs.migrate(jobs.read_with_row_id(spark, old), jobs.read_with_row_id(spark, new), master, groups=2)
    assert table(result.totals) == [("missing", 1), ("new", 1), ("unchanged", 1)]
    out = str(tmp_path / "out")
    jobs.write_migration(result, out)
    rows = readers.read_schedule(spark, f"{out}/import_ready")
    assert table(rows, "Train No", "SEQ", "Station Code", "Arrival Time", "Running Days") == [
        ("4", "1", "AG", "", "Tue"), ("4", "2", "PU", "", "Tue"), ("4", "3", "UNKNOWN", "2", "Tue"),
    ]
    assert table(readers.read_schedule(spark, f"{out}/new_trains")) == [("4",)]
    assert table(readers.read_schedule(spark, f"{out}/missing_trains")) == [("2",)]
    assert table(readers.read_schedule(spark, f"{out}/unresolved_stations")) == [("Nowhere at all",)]
    writers.write_train_list(result.status, f"{out}/list")
    assert [r[0] for r in readers.read_schedule(spark, f"{out}/list").orderBy("Train Number").collect()] == ["1", "2", "4"]
    assert table(result.skipped, "seq", "rows") == [("x", 1)]


def test_reports_of_two_tables(spark):
    a = spark.createDataFrame([("1", "A", "1")], "`Train No` string, `Station Code` string, SEQ string")
    b = spark.createDataFrame([(1,)], "z int")
    assert table(jobs.validate_tables(old=a, new=b), "label", "shape") == [("new", "unknown"), ("old", "per_stop")]


def test_versions(spark, tmp_path):
    known = spark.createDataFrame([tuple("k" for _ in BASE)], ", ".join(f"{c} string" for c in BASE))
    paths = jobs.write_new_tables(known, known, str(tmp_path), "2")
    assert [spark.read.parquet(p).columns[0] for p in paths] == ["Train No", "Train No"]


def test_replacement_and_fill_jobs(spark):
    from tests.helpers import stops

    known = stops(spark, [dict(train_no=t, seq=str(i), station_code=c, distance=str(10 * i))
                          for t in "12" for i, c in ((1, "A"), (2, "B"), (3, "C"))]
                  + [dict(train_no="9", seq="1", station_code="A", distance="0"), dict(train_no="9", seq="3", station_code="C", distance="20")])
    needed = stops(spark, [dict(train_no="9", seq="2", station_code="B", source_name="Agra", dest_name="Pune")])
    result = jobs.distance_fill(known, needed)
    assert table(result.known.where("train_no = '9' and seq = '2'"), "distance") == [("10",)]
    assert result.needed.count() == 0 and table(result.chains, "status") == [("verified_and_filled",)]
    routes = spark.createDataFrame([("9", "R", [("1", "Agra - AG", "Source", "1:00", "0 kms"), ("2", "Pune - PU", "2:00", "Destination", "5 kms")])],
                                   "number string, train_name string, route array<struct<sno: string, stationName: string, arrives: string, departs: string, distance: string>>")
    none = spark.createDataFrame([], "number string, extra bigint")
    swapped = jobs.gated_replacement(known, needed, routes, none)
    assert swapped.needed.count() == 0 and swapped.table.where("train_no = '9'").count() == 2


def test_json_files_are_read_in_many_splits(spark, tmp_path):
    items = [{"code": f"S{i % 700}", "name": f'name {i} with "quotes", braces }}{{ and \\"properties\\"', "state": "é" * (i % 5)} for i in range(2000)]
    text = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"coordinates": [i, [i]]}, "properties": p} if i % 2 else {"properties": p, "geometry": None} for i, p in enumerate(items)
    ]}, ensure_ascii=False)
    stations = write(tmp_path / "s.json", text)
    trains = [{"trainNumber": f"0{i % 900}", "trainName": str(i), "trainRoute": [
        {"sno": "1", "stationName": f"st{{{i}}}", "arrives": "Source", "departs": "1:00", "distance": "1 kms"}] * (i % 3)} for i in range(2000)]
    one = write(tmp_path / "r.json", json.dumps(trains[:1500]))
    two = write(tmp_path / "q.json", json.dumps(trains[1500:], indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert readers.json_pieces(spark, stations, "properties").rdd.getNumPartitions() > 8
        got = {r["code"]: (r["name"], r["state"], r["zone"]) for r in readers.read_station_reference(spark, stations).collect()}
        routes, duplicates = readers.read_route_json(spark, [one, two])
        found = {r["number"]: (r["train_name"], r["route"]) for r in routes.collect()}
        extra = {r["number"]: r["extra"] for r in duplicates.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {p["code"]: (p["name"], p["state"], None) for p in items}
    want = {t["trainNumber"].lstrip("0") or "0": t for t in trains}
    assert {n: (name, [s.asDict() for s in route]) for n, (name, route) in found.items()} == {n: (t["trainName"], t["trainRoute"]) for n, t in want.items()}
    assert extra == {n: sum((t["trainNumber"].lstrip("0") or "0") == n for t in trains) - 1 for n in want}
    other = write(tmp_path / "o.json", json.dumps([{"trainName": "a", "trainNumber": "1", "trainRoute": []}]))
    with pytest.raises(Exception, match="not the first key"):
        readers.read_route_json(spark, [other])[0].collect()
    assert readers.read_route_json(spark, [write(tmp_path / "e.json", "[]")])[0].count() == 0


def test_versions_rewrite_only_touched_files(spark, tmp_path):
    folder = str(tmp_path / "table")
    rows = spark.range(0, 4000).selectExpr("id div 10 as train", "id as stop", "'old' as name")
    versions.create_versions(rows.repartitionByRange(8, "train"), folder)
    before = versions.version_files(spark, folder)
    assert len(before) == 8
    keys = spark.createDataFrame([(5,), (6,), (399,), (99999,), (None,)], "train long")
    new = spark.createDataFrame([(5, 1, "new"), (777, 2, "new")], "train long, stop long, name string")
    assert versions.rewrite_keys(spark, folder, "train", keys, new) == 1
    after = versions.version_files(spark, folder)
    assert len(set(before) & set(after)) == 6  # the first and the last file were touched
    want = sorted([(i // 10, i, "old") for i in range(4000) if i // 10 not in (5, 6, 399)] + [(5, 1, "new"), (777, 2, "new")])
    assert sorted(map(tuple, versions.read_version(spark, folder).collect())) == want
    assert versions.read_version(spark, folder, 0).count() == 4000
    # Nothing touched: every file stays; a version that exists is not overwritten.
    assert versions.rewrite_keys(spark, folder, "train", keys.where("train = 99999"), new.where("false")) == 2
    assert set(after) <= set(versions.version_files(spark, folder))
    with pytest.raises(Exception, match="already exists"):
        versions._publish(spark, folder, 2, before)


def test_written_json_files_are_cut_in_order(spark, tmp_path):
    """Every piece is a JSON array of its own, and the paths sort as the places do."""
    from pyspark.sql import functions as F

    from checks.files import _json_files

    rows = spark.range(2000).select(
        (F.col("id") % 2).alias("file"), (-F.col("id")).alias("place"), F.struct(F.col("id").cast("string").alias("trainNumber")).alias("train")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _json_files(rows, F.col("train"), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for file in (0, 1):
        found = sorted((tmp_path / "out" / f"file={file}").rglob("*.txt"))
        texts = [json.loads(f.read_text(encoding="utf-8")) for f in found]
        assert len(texts) > 1 and max(len(x) for x in texts) < 1000
        assert [int(t["trainNumber"]) for x in texts for t in x] == [i for i in range(1999, -1, -1) if i % 2 == file]


def test_change_reports_compute_the_status_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    rows = [("1", "new", []), ("2", "updated", ["ROUTE"]), ("3", "missing", []), ("4", "unchanged", [])]
    status = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), "train_no string, status string, changes array<string>")
    writers.write_change_reports(status, str(tmp_path / "out"))
    assert seen.value == len(rows)
    assert table(readers.read_schedule(spark, str(tmp_path / "out" / "updated_trains"))) == [("2", "ROUTE")]
