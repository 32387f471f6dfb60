"""Column functions, literal in and literal out."""

import pytest
from pyspark.sql import functions as F

from waymend.functions import text as t


@pytest.fixture(scope="module")
def apply(spark):
    def run(function, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]

    return run


def test_normalize_name(apply):
    cases = {
        " \t LOWER harbour ": "lower harbour",
        "Bombay Docks": "mumbai docks",
        "West Madras": "west chennai",
        "Bangalore East 2": "bengaluru east 2",
        "calcutta port": "kolkata port",
        "Itarsi Jn": "itarsi junction",
        "Old Fort (OFT)": "old fort",
        "Mt. Abu, Road": "mt abu road",
        "Salt     Lake": "salt lake",
        "A jn jn B": "a junction jn b",
        "Agra & Cantt.-Rd": "agra and cantonment road",
        "\tX Hal\n": "x halt",
        "": "",
        None: "",
    }
    assert apply(t.normalize_name, list(cases)) == list(cases.values())


def test_reference_and_endpoint_forms(apply):
    assert apply(t.norm_ref_name, [" st. thomas-mt  junction ", "Jn", None, "XJUNCTION"]) == [
        "ST THOMASMT JN", "JN", "", "XJUNCTION",
    ]
    assert apply(t.norm_endpoint_name, ["Pune Jn", "Bangalore City 2", None, "Townsend"]) == [
        "PUNE", "BANGALORE", "", "TOWNSEND",
    ]


def test_clock_and_distance(apply):
    assert apply(t.norm_time, ["7:24", " 17:05 ", "17:05:00", "99:99", "", None, "7:5"]) == [
        "07:24:00", "17:05:00", "", "99:99:00", "", "", "",
    ]
    assert apply(t.reformat_clock, ["7:24", "07:24:00", "", None, "noon"]) == [
        "07:24:00", "07:24:00", "", None, "noon",
    ]
    assert apply(t.parse_distance, ["12 kms", "7km", "7 KM", "1.5 kms", "", None]) == ["12", "7", "7", "", "", ""]
    assert apply(t.is_clock, ["07:24:00", "7:24:00", None]) == [True, False, False]
    assert apply(t.endpoint_arrival, ["Source", "7:00"]) == ["", "07:00:00"]
    assert apply(t.endpoint_departure, ["Destination", "7:00"]) == ["", "07:00:00"]


def test_split_station(apply):
    values = ["A - B - C", "PLAIN", " X  -  Y ", " - Z"]
    assert apply(lambda c: t.split_station(c)[0], values) == ["A - B", "", "X", ""]
    assert apply(lambda c: t.split_station(c)[1], values) == ["C", "PLAIN", "Y", "Z"]


def test_prefix_numbers_blanks(apply):
    assert apply(t.strip_control_prefix, ["RL Pune", "rl Pune", " PQ  X ", "RSX", "RS"]) == [
        "Pune", "rl Pune", "X", "RSX", "RS",
    ]
    assert apply(t.number_key, [" 00123 ", "000", "", None, "0a"]) == ["123", "0", "0", "0", "a"]
    assert apply(t.digits_key, ["00123", "000", "12a", " 1", None]) == ["123", "0", None, None, None]
    assert apply(t.is_blank, ["", " \t", " ", "x", None]) == [True, True, True, False, True]
    assert apply(t.is_na_placeholder, ["NA", " nan ", "", None, "N"]) == [True, True, True, True, False]
    assert apply(t.to_number, ["1", " 2.5 ", "1d", "1e2", ".5", "5.", "x", None, "0x1"]) == [
        1.0, 2.5, None, 100.0, 0.5, 5.0, None, None, None,
    ]


def test_encoding(apply):
    values = ["OK", "a  b", " a", "a\n", "é", "a\x01", None, "", "a\tb"]
    assert apply(t.has_encoding_issue, values) == [False, True, True, True, True, True, False, False, False]


def test_truncation_and_aliases(spark):
    df = spark.createDataFrame(
        [("ABCDEFGHIJKL", "Abcdefghijkl Mnop", True), ("ABC", "ABCD", False), (None, "X", False),
         ("ABCDEFGHIJKL", None, False), ("A.B-C JUNCTION X", "ABC Jn Xyz", True), ("ABCDEFGHIJKL", "", False)],
        "a string, b string, want boolean",
    )
    for row in df.select("*", t.is_truncation_of("a", "b").alias("got")).collect():
        assert row.got == row.want, row
    pairs = spark.createDataFrame(
        [("CSMT", "CSTM", True), ("CSTM", "CSMT", True), ("A", "A", True), ("A", "B", False), ("A", None, False)],
        "a string, b string, want boolean",
    )
    for row in pairs.select("*", t.codes_are_aliases("a", "b").alias("got")).collect():
        assert row.got == row.want, row


def test_packed_stops(apply):
    got = apply(
        t.parse_packed_stops,
        ["A(arr=06:00,dep=06:05)|B (dep=1, arr = 2 ,arr=3,z=9)| |C|D(|E(arr=1=2)x", "", None],
    )
    plain = [[tuple(s) for s in stops] for stops in got]
    assert plain == [
        [("A", "06:00", "06:05"), ("B", "3", "1"), ("D", "", ""), ("E", "1=2)", "")], [], [],
    ]
    assert apply(t.count_packed_stops, ["AGC|BPL", "", " | ", None]) == [4, 2, 2, 2]


def test_grade(spark):
    df = spark.createDataFrame([(s,) for s in (90, 89, 75, 60, 40, 39)], "s int")
    assert [r[0] for r in df.select(t.grade("s")).collect()] == ["A", "B", "B", "C", "D", "F"]


def test_pieces_of_a_long_key_keep_to_their_tasks(spark):
    """Pieces that compress well are not packed into one task."""
    from pyspark.sql import functions as F

    from waymend.operators.ordered import Ordered, with_ordered

    df = spark.range(4000).select((F.col("id") * 0).alias("k"), "id")
    out = with_ordered(df, ["k"], ["id"], {"n": Ordered("running", F.lit(1))}, 100)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert [r["n"] for r in out.orderBy("id").collect()] == list(range(1, 4001))
