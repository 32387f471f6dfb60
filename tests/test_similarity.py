"""Similarity against plain dynamic programming written from the definition."""

import random

from pyspark.sql import functions as F

from waymend.functions.similarity import similarity_ratio
from waymend.functions.weighted import prepared, upper_bound, weighted_similarity


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain(a, b):
    total = len(a) + len(b)
    return 100.0 if total == 0 else (1 - (total - 2 * lcs(a, b)) / total) * 100


def sliced(a, b):
    if len(a) > len(b):
        a, b = b, a
    best = 0.0
    for start in range(1 - len(a), len(b)):
        best = max(best, plain(a, b[max(start, 0) : start + len(a)]))
    if len(a) == len(b):
        for start in range(1 - len(b), len(a)):
            best = max(best, plain(b, a[max(start, 0) : start + len(b)]))
    return best


def word_sets(a, b):
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    shared, left, right = one & two, one - two, two - one
    if shared and (not left or not right):
        return 100.0
    x, y = " ".join(sorted(left)), " ".join(sorted(right))
    base = len(" ".join(shared))
    gap = 1 if base else 0
    distance = len(x) + len(y) - 2 * lcs(x, y)
    wx, wy = base + gap + len(x), base + gap + len(y)
    best = 100 - 100 * distance / (wx + wy)
    if base:
        best = max(best, 100 - 100 * (gap + len(x)) / (base + wx), 100 - 100 * (gap + len(y)) / (base + wy))
    return best


def weighted(a, b):
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    score = plain(a, b)
    sa, sb = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if stretch < 1.5:
        return max(score, 0.95 * max(plain(sa, sb), word_sets(a, b)))
    scale = 0.9 if stretch <= 8 else 0.6
    one, two = set(a.split()), set(b.split())
    if one & two:
        words = 100.0
    else:
        words = max(sliced(sa, sb), sliced(" ".join(sorted(one)), " ".join(sorted(two))))
    return max(score, scale * sliced(a, b), 0.95 * scale * words)


def random_text(rng, longest, alphabet="abcde "):
    text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))
    return " ".join(text.split())


def test_native_ratio_short_and_long(spark):
    rng = random.Random(3)
    pairs = [(random_text(rng, 40), random_text(rng, 40)) for _ in range(400)]
    pairs += [(random_text(rng, 200, "abcé"), random_text(rng, 260, "abcé")) for _ in range(60)]
    pairs += [("", ""), ("", "a"), ("a" * 61, "a" * 61), ("a" * 62, "a" * 62), ("ab" * 61, "ba" * 70)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", similarity_ratio("a", "b").alias("s")).collect():
        assert abs(row.s - plain(row.a, row.b)) < 1e-9, (row.a, row.b)


def test_weighted_equals_the_definition_and_its_bound(spark):
    rng = random.Random(5)
    names = [random_text(rng, 24) for _ in range(25)] + ["", "a b", "x", "new delhi junction", "a b a b c", random_text(rng, 90)]
    queries = [random_text(rng, 30) for _ in range(20)] + ["new delhi", "a a b", "q" * 3, "é?é b", random_text(rng, 100)]
    pairs = [(q, n) for q in queries for n in names]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(8)
    shown = df.select("a", "b", weighted_similarity("a", "b").alias("s"), upper_bound(prepared("a"), prepared("b")).alias("u"))
    for r in shown.collect():
        want = weighted(r.a, r.b)
        assert abs(r.s - want) < 1e-9, (r.a, r.b)
        assert r.u >= want - 1e-9, (r.a, r.b)


def test_weighted_known_values(spark):
    # Values that follow from the definition by hand.
    df = spark.createDataFrame([("new delhi",), ("delhi new",), ("delhi",), ("",)], "b string")
    got = [r[0] for r in df.select(F.round(weighted_similarity(F.lit("new delhi"), F.col("b")), 6)).collect()]
    assert got == [100.0, 95.0, 90.0, 0.0]


def test_ratio_of_null_is_null(spark):
    df = spark.createDataFrame([(None, "a")], "a string, b string")
    assert df.select(similarity_ratio("a", "b")).first()[0] is None
    got = df.select(similarity_ratio(F.lit("abc"), F.lit("abd"))).first()[0]
    assert abs(got - 200 / 3) < 1e-9
