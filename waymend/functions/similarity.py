"""Edit similarity as a native expression.

``similarity_ratio`` is 100 * (1 - d / (len a + len b)) with d the insert/delete
distance, i.e. len a + len b - 2 * (longest common subsequence). The subsequence
length comes from the bit-parallel recurrence: one mask of positions per character
of the shorter text, folded over the characters of the longer one.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Positions per machine word; leaves two bits for the carry of an addition.
WORD_BITS = 61


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chars(text: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1))
    )


def _masks(chars: Column) -> Column:
    """character -> bit set of its positions (the text fits one word)."""

    def mask(c):
        bits = F.transform(
            chars, lambda x, i: F.when(x == c, F.call_function("shiftleft", F.lit(1).cast("long"), i))
        )
        return F.aggregate(bits, F.lit(0).cast("long"), lambda s, b: s + F.coalesce(b, F.lit(0)))

    return F.map_from_entries(
        F.transform(F.array_distinct(chars), lambda c: F.struct(c, mask(c)))
    )


def _lcs_one_word(short: Column, long: Column) -> Column:
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(short)) - 1
    # A one-element array binds masks and start value, so that they are made once.
    once = F.array(F.struct(_masks(_chars(short)).alias("masks"), full.alias("full")))

    def fold(bound):
        def step(v, c):
            known = F.coalesce(F.try_element_at(bound["masks"], c), F.lit(0).cast("long"))
            hit = known.bitwiseAND(v)
            return (v + hit).bitwiseOR(v - hit).bitwiseAND(bound["full"])

        return F.aggregate(_chars(long), bound["full"], step)

    left = F.element_at(F.transform(once, fold), 1)
    return F.length(short) - F.bit_count(left)


def _lcs_rows(short: Column, long: Column) -> Column:
    """Texts beyond one word: the same recurrence on a list of words with a carry."""
    words = F.ceil(F.length(short) / F.lit(WORD_BITS)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), words - 1),
        lambda k: F.substring(short, k * WORD_BITS + 1, F.lit(WORD_BITS)),
    )
    rows = F.transform(
        pieces,
        lambda p: F.struct(
            _masks(_chars(p)).alias("masks"),
            (F.call_function("shiftleft", F.lit(1).cast("long"), F.length(p)) - 1).alias("v"),
            (F.call_function("shiftleft", F.lit(1).cast("long"), F.length(p)) - 1).alias("full"),
            F.length(p).alias("size"),
        ),
    )

    def step(state, c):
        def word(acc, w):
            hit = F.coalesce(F.try_element_at(w["masks"], c), F.lit(0).cast("long")).bitwiseAND(w["v"])
            total = w["v"] + hit + acc["carry"]
            new = F.struct(
                w["masks"].alias("masks"),
                total.bitwiseOR(w["v"] - hit).bitwiseAND(w["full"]).alias("v"),
                w["full"].alias("full"),
                w["size"].alias("size"),
            )
            carry = F.when(total > w["full"], F.lit(1)).otherwise(F.lit(0)).cast("long")
            return F.struct(
                F.concat(acc["rows"], F.array(new)).alias("rows"), carry.alias("carry")
            )

        empty = F.struct(
            F.filter(state, lambda w: F.lit(False)).alias("rows"),
            F.lit(0).cast("long").alias("carry"),
        )
        return F.aggregate(state, empty, word, lambda acc: acc["rows"])

    done = F.aggregate(_chars(long), rows, step)
    left = F.aggregate(
        done, F.lit(0), lambda s, w: s + F.bit_count(w["v"])
    )
    return F.length(short) - left


def lcs_length(a, b) -> Column:
    a, b = _column(a), _column(b)
    swap = F.length(a) > F.length(b)
    short = F.when(swap, b).otherwise(a)
    long = F.when(swap, a).otherwise(b)
    return (
        F.when(a == b, F.length(a))
        .when(F.length(short) == 0, F.lit(0))
        .when(F.length(short) <= WORD_BITS, _lcs_one_word(short, long))
        .otherwise(_lcs_rows(short, long))
    )


def lcs_lengths(a, others) -> Column:
    """Of one text and each text of an array; the masks of ``a`` are made once for all."""
    once = F.array(F.struct(
        _masks(_chars(a)).alias("masks"), (F.call_function("shiftleft", F.lit(1).cast("long"), F.length(a)) - 1).alias("full")
    ))

    def fold(bound, text):
        def step(v, c):
            hit = F.coalesce(F.try_element_at(bound["masks"], c), F.lit(0).cast("long")).bitwiseAND(v)
            return (v + hit).bitwiseOR(v - hit).bitwiseAND(bound["full"])

        return F.length(a) - F.bit_count(F.aggregate(_chars(text), bound["full"], step))

    one_word = F.element_at(F.transform(once, lambda bound: F.transform(others, lambda t: F.when(F.length(t) == 0, 0).otherwise(fold(bound, t)))), 1)
    many = F.transform(others, lambda t: F.when(F.length(t) == 0, 0).otherwise(_lcs_rows(a, t)))
    return (
        F.when(F.length(a) == 0, F.transform(others, lambda t: F.lit(0)))
        .when(F.length(a) <= WORD_BITS, one_word).otherwise(many)
    )


def similarity_ratio(a, b) -> Column:
    """0-100; two empty texts are equal (100)."""
    a, b = _column(a), _column(b)
    total = F.length(a) + F.length(b)
    distance = total - 2 * lcs_length(a, b)
    share = F.lit(1.0) - distance.cast("double") / total
    return F.when(total == 0, F.lit(100.0)).otherwise(share * 100)
