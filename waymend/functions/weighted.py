"""Weighted similarity of two names as a native expression.

The score is the largest of: the plain ratio; the ratio of the sorted words and of
the word sets (0.95); and, once one text is at least 1.5 times as long as the other,
the best ratio of the shorter text against a slice of the longer one (0.9, or 0.6
beyond eight times the length), over the texts and over their words. All ratios are
the insert/delete similarity of ``similarity.py``.

``prepared`` holds what the score needs of one text, so that it is made once per name and not
once per pair; ``upper_bound`` says, from letter counts alone, what a pair cannot exceed.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymend.functions.similarity import lcs_lengths

WORD_SCALE = 0.95
SLICE_SCALE, FAR_SLICE_SCALE = 0.9, 0.6
SLICE_FROM, FAR_FROM = 1.5, 8.0

#: Letters that are counted one by one; all others are counted together.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def _joined(words) -> Column:
    return F.array_join(F.array_sort(words), " ")


def prepared(text) -> Column:
    """text, ordered (its sorted words), unique (its sorted distinct words), words (distinct), counts."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    each = [F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in LETTERS]
    others = F.length(F.translate(text, LETTERS, ""))
    return F.struct(
        text.alias("text"), _joined(words).alias("ordered"), _joined(F.array_distinct(words)).alias("unique"),
        F.array_distinct(words).alias("words"), F.array(*each, others).alias("counts"),
    )


def _once(value, use) -> Column:
    """``use`` of a value that is made once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _comparison(text, others, weight, shared=0):
    """A text, the texts it meets, the weight of the best ratio, and how many letters (of both sides
    together) are equal beyond the texts."""
    shared = F.lit(shared) if isinstance(shared, int) else shared
    weight = F.lit(weight) if isinstance(weight, float) else weight
    return F.struct(
        text.alias("text"), others.alias("others"), weight.cast("double").alias("weight"), shared.cast("int").alias("shared")
    )


def _best(comparisons) -> Column:
    """The largest weighted ratio of an array of comparisons."""
    def ratio(e, t, common):
        total = F.length(e["text"]) + F.length(t) + e["shared"]
        distance = F.length(e["text"]) + F.length(t) - F.lit(2) * common
        return F.when(total == 0, 100.0).otherwise((F.lit(1.0) - distance.cast("double") / total) * 100)

    def best(e):
        ratios = F.zip_with(e["others"], lcs_lengths(e["text"], e["others"]), lambda t, common: ratio(e, t, common))
        return e["weight"] * F.array_max(ratios)

    return F.array_max(F.transform(comparisons, best))


def _slices(texts) -> Column:
    """Of the longer text, as long as the shorter one, or less at both ends."""
    m, n = F.length(texts["short"]), F.length(texts["long"])

    def cut(start):
        begin = F.greatest(start, F.lit(0))
        return F.substring(texts["long"], begin + 1, F.least(start + m, n) - begin)

    return F.when((m == 0) | (n == 0), F.array(F.lit("\x00"))).otherwise(F.transform(F.sequence(F.lit(1) - m, n - 1), cut))


def _against_slices(a, b, weight) -> Column:
    """Comparisons of the shorter text with slices of the longer one; both ways for texts of one length."""
    swap = F.length(a) > F.length(b)
    one = F.struct(F.when(swap, b).otherwise(a).alias("short"), F.when(swap, a).otherwise(b).alias("long"), weight.alias("weight"))
    two = F.struct(b.alias("short"), a.alias("long"), weight.alias("weight"))
    ways = F.when(F.length(a) == F.length(b), F.array(one, two)).otherwise(F.array(one))
    return F.transform(ways, lambda t: _comparison(t["short"], _slices(t), t["weight"]))


def _percent(part, whole) -> Column:
    return F.lit(100.0) - F.lit(100.0) * part.cast("double") / whole


def _stretch(a, b) -> Column:
    one, two = F.length(a["text"]), F.length(b["text"])
    return F.greatest(one, two).cast("double") / F.greatest(F.least(one, two), F.lit(1))


def _scale(stretch) -> Column:
    return F.when(stretch <= FAR_FROM, SLICE_SCALE).otherwise(FAR_SLICE_SCALE)


def weighted_of(a, b) -> Column:
    """0-100 for two prepared texts; 0 where either is empty.

    Everything that has to be compared letter by letter goes into one list, so the expression for
    that stands in the plan once.
    """
    facts = F.struct(
        _joined(F.array_intersect(a["words"], b["words"])).alias("both"),
        _joined(F.array_except(a["words"], b["words"])).alias("x"), _joined(F.array_except(b["words"], a["words"])).alias("y"),
        _stretch(a, b).alias("stretch"), ((F.size(a["words"]) > 0) & (F.size(b["words"]) > 0)).alias("worded"),
        ((a["ordered"] != a["unique"]) | (b["ordered"] != b["unique"])).alias("repeats"),
    )

    def score(f):
        base, x, y = F.length(f["both"]), F.length(f["x"]), F.length(f["y"])
        shares, gap, scale = base > 0, (base > 0).cast("int"), _scale(f["stretch"])
        plain = _comparison(a["text"], F.array(b["text"]), 1.0)
        near = F.when(f["worded"], F.array(
            plain, _comparison(a["ordered"], F.array(b["ordered"]), WORD_SCALE),
            _comparison(f["x"], F.array(f["y"]), WORD_SCALE, 2 * (base + gap)),
        )).otherwise(F.array(plain))
        by_word = F.lit(WORD_SCALE) * scale
        none = F.slice(F.array(plain), 1, 0)
        far = F.concat(
            F.array(plain), _against_slices(a["text"], b["text"], scale),
            F.when(shares, none).otherwise(_against_slices(a["ordered"], b["ordered"], by_word)),
            F.when(shares | ~f["repeats"], none).otherwise(_against_slices(a["unique"], b["unique"], by_word)),
        )
        # Words that both have: what of the rest is too much, or nothing at all.
        sets = F.when(shares, F.when((x == 0) | (y == 0), 100.0).otherwise(
            F.greatest(_percent(gap + x, 2 * base + gap + x), _percent(gap + y, 2 * base + gap + y))
        )).otherwise(0.0)
        is_near = f["stretch"] < SLICE_FROM
        known = F.when(is_near, WORD_SCALE * sets).otherwise(F.when(shares, 100.0 * by_word).otherwise(0.0))
        return F.greatest(_best(F.when(is_near, near).otherwise(far)), known)

    empty = (F.length(a["text"]) == 0) | (F.length(b["text"]) == 0)
    return F.when(empty, 0.0).otherwise(_once(facts, score))


def weighted_similarity(a, b) -> Column:
    pair = F.struct(prepared(a).alias("a"), prepared(b).alias("b"))
    return _once(pair, lambda x: weighted_of(x["a"], x["b"]))


def upper_bound(a, b) -> Column:
    """What ``weighted_of`` cannot exceed: no common subsequence is longer than the letters that both have."""
    common = F.aggregate(F.zip_with(a["counts"], b["counts"], lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    shares, stretch = F.arrays_overlap(a["words"], b["words"]), _stretch(a, b)

    def ratio(c, kind):
        # Against a text of c letters at least: a slice is never shorter than what matches in it.
        return F.lit(200.0) * c / F.greatest(F.length(a[kind]) + F.length(b[kind]), F.lit(1))

    def sliced(c, kind):
        return F.lit(200.0) * c / F.greatest(F.least(F.length(a[kind]), F.length(b[kind])) + c, F.lit(1))

    def bound(c):
        by_word = F.when(shares, 100.0).otherwise(F.greatest(ratio(c, "ordered"), ratio(c, "unique")))
        by_slice = F.when(shares, 100.0).otherwise(F.greatest(sliced(c, "ordered"), sliced(c, "unique")))
        near = F.greatest(ratio(c, "text"), WORD_SCALE * by_word)
        far = F.greatest(ratio(c, "text"), _scale(stretch) * F.greatest(sliced(c, "text"), WORD_SCALE * by_slice))
        return F.least(F.lit(100.0), F.when(stretch < SLICE_FROM, near).otherwise(far))

    return _once(common, bound)
