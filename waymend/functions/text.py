"""Text, number and clock functions, all native column expressions.

Digits and number texts follow ASCII rules. Empty and null inputs are stated per
function because the two families of input files treat blanks differently.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymend.functions import fixed_values as fv

# The characters that count as white space, and the same as a pattern.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_BLANK = r"[\s\x1c-\x1f]"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip all leading and trailing white space (Spark's trim only strips blanks)."""
    return F.btrim(_column(c), F.lit(WHITE_SPACE))


def cell_text(c) -> Column:
    """Trimmed text, null as ''. A text that begins and ends with a visible ASCII character, as most
    do, is taken as it is: trimming it costs three times as much as looking."""
    text = _column(c).cast("string")
    low, high = F.lit("!"), F.lit("~")
    bare = (text >= low) & (text < F.lit("\x7f")) & F.substring(text, -1, 1).between(low, high)
    return F.coalesce(F.when(bare, text).otherwise(trim_ws(text)), F.lit(""))


def is_blank(c) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(trim_ws(c) == "", F.lit(True))


def is_na_placeholder(c) -> Column:
    return F.coalesce(F.upper(trim_ws(c)).isin("NA", "NAN", ""), F.lit(True))


def to_number(c) -> Column:
    """Double, or null when the text is not a plain decimal number."""
    text = trim_ws(_column(c).cast("string"))
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z")
    return F.when(plain, text.try_cast("double"))


def whole_digits(c):
    """A whole number of any length as text: a minus if it has one, no leading zeros; null for
    any other text."""
    text = cell_text(c)
    digits = F.regexp_replace(text, r"^[+-]?0*(?=\d)", "")
    plain = F.when(text.startswith("-") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits)
    return F.when(text.rlike(r"^[+-]?\d+\z"), plain)


def whole_text(c):
    """As ``whole_digits``; numbers in another notation give their whole part, up to 38 digits."""
    other = F.when(cell_text(c).rlike(r"[.eE]"), to_number(c).try_cast("decimal(38,0)").cast("string"))
    return F.coalesce(whole_digits(c), other)


def number_place(whole):
    """Sort key of a whole number given as text: sign, length, digits (turned round below zero)."""
    below = whole.startswith("-")
    sign = F.when(below, -1).otherwise(1)
    digits = F.when(below, F.translate(F.substring(whole, 2, 1 << 30), "0123456789", "9876543210")).otherwise(whole)
    return F.when(whole.isNotNull(), F.struct(
        sign.alias("sign"), (sign * F.length(digits)).alias("n"), digits.alias("digits"), whole.alias("whole")
    ))


def is_clock(c) -> Column:
    return F.coalesce(_column(c).rlike(r"^\d{2}:\d{2}:\d{2}$"), F.lit(False))


def normalize_name(c) -> Column:
    """Comparable form of a station name; null and '' give ''."""
    name = trim_ws(F.lower(_column(c).cast("string")))
    for old, new in ((".", " "), (",", " "), ("&", " and "), ("-", " ")):
        name = F.replace(name, F.lit(old), F.lit(new))
    name = F.regexp_replace(name, r"\([^\n]*?\)", "")
    name = F.concat(F.lit(" "), name, F.lit(" "))
    for old, new in fv.NAME_REPLACEMENTS:
        name = F.replace(name, F.lit(old), F.lit(new))
    name = F.regexp_replace(name, rf"(?U){_BLANK}+", " ")
    return F.coalesce(trim_ws(name), F.lit(""))


def norm_ref_name(c) -> Column:
    """Upper-case form used against reference lists."""
    name = trim_ws(F.upper(_column(c)))
    name = F.regexp_replace(name, r"[.\-]", "")
    name = F.regexp_replace(name, r"(?U)\bJUNCTION\b", "JN")
    name = F.regexp_replace(name, rf"(?U){_BLANK}+", " ")
    return F.coalesce(trim_ws(name), F.lit(""))


def norm_endpoint_name(c) -> Column:
    """Letters A-Z only, without generic station words."""
    words = "|".join(fv.ENDPOINT_NOISE_WORDS)
    name = F.regexp_replace(F.upper(_column(c)), rf"(?U)\b({words})\b", "")
    return F.coalesce(F.regexp_replace(name, "[^A-Z]", ""), F.lit(""))


def norm_time(c) -> Column:
    """'7:24' -> '07:24:00'; any other text -> ''."""
    text = cell_text(c)
    parts = r"^(\d{1,2}):(\d{2})\z"
    clock = F.concat(
        F.lpad(F.regexp_extract(text, parts, 1), 2, "0"),
        F.lit(":"),
        F.regexp_extract(text, parts, 2),
        F.lit(":00"),
    )
    return F.when(text.rlike(parts), clock).otherwise(F.lit(""))


def endpoint_arrival(c) -> Column:
    return F.when(_column(c) == "Source", F.lit("")).otherwise(norm_time(c))


def endpoint_departure(c) -> Column:
    return F.when(_column(c) == "Destination", F.lit("")).otherwise(norm_time(c))


def parse_distance(c) -> Column:
    """'12 kms' -> '12'; any other text -> ''."""
    return F.regexp_extract(cell_text(c), r"(?i)^(\d+)\s*kms?\z", 1)


def split_station(c) -> tuple[Column, Column]:
    """(name, code) around the last ' - '; without one the whole text is the code."""
    text = _column(c)
    parts = r"(?s)^(.*) - (.*)\z"
    has = text.rlike(parts)
    name = F.when(has, trim_ws(F.regexp_extract(text, parts, 1))).otherwise(F.lit(""))
    code = F.when(has, trim_ws(F.regexp_extract(text, parts, 2))).otherwise(cell_text(text))
    return name, code


def strip_control_prefix(c) -> Column:
    marks = "|".join(fv.CONTROL_PREFIXES)
    return trim_ws(F.regexp_replace(trim_ws(c), rf"(?s)^({marks}) (.*)\z", "$2"))


def is_truncation_of(name, reference) -> Column:
    """Does ``name`` look like ``reference`` cut off at the source's field limit?"""
    name, reference = _column(name), _column(reference)
    starts = norm_ref_name(reference).startswith(norm_ref_name(name)) | F.upper(
        reference
    ).startswith(F.upper(name))
    usable = (reference != "") & (F.length(name) >= fv.TRUNCATION_LENGTH)
    return F.coalesce(usable & starts, F.lit(False))


def codes_are_aliases(a, b, pairs=None) -> Column:
    """Equal codes, or an unordered pair of the (small, literal) alias list."""
    a, b = _column(a), _column(b)
    pairs = fv.CODE_ALIASES if pairs is None else pairs
    known = [
        (F.least(a, b) == min(pair)) & (F.greatest(a, b) == max(pair)) for pair in pairs
    ]
    return F.coalesce(reduce(lambda x, y: x | y, known, a == b), F.lit(False))


def strip_leading_zeros(c) -> Column:
    text = F.regexp_replace(_column(c), "^0+", "")
    return F.when(text == "", F.lit("0")).otherwise(text)


def number_key(c) -> Column:
    """Train number without leading zeros; the text is stripped first."""
    return strip_leading_zeros(cell_text(c))


def digits_key(c) -> Column:
    """As ``number_key`` without stripping, and null unless the text is all digits."""
    return F.when(_column(c).rlike(r"^\d+\z"), strip_leading_zeros(c))


def has_encoding_issue(c) -> Column:
    """Control characters, edge or repeated white space, or non-ASCII characters."""
    text = _column(c)
    bad = (
        text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
        | text.rlike(rf"(?U)^{_BLANK}|{_BLANK}\z")
        | text.rlike(rf"(?U){_BLANK}{{2,}}")
        | text.rlike(r"[^\x00-\x7f]")
    )
    return F.coalesce(bad, F.lit(False))


def grade(score) -> Column:
    score = _column(score)
    return (
        F.when(score >= 90, "A").when(score >= 75, "B").when(score >= 60, "C")
        .when(score >= 40, "D").otherwise("F")
    )


def count_packed_stops(c) -> Column:
    """Stops of a packed text plus the two ends kept in their own columns."""
    items = F.split(F.coalesce(_column(c), F.lit("")), r"\|")
    return F.size(F.filter(items, lambda s: trim_ws(s) != "")) + 2


def parse_packed_stops(c) -> Column:
    """'A(arr=06:00,dep=06:05)|B(..)' -> array<struct<name, arrival, departure>>.

    Items without '(' are dropped; the character closing an item is dropped unread;
    of a repeated key the last value counts.
    """

    def field(body, key):
        pairs = F.filter(
            F.split(body, ","),
            lambda p: (F.instr(p, "=") > 0) & (trim_ws(F.substring_index(p, "=", 1)) == key),
        )
        last = F.try_element_at(pairs, F.lit(-1))
        value = trim_ws(F.substring(last, F.instr(last, "=") + 1, F.length(last)))
        return F.when(F.size(pairs) > 0, value).otherwise(F.lit(""))

    def stop(item):
        opening = F.instr(item, "(")
        body = F.substring(item, opening + 1, F.greatest(F.length(item) - opening - 1, F.lit(0)))
        return F.struct(
            trim_ws(F.substring(item, F.lit(1), opening - 1)).alias("name"),
            field(body, "arr").alias("arrival"),
            field(body, "dep").alias("departure"),
        )

    items = F.transform(F.split(cell_text(c), r"\|"), trim_ws)
    return F.transform(F.filter(items, lambda s: F.instr(s, "(") > 0), stop)


def reformat_clock(c) -> Column:
    """'7:24' -> '07:24:00'; other texts and nulls stay as they are."""
    return F.when(cell_text(c).rlike(r"^\d{1,2}:\d{2}\z"), norm_time(c)).otherwise(_column(c))


def strip_train_suffix(c) -> Column:
    return F.regexp_replace(_column(c), r" Train\z", "")
