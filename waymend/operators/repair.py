"""Repairs that only use values already present in the table, and format cleaning."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions.text import (
    is_na_placeholder, norm_ref_name, reformat_clock, strip_train_suffix, to_number,
)
from waymend.operators.audit import malformed_train_rule
from waymend.operators.ordered import HOT_ROWS, Ordered, hot_keys, neighbours_in_file, with_ordered
from waymend.roles import BASE
from waymend.session import frozen

# A split-off row carries these seven fields shifted to the left.
TAIL = BASE[5:12]
SHIFTED = BASE[1:8]
TIMING = ["arrival", "departure", "distance"]


def _with_pieces(df: DataFrame) -> DataFrame:
    """Rows with their file neighbours; ``fixed``: the row behind completes this one;
    ``gone``: this one completes the row in front of it.

    A malformed row completes the file row in front of it if all seven tail fields
    there are placeholders. Needs dense ``row_id``.
    """
    open_tail = reduce(lambda a, b: a & b, [is_na_placeholder(c) for c in TAIL])
    marked = df.withColumns({"_open": open_tail, "_piece": malformed_train_rule()})
    seen = neighbours_in_file(marked, "row_id", ["_open"], ["_piece", *BASE])
    return seen.withColumns(
        {
            "fixed": F.coalesce(F.col("_open") & F.col("after._piece"), F.lit(False)),
            "gone": F.coalesce(F.col("_piece") & F.col("before._open"), F.lit(False)),
        }
    )


def split_row_fixes(df: DataFrame) -> DataFrame:
    """One row per repaired pair: row_id of the good row, before, after, removed (structs)."""
    after = [F.col(c) for c in BASE[:5]] + [
        F.col(f"after.{s}").alias(t) for t, s in zip(TAIL, SHIFTED)
    ]
    return _with_pieces(df).where("fixed").select(
        "row_id", F.struct(*BASE).alias("before"), F.struct(*after).alias("after"),
        F.struct(*[F.col(f"after.{c}").alias(c) for c in BASE]).alias("removed"),
    )


def repair_changes(df: DataFrame) -> DataFrame:
    """The repair row by row: row_id, train_no, seq, station_code, the tail before and after,
    and the number of the row that was removed for it."""
    fixes = split_row_fixes(df)
    return fixes.select(
        "row_id", "before.train_no", "before.seq", "before.station_code",
        *[F.col(f"before.{c}").alias(f"{c}_before") for c in TAIL],
        *[F.col(f"after.{c}").alias(f"{c}_after") for c in TAIL],
        (F.col("row_id") + 1).alias("removed_row_id"),
    )


def repair_split_rows(df: DataFrame) -> DataFrame:
    """The table with repaired rows completed and their split-off pieces removed."""
    new = {
        t: F.when(F.col("fixed"), F.col(f"after.{s}")).otherwise(F.col(t)) for t, s in zip(TAIL, SHIFTED)
    }
    return _with_pieces(df).where("not gone").withColumns(new).select(df.columns)


def repair_log(df: DataFrame) -> DataFrame:
    """(measure, value) totals of the repair."""
    fixes = split_row_fixes(df).agg(F.count("*").alias("n"))
    n = F.col("n")
    pairs = [
        F.struct(F.lit(name).alias("measure"), value.alias("value"))
        for name, value in (
            ("rows_reconstructed", n), ("rows_removed_after_reconstruction", n),
            ("net_row_count_change", -n),
        )
    ]
    from_fixes = fixes.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")
    before = df.agg(F.count("*").alias("value")).select(
        F.lit("original_row_count").alias("measure"), "value"
    )
    after = (
        before.select("value").unionByName(fixes.select((-n).alias("value")))
        .agg(F.sum("value").alias("value"))
        .select(F.lit("cleaned_row_count").alias("measure"), "value")
    )
    return from_fixes.unionByName(before).unionByName(after)


def normalize_format(df: DataFrame) -> DataFrame:
    """Clock texts to HH:MM:SS (blanks and other texts kept), ' Train' suffix removed."""
    return df.withColumns(
        {
            "arrival": reformat_clock("arrival"),
            "departure": reformat_clock("departure"),
            "train_name": strip_train_suffix("train_name"),
        }
    )


def adjacent_runs(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with ``run``: consecutive stops of a train at the same code share a run."""
    rows = df.where("train_no is not null").withColumn("seq_num", to_number("seq"))
    hot = hot_keys(df.where("train_no is not null").select("train_no"), ["train_no"], hot_rows)
    order = ["seq_num", "row_id"]
    code = {"_before": Ordered("previous", F.struct("station_code"))}
    marked = with_ordered(rows, ["train_no"], order, code, hot_rows, hot).withColumn(
        "_starts",
        F.when(F.col("_before.station_code") == F.col("station_code"), 0).otherwise(1).cast("long"),
    )
    if hot[1]:  # the next step reads the rows of long trains three times
        marked = frozen(marked)
    runs = {"run": Ordered("running", F.col("_starts"))}
    return with_ordered(marked, ["train_no"], order, runs, hot_rows, hot).drop("_before", "_starts")


def merge_adjacent_duplicates(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Settle stops repeated back to back.

    identical (equal timing and distance): the first stays; complementary (no field
    with two values): merged into the first; conflicting: all stay, for manual work.
    ``adjacent_kind`` names the case, null for single stops. Repeats that are not
    adjacent are left alone, as are rows without a train number.
    """
    rows = adjacent_runs(df, hot_rows)
    place = F.struct(F.col("seq_num").isNull(), "seq_num", "row_id")
    runs = rows.groupBy("train_no", "run").agg(
        F.count("*").alias("n"),
        F.min(place).alias("head"),
        *[F.min(c).alias(f"low_{c}") for c in TIMING],
        *[F.max(c).alias(f"high_{c}") for c in TIMING],
        *[F.count(c).alias(f"count_{c}") for c in TIMING],
    ).where("n > 1")
    conflict, equal = F.lit(False), F.lit(True)
    for c in TIMING:
        conflict = conflict | F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False))
        equal = equal & ((F.col(f"count_{c}") == 0) | (F.col(f"count_{c}") == F.col("n")))
    kind = F.when(conflict, "conflicting").when(equal, "identical").otherwise("complementary")
    settled = runs.select(
        "train_no", "run", F.col("head.row_id").alias("head_id"), kind.alias("adjacent_kind"),
        *[F.col(f"low_{c}") for c in TIMING],
    )
    joined = rows.join(settled, ["train_no", "run"], "left")
    kept = joined.where(
        "adjacent_kind is null or adjacent_kind = 'conflicting' or row_id = head_id"
    )
    merged = {
        c: F.when(F.col("adjacent_kind") == "complementary", F.col(f"low_{c}")).otherwise(F.col(c))
        for c in TIMING
    }
    others = df.where("train_no is null").withColumn("adjacent_kind", F.lit(None).cast("string"))
    return kept.withColumns(merged).select(*df.columns, "adjacent_kind").unionByName(others)


def suggest_codes(df: DataFrame, reference: DataFrame) -> DataFrame:
    """``code_suggestion`` for one-letter codes cut from the name, else ''.

    Only a name with exactly one reference entry gets a suggestion; the code itself
    is not touched. reference: code, name.
    """
    unique = (
        reference.select(norm_ref_name("name").alias("_key"), "code").where("_key <> ''").distinct()
        .groupBy("_key").agg(F.count("*").alias("n"), F.min("code").alias("_suggested"))
        .where("n = 1").select("_key", "_suggested")
    )
    cut = (
        F.col("station_code").rlike("^[A-Z]$")
        & (F.upper(F.substring("station_name", 1, 1)) == F.col("station_code"))
    )
    keyed = df.withColumn("_key", F.when(cut, norm_ref_name("station_name")))
    return keyed.join(unique, "_key", "left").select(
        *df.columns, F.coalesce("_suggested", F.lit("")).alias("code_suggestion")
    )
