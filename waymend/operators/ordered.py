"""Values that depend on the order of rows within a key, at any key size.

A window function needs all rows of a key in one task. That is the plan for keys up
to ``hot_rows`` rows. Larger keys are cut into pieces at borders taken from the data:
the quantiles of a hashed sample of their rows, one border for about ``hot_rows`` rows. A
row's piece depends on its values alone, so nothing has to be written; each piece is
computed on its own; and one summary row per piece carries the missing part across the
borders. Borders and summary have about rows / ``hot_rows`` rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000


@dataclass
class Ordered:
    """One derived column.

    kind: previous / following (value of the neighbour row), position (1..n),
    running (inclusive sum), last_before / next_after (nearest non-null value),
    whole_sum / whole_min / whole_max (over all rows of the key).
    """

    kind: str
    value: Column | None = None


def position():
    return Ordered("position")


def _windows(keys, order):
    up = [F.col(c).asc_nulls_last() for c in order]
    down = [F.col(c).desc_nulls_first() for c in order]
    base = Window.partitionBy(*keys)
    return base, base.orderBy(*up), base.orderBy(*down)


def _local(spec, base, up, down):
    before = Window.unboundedPreceding
    v = spec.value
    return {
        "previous": lambda: F.lag(v).over(up),
        "following": lambda: F.lead(v).over(up),
        "position": lambda: F.row_number().over(up).cast("long"),
        "running": lambda: F.sum(F.coalesce(v, F.lit(0))).over(up.rowsBetween(before, 0)),
        "last_before": lambda: F.last(v, ignorenulls=True).over(up.rowsBetween(before, -1)),
        "next_after": lambda: F.last(v, ignorenulls=True).over(down.rowsBetween(before, -1)),
        "whole_sum": lambda: F.sum(F.coalesce(v, F.lit(0))).over(base),
        "whole_min": lambda: F.min(v).over(base),
        "whole_max": lambda: F.max(v).over(base),
    }[spec.kind]()


def _edge(spec, place):
    """What one piece has to tell the others."""
    v = spec.value
    present = F.when(v.isNotNull(), place) if v is not None else None
    return {
        "previous": lambda: F.max_by(v, place),
        "following": lambda: F.min_by(v, place),
        "position": lambda: F.count("*"),
        "running": lambda: F.sum(F.coalesce(v, F.lit(0))),
        "last_before": lambda: F.max_by(v, present),
        "next_after": lambda: F.min_by(v, present),
        "whole_sum": lambda: F.sum(F.coalesce(v, F.lit(0))),
        "whole_min": lambda: F.min(v),
        "whole_max": lambda: F.max(v),
    }[spec.kind]()


def _carry(kind, edge, base, up, down):
    before = Window.unboundedPreceding
    return {
        "previous": lambda: F.lag(edge).over(up),
        "following": lambda: F.lead(edge).over(up),
        "position": lambda: F.sum(edge).over(up.rowsBetween(before, -1)),
        "running": lambda: F.sum(edge).over(up.rowsBetween(before, -1)),
        "last_before": lambda: F.last(edge, ignorenulls=True).over(up.rowsBetween(before, -1)),
        "next_after": lambda: F.last(edge, ignorenulls=True).over(down.rowsBetween(before, -1)),
        "whole_sum": lambda: F.sum(edge).over(base),
        "whole_min": lambda: F.min(edge).over(base),
        "whole_max": lambda: F.max(edge).over(base),
    }[kind]()


def _combined(kind, local, carry):
    return {
        "previous": lambda: F.when(F.col("_first_in_piece"), carry).otherwise(local),
        "following": lambda: F.when(F.col("_last_in_piece"), carry).otherwise(local),
        "position": lambda: local + F.coalesce(carry, F.lit(0)),
        "running": lambda: local + F.coalesce(carry, F.lit(0)),
        "last_before": lambda: F.coalesce(local, carry),
        "next_after": lambda: F.coalesce(local, carry),
        "whole_sum": lambda: carry,
        "whole_min": lambda: carry,
        "whole_max": lambda: carry,
    }[kind]()


def _add(df, keys, order, specs):
    base, up, down = _windows(keys, order)
    return df.withColumns({name: _local(s, base, up, down) for name, s in specs.items()})


def hot_keys(df: DataFrame, keys: list, hot_rows: int):
    """Keys with more than ``hot_rows`` rows, and their total; runs one small job."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    total = counts.agg(F.sum("_n")).first()[0]
    return counts.select(*keys), total or 0


#: Sampled rows for each border.
PER_BORDER = 8


def _place(order):
    """The sort order as one value; nulls last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def _borders(rows: DataFrame, keys: list, order: list, hot_rows: int) -> DataFrame:
    """keys, ``_borders``: the sorted quantiles of a sample of each key's rows."""
    per = min(PER_BORDER, hot_rows)
    sample = rows.where(F.pmod(F.xxhash64(*order), F.lit(max(1, hot_rows // per))) == 0).select(*keys, *order)
    up = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    picked = sample.withColumn("_rank", F.row_number().over(up)).where(F.col("_rank") % per == 0)
    return picked.groupBy(*keys).agg(F.array_sort(F.collect_list(_place(order))).alias("_borders"))


def _borders_below(place, borders):
    """How many of the sorted borders are not above ``place``: by halves, so a thousand borders take ten looks."""
    powers = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    halves = F.slice(powers, 31 - F.floor(F.log2(F.size(borders))).cast("int"), F.lit(31))
    below = F.aggregate(halves, F.lit(0), lambda n, half: F.when(F.try_element_at(borders, n + half) <= place, n + half).otherwise(n))
    return F.when(F.size(borders) > 0, below).otherwise(0)


def with_ordered(
    df: DataFrame, keys: list, order: list, specs: dict, hot_rows: int = HOT_ROWS, hot=None
) -> DataFrame:
    """Add the columns of ``specs`` (name -> Ordered).

    ``order`` names columns that sort the rows of a key completely, ascending with
    nulls last; the key columns must not be null. ``hot`` is an earlier result of
    ``hot_keys`` for the same keys, when several calls share it.
    """
    hot, total = hot or hot_keys(df, keys, hot_rows)
    if not total:
        return _add(df, keys, order, specs)

    # Hot keys and borders have at most one row or border for ``hot_rows`` rows. Joined by the key, all rows of a
    # hot key would meet in one task before they are cut.
    hot = F.broadcast(hot)
    cold_part = _add(df.join(hot, keys, "left_anti").select(df.columns), keys, order, specs)
    hot_rows_ = df.join(hot, keys, "left_semi").select(df.columns)
    place = _place(order)
    # The place is a column before the join: a search would build it at every look.
    cut = hot_rows_.withColumn("_place", place).join(F.broadcast(_borders(hot_rows_, keys, order, hot_rows)), keys, "left").select(
        *df.columns,
        F.coalesce(_borders_below(F.col("_place"), F.col("_borders")), F.lit(0)).alias("_piece"),
    )
    inner = keys + ["_piece"]
    # As many tasks as pieces: packed by bytes, a task would get as many pieces as compress well.
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // hot_rows))
    edges = cut.groupBy(*inner).agg(
        *[_edge(s, place).alias(f"_edge_{n}") for n, s in specs.items()]
    )
    base, up, down = _windows(keys, ["_piece"])
    carries = edges.select(
        *inner,
        *[
            _carry(s.kind, F.col(f"_edge_{n}"), base, up, down).alias(f"_carry_{n}")
            for n, s in specs.items()
        ],
    )
    _, piece_up, piece_down = _windows(inner, order)
    local = _add(cut.repartition(tasks, *inner), inner, order, {f"_local_{n}": s for n, s in specs.items()}).withColumns(
        {
            "_first_in_piece": F.row_number().over(piece_up) == 1,
            "_last_in_piece": F.row_number().over(piece_down) == 1,
        }
    )
    joined = local.join(carries, inner)
    hot_part = joined.select(
        *df.columns,
        *[
            _combined(s.kind, F.col(f"_local_{n}"), F.col(f"_carry_{n}")).alias(n)
            for n, s in specs.items()
        ],
    )
    return cold_part.unionByName(hot_part)


FILE_BLOCK = 16_384


def previous_in_file(
    df: DataFrame, row_id: str, values: list, name: str, block: int = FILE_BLOCK
) -> DataFrame:
    """Struct ``name`` = ``values`` of the row with the row number one lower.

    ``row_id`` must be dense. Rows are grouped into equal blocks of the file, so the
    windows are the same size whatever the keys are; the last row of a block is also
    shown to the block behind it, for which no second scan or join is needed.
    """
    own = F.expr(f"`{row_id}` div {block}")
    last = F.col(row_id) % block == block - 1
    shown = df.withColumn(
        "_block", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    in_block = Window.partitionBy("_block").orderBy(row_id)
    return (
        shown.withColumn(name, F.lag(F.struct(*values)).over(in_block))
        .where(F.col("_block") == own)
        .drop("_block")
    )


def neighbours_in_file(
    df: DataFrame, row_id: str, before: list, after: list, block: int = FILE_BLOCK
) -> DataFrame:
    """Structs ``before`` and ``after`` of the rows with the next lower and higher row number.

    Like ``previous_in_file``, for both sides in the same pass: the rows at the edges of a
    block are also shown to the block next to it.
    """
    own = F.expr(f"`{row_id}` div {block}")
    place = F.col(row_id) % block
    shown_to = F.filter(
        F.array(own, F.when(place == block - 1, own + 1), F.when((place == 0) & (own > 0), own - 1)),
        lambda b: b.isNotNull(),
    )
    in_block = Window.partitionBy("_block").orderBy(row_id)
    shown = df.withColumn("_block", F.explode(shown_to))
    found = shown.withColumns(
        {
            "before": F.lag(F.struct(*before)).over(in_block),
            "after": F.lead(F.struct(*after)).over(in_block),
        }
    )
    return found.where(F.col("_block") == own).drop("_block")
