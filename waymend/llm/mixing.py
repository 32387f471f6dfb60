"""Mix sources to target weights: subset-sum budget fitting.

Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...; each gets its share of
the total size, at most ``most`` times what it has (the excess goes to the others by weight
until nobody is above). A source takes as many whole rounds of all its documents as fit its
target. For the rest of the budget, documents are counted by exact length: each length gives
the rounded-down proportional part of its documents, and a bounded-knapsack table over (length,
documents left) fills what remains exactly, or as nearly as it can; if that misses, the table
decides over all documents. Budgets beyond the table's size first take, in a seeded order,
single further documents while they fit. Of a budget above half of the source, what is left out
is chosen instead. Which documents of a length are taken is decided by a seeded hash of the id.

Only counts meet in one place: (source, length, documents), whose number for one source is
bounded by the square root of its words. Documents of one length are ranked in ranges of
their hash of about ``range_rows`` rows each, so a hot length is spread.

Defined cases: null texts and texts without words have size 0 and take 0; a null source is a
source of its own, the last; ids may be null (such rows are ranked like others); sources without words have target 0 and give their share away;
when everything has size 0 all targets are 0; repeated rows of an id are ranked one by one;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymend.llm.common import WORD, staged

CYCLE = (5, 2, 1)


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Target of each source; capped ones hand the excess to the others by weight."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        weight = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not above:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in sorted(above):
            out[i] = most * float(sizes[i])
        left -= sum(out[i] for i in sorted(above))
        open_ -= above
    return out


def fill(budget: int, lengths: np.ndarray, counts: np.ndarray, most_cells: int = 4_000_000) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to ``budget``
    or to the largest sum below it that the table reaches.

    Bounded knapsack: counts are split into powers of two; ``reached`` remembers for each sum
    the part that first reached it, which is enough to walk back. Budgets beyond
    ``most_cells`` are first cut down by whole documents.
    """
    taken = np.zeros(len(lengths), np.int64)
    usable = np.flatnonzero((lengths > 0) & (counts > 0))
    for i in usable[np.argsort(-lengths[usable], kind="stable")]:
        if budget <= most_cells:
            break
        taken[i] = min(counts[i], (budget - most_cells + lengths[i] - 1) // lengths[i], budget // lengths[i])
        budget -= int(taken[i] * lengths[i])
    reached = np.full(budget + 1, -1, np.int64)
    open_sums = np.zeros(budget + 1, bool)
    open_sums[0] = True
    parts: list[tuple[int, int]] = []
    for i in usable[np.argsort(-lengths[usable], kind="stable")]:
        left, chunk = int(counts[i] - taken[i]), 1
        while left > 0 and not open_sums[budget]:
            n = min(chunk, left)
            step = n * int(lengths[i])
            if step <= budget:
                fresh = open_sums[:-step] & ~open_sums[step:] if step else np.zeros(0, bool)
                at = np.flatnonzero(fresh) + step
                reached[at] = len(parts)
                open_sums[at] = True
                parts.append((i, n))
            left, chunk = left - n, 2 * chunk
    at = int(np.flatnonzero(open_sums)[-1])
    while at > 0:
        i, n = parts[reached[at]]
        taken[i] += n
        at -= n * int(lengths[i])
    return taken


def choose(
    budget: int, lengths: np.ndarray, counts: np.ndarray, seed: int, most_cells: int = 4_000_000, most_work: int = 3_000_000_000
) -> np.ndarray:
    """Documents to take of each length so that their lengths add up to ``budget``, or nearly."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    if 2 * budget > total:
        return counts - choose(total - budget, lengths, counts, seed, most_cells, most_work)
    # Integer arithmetic: counts times budget can pass 2**53.
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((lengths * taken).sum())
    parts = sum(int(c).bit_length() for c in counts)
    if left <= most_cells and left * parts <= most_work:
        near = taken + fill(left, lengths, counts - taken, most_cells)
        if int((near * lengths).sum()) == budget or budget > most_cells or budget * parts > most_work:
            return near
        whole = fill(budget, lengths, counts, most_cells)
        return max(near, whole, key=lambda t: int((t * lengths).sum()))
    order = np.random.default_rng(seed).permutation(len(lengths))
    reserve = 4 * int(lengths.max())  # leave the table something to work with
    for i in order:
        if taken[i] < counts[i] and 0 < lengths[i] <= left - reserve:
            taken[i] += 1
            left -= int(lengths[i])
    return taken + fill(left, lengths, counts - taken)


def mix(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", cycle: Sequence[int] = CYCLE,
    most: int = 3, seed: int = 11, range_rows: int = 20_000, most_sources: int = 100_000,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted), times."""
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = staged(sized)
    counts = staged(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("words"))
    rows = by_source.limit(most_sources + 1).collect()  # one row per source
    if len(rows) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be", "surrogatepass")))
    weights = [cycle[i % len(cycle)] for i in range(len(rows))]
    goal = targets([r["words"] for r in rows], weights, most)
    plan = spark.createDataFrame(
        [(r["source"], r["words"], float(t), i) for i, (r, t) in enumerate(zip(rows, goal, strict=True))],
        "source string, words long, target double, place long",
    )

    def decide(pdf):
        words, target, place = int(pdf["words"].iloc[0]), float(pdf["target"].iloc[0]), int(pdf["place"].iloc[0])
        pdf = pdf.sort_values("size")
        rounds = min(most, int(target // words)) if words else 0
        budget = int(round(target)) - rounds * words
        lengths, n = pdf["size"].to_numpy(np.int64), pdf["docs"].to_numpy(np.int64)
        once = choose(budget, lengths, n, seed + place) if rounds < most else np.zeros(len(pdf), np.int64)
        return pdf[["place", "size", "docs", "words", "target"]].assign(rounds=rounds, once=once)

    quotas = (
        counts.join(F.broadcast(plan), counts["source"].eqNullSafe(plan["source"]))
        .select("place", "size", "docs", "words", "target").groupBy("place")
        .applyInPandas(decide, "place long, size long, docs long, words long, target double, rounds long, once long")
    )
    quotas = staged(quotas)
    # The place of a row in its range of the hash; ranges before it are counted, not ranked.
    placed = sized.join(F.broadcast(plan.select(F.col("source").alias("_s"), "place")), sized["source"].eqNullSafe(F.col("_s")))
    rows_ = placed.join(quotas, ["place", "size"]).withColumn("hash", F.xxhash64("id", F.lit(seed)))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("docs") / range_rows))
    share = F.pmod(F.shiftrightunsigned("hash", 12), F.lit(1 << 50)) / float(1 << 50)
    rows_ = rows_.withColumn("range", F.floor(share * ranges))
    ahead = (
        rows_.groupBy("place", "size", "range").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("place", "size").orderBy("range")) - F.col("n"))
        .where("before > 0").drop("n")
    )
    ranked = rows_.withColumn(
        "rank", F.row_number().over(Window.partitionBy("place", "size", "range").orderBy(share, "id"))
    ).join(ahead, ["place", "size", "range"], "left")
    times = F.col("rounds") + (F.col("rank") + F.coalesce("before", F.lit(0)) <= F.col("once")).cast("long")
    return ranked.select(
        F.col("id").alias(id_col), "size", F.col("words").alias("source_size"), "target",
        (times * F.col("size")).alias("taken"), times.alias("times"),
    )
