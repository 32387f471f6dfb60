"""Station names to codes: exact, alias, unique prefix, similarity, suggestions.

Every stage sees the distinct names the earlier stages left over. The master table
(code, canonical_name, aliases, ord = its row order) decides ties: of equal names the
last row counts, of equal scores the name that came first.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions.fixed_values import FUZZY_ACCEPT, SUGGESTIONS, extra_aliases
from waymend.functions.text import normalize_name
from waymend.functions.weighted import prepared, upper_bound, weighted_of
from waymend.operators.keyed import last_per_key, top_per_key
from waymend.operators.ordered import Ordered, with_ordered
from waymend.session import frozen

# Reference names in one row, open names of one group, and the least number of groups.
BLOCK_NAMES = 512
GROUP_NAMES = 4096
NAME_GROUPS = 8
# All names may begin with the same letter, so the sequence of a letter is cut early, into pieces of this many rows.
NAME_ROWS = 100_000


def canonical_names(master: DataFrame) -> DataFrame:
    """One row per normalised canonical name: its last station, its first place."""
    named = master.withColumn("query", normalize_name("canonical_name"))
    return named.groupBy("query").agg(
        F.max_by(F.struct("code", "canonical_name"), F.col("ord")).alias("_s"),
        F.min("ord").alias("first_ord"),
        F.count("*").alias("stations"),
    ).select("query", "_s.code", "_s.canonical_name", "first_ord", "stations")


def alias_names(master: DataFrame) -> DataFrame:
    """One row per normalised alias: master aliases, then the well-known ones."""
    extra = master.sparkSession.createDataFrame(
        [(code, i, name) for i, (code, name) in enumerate(extra_aliases())],
        "code string, place int, alias string",
    )
    own = master.select(
        "code", "canonical_name", "ord", F.posexplode("aliases").alias("place", "alias")
    ).withColumn("known", F.lit(0))
    more = master.select("code", "canonical_name", "ord").join(extra, "code").withColumn("known", F.lit(1))
    columns = ["code", "canonical_name", "ord", "known", "place", normalize_name("alias").alias("query")]
    rows = own.select(*columns).unionByName(more.select(*columns))
    return last_per_key(rows, "query", ["code", "canonical_name"], F.struct("ord", "known", "place"))


def resolve_exact(queries: DataFrame, master: DataFrame) -> DataFrame:
    return queries.join(canonical_names(master).select("query", "code", "canonical_name"), "query")


def resolve_alias(queries: DataFrame, master: DataFrame) -> DataFrame:
    return queries.join(alias_names(master), "query")


#: Sorts behind every text that begins with what stands in front of it.
BEHIND = "\U0010ffff"


def resolve_prefix(queries: DataFrame, master: DataFrame, hot_rows: int = NAME_ROWS) -> DataFrame:
    """Names that begin, or are begun by, the name of exactly one station.

    Names and stations stand in one sorted sequence, by first letter. A station opens at its name and
    closes behind every text that begins with it; so the stations that begin a name are those open
    at the name, and those that the name begins are the ones opened between the name and its own end.
    Both are differences of running counts. A running sum of station numbers goes with each count: where
    the count is one, the sum is the station.
    """
    # Each is read several times below; what they are made of is worked out once.
    queries = frozen(queries.select("query"))
    stations = frozen(master.select("code", "canonical_name", "ord", normalize_name("canonical_name").alias("name")))

    def marks(df, text, rank, place=None):
        return df.select(
            F.substring(text, 1, 1).alias("letter"), text.alias("text"), F.lit(rank).cast("byte").alias("rank"),
            (F.lit(0) if place is None else F.col(place)).cast("long").alias("place"),
        )

    named, name, query = stations.where("name <> ''"), F.col("name"), F.col("query")
    rows = [
        marks(queries, query, 0),
        marks(named, name, 1, "ord"),
        marks(named, F.concat(name, F.lit(BEHIND)), 2, "ord"),
        marks(queries, F.concat(query, F.lit(BEHIND)), 3),
    ]
    sequence = reduce(lambda x, y: x.unionByName(y), rows)
    opens, closes, place = F.col("rank") == 1, F.col("rank") == 2, F.col("place")
    # Rows carry no more than text, rank and place; what they count follows from the rank.
    counts = {
        "opened": F.when(opens, F.lit(1).cast("long")), "opened_sum": F.when(opens, place),
        "open": F.when(opens, F.lit(1).cast("long")).when(closes, F.lit(-1).cast("long")), "open_sum": F.when(opens, place).when(closes, -place),
    }
    placed = with_ordered(
        sequence, ["letter"], ["text", "rank", "place"], {f"all_{c}": Ordered("running", v) for c, v in counts.items()}, hot_rows
    )
    start, end = F.col("rank") == 0, F.col("rank") == 3

    def at(mark, column):
        return F.max(F.when(mark, F.col(column)))

    # Stations without a name begin every name.
    nameless = stations.where("name = ''")
    more, more_sum = nameless.agg(F.count(F.lit(1))).scalar(), nameless.agg(F.sum(F.col("ord").cast("long"))).scalar()
    own = F.when(end, F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    per_query = placed.where(start | end).groupBy(own.alias("query")).agg(
        (at(end, "all_opened") - at(start, "all_opened") + at(start, "all_open")).alias("n"),
        (at(end, "all_opened_sum") - at(start, "all_opened_sum") + at(start, "all_open_sum")).alias("number"),
    )
    one = per_query.where(F.col("n") + more == 1).select("query", (F.col("number") + F.coalesce(more_sum, F.lit(0))).alias("ord"))
    return one.join(stations.select(F.col("ord").cast("long").alias("ord"), "code", "canonical_name"), "ord").select(
        "query", "code", "canonical_name"
    )


def _best_of_block(asked, names):
    """The best names of a block for one open name: (-score, first_ord), sorted.

    Branch and bound: names come by descending upper bound, and a name whose bound is below
    the score of the last one kept is not scored.
    """
    bounded = F.transform(names, lambda n: F.struct(
        (-(upper_bound(asked, n["name"]) + 1e-6)).alias("bound"), n["first_ord"].alias("ord"), n["name"].alias("name")
    ))

    def step(best, n):
        full = F.size(best) == SUGGESTIONS
        hopeless = full & (n["bound"] > F.element_at(best, -1)["less"])
        scored = F.struct((-F.round(weighted_of(asked, n["name"]), 9)).alias("less"), n["ord"].alias("ord"))
        return F.when(F.coalesce(hopeless, F.lit(False)), best).otherwise(
            F.slice(F.array_sort(F.concat(best, F.array(scored))), 1, SUGGESTIONS)
        )

    none = F.array().cast("array<struct<less:double,ord:bigint>>")
    by_bound = F.array_sort(bounded, lambda x, y: F.when(x["bound"] < y["bound"], -1).when(x["bound"] > y["bound"], 1).otherwise(
        F.when(x["ord"] < y["ord"], -1).when(x["ord"] > y["ord"], 1).otherwise(0)
    ))
    return F.aggregate(by_bound, none, step)


def closest_names(queries: DataFrame, canonical: DataFrame, groups: int = NAME_GROUPS) -> DataFrame:
    """The five most similar canonical names of every open name: query, score,
    first_ord, rank.

    Any two names have a score, so every open name meets every block of names, but not every
    name: within a block, letter counts bound the score from above, and only names that can still
    be among the best are compared. A block is one row of about ``BLOCK_NAMES`` names; groups follow
    the number of open names, and a row hands on five names, never the pairs.
    """
    spark = queries.sparkSession
    blocks = max(1, -(-canonical.count() // BLOCK_NAMES))
    groups = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-queries.count() // GROUP_NAMES))
    asked = queries.select(
        "query", prepared("query").alias("asked"),
        F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("group"),
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    named = canonical.where("query <> ''").select(
        F.struct(F.col("first_ord").cast("long").alias("first_ord"), prepared("query").alias("name")).alias("n"),
        F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"),
    )
    packed = named.groupBy("block").agg(F.collect_list("n").alias("names")).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    met = asked.join(packed, ["group", "block"]).select("query", _best_of_block(F.col("asked"), F.col("names")).alias("best"))
    scored = met.select("query", F.explode("best").alias("x")).select("query", (-F.col("x.less")).alias("score"), F.col("x.ord").alias("first_ord"))
    return top_per_key(scored, ["query"], [F.desc("score"), F.asc("first_ord")], SUGGESTIONS, "rank")


def resolve_queries(queries: DataFrame, master: DataFrame, groups: int = NAME_GROUPS) -> DataFrame:
    """Matches of distinct normalised, non-empty names.

    query, matched, station_code, canonical_name, method, confidence, suggestions. The
    names left after a stage are checkpointed: they are few next to the rows they come
    from, and every later stage reads them more than once.
    """
    none = F.lit(None).cast("array<string>")

    def staged(names, *found):
        """Names with the first method that knows them."""
        out, codes, titles, methods = names.select("query"), [], [], []
        for i, (method, df) in enumerate(found):
            out = out.join(
                df.select("query", F.col("code").alias(f"c{i}"), F.col("canonical_name").alias(f"n{i}"),
                          F.lit(method).alias(f"m{i}")),
                "query", "left",
            )
            codes.append(F.when(F.col(f"m{i}").isNotNull(), F.col(f"c{i}")))
            titles.append(F.when(F.col(f"m{i}").isNotNull(), F.col(f"n{i}")))
            methods.append(F.col(f"m{i}"))
        return frozen(
            out.select(
                "query", F.coalesce(*codes).alias("station_code"),
                F.coalesce(*titles).alias("canonical_name"), F.coalesce(*methods).alias("method"),
            )
        )

    def done(df):
        return df.where("method is not null").select(
            "query", F.lit(True).alias("matched"), "station_code", "canonical_name", "method",
            F.lit(100.0).alias("confidence"), none.alias("suggestions"),
        )

    canonical = canonical_names(master)
    by_table = staged(queries, ("EXACT", canonical), ("ALIAS", alias_names(master)))
    open_ = by_table.where("method is null")
    by_prefix = staged(open_, ("PREFIX", resolve_prefix(open_.select("query"), master)))
    open_ = by_prefix.where("method is null").select("query")
    known = done(by_table).unionByName(done(by_prefix))
    if open_.isEmpty():  # a written table of names: no need to plan the comparison of letters
        return known

    best = closest_names(open_, canonical, groups).join(
        canonical.select("first_ord", "code", "canonical_name"), "first_ord"
    )
    ranked = best.groupBy("query").agg(
        F.max_by(F.struct("score", "code", "canonical_name"), -F.col("rank")).alias("top"),
        F.array_sort(F.collect_list(F.struct("rank", "canonical_name"))).alias("names"),
    )
    good = F.col("top.score") >= FUZZY_ACCEPT
    fuzzy = ranked.select(
        "query", good.alias("matched"),
        F.when(good, F.col("top.code")).otherwise("").alias("station_code"),
        F.when(good, F.col("top.canonical_name")).otherwise("").alias("canonical_name"),
        F.when(good, "FUZZY").otherwise("").alias("method"),
        F.when(good, F.bround("top.score", 2)).otherwise(0.0).alias("confidence"),
        F.when(~good, F.transform("names", lambda x: x["canonical_name"])).alias("suggestions"),
    )
    return frozen(known.unionByName(fuzzy))


def resolve_names(names: DataFrame, master: DataFrame, column="name", groups: int = NAME_GROUPS) -> DataFrame:
    """Match of every distinct name: ``column`` plus the columns of ``resolve_queries``.

    A name that is empty once normalised is unmatched and has no suggestions.
    """
    distinct = frozen(names.select(column).distinct().withColumn("query", normalize_name(column)))
    queries = distinct.select("query").where("query <> ''").distinct()
    matches = resolve_queries(queries, master, groups)
    text = {c: F.coalesce(c, F.lit("")) for c in ("station_code", "canonical_name", "method")}
    return (
        distinct.join(matches, "query", "left")
        .withColumns({
            **text,
            "matched": F.coalesce("matched", F.lit(False)),
            "confidence": F.coalesce("confidence", F.lit(0.0)),
        })
        .drop("query")
    )


def resolve_codes(codes: DataFrame, master: DataFrame, column="code") -> DataFrame:
    """Stations by code; of a repeated code the last master row counts."""
    last = last_per_key(master, "code", ["canonical_name", "aliases"], F.col("ord"))
    return codes.join(last.withColumnRenamed("code", column), column, "left")
