"""URL filter: listed rules first, mined association rules for the rest.

A listed rule is host/path with a verdict; it fits its host and all subdomains when the
url's path starts with the rule's path, and the longest fitting rule wins. A url without a path
(http://host?x) does not start with the "/" of any rule, so none fits it. The list is the
caller's and part of the plan: a url is tested against each of its rules.

Urls that no listed rule fits are judged by association rules: FP-growth over the tokens of
labelled urls (host labels, path parts, query keys) finds token sets that come with a
verdict; rules need a least support and confidence, and a rule is pruned when a part of it
does at least as well. Tokens that stand in the very same labelled urls are one item (found by
fingerprints of their rows; the smallest one names it): any of them says as much as all, and
their combinations, which would double with each, are never mined. Rules are matched through
an inverted index: each rule is filed under its rarest item, a url probes with its items, and
the remaining items of the rule are compared as sets. Urls are first reduced to their distinct sets of indexed tokens, so a host
that makes up a third of all rows is matched once. The most confident rule decides (then the
best supported, then the smallest token list); without any, the verdict is ``default``.

Defined cases: a null url or one without ``://`` has empty host and path, fits no listed
rule and has no tokens, so it gets ``default``; a url of any length is read whole; with no
labelled rows nothing is mined; an id with several labels counts as ``allow`` if one of them is
(the smallest text); repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICT = "verdict="


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); the first :// is found without a backtracking pattern."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: h: labels of the host, p: all path parts (digits as #), q: query keys."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    labels = F.transform(F.array_distinct(F.split(host, r"\.")), lambda x: F.concat(F.lit("h:"), x))
    parts = F.array_distinct(F.filter(F.split(path, "/"), lambda x: x != ""))
    parts = F.transform(parts, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#")))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1)))
    known = F.filter(F.array_distinct(F.concat(labels, parts, keys)), lambda x: F.length(x) > 2)
    return F.when(F.locate("://", text) > 0, known).otherwise(F.array().cast("array<string>"))


def listed_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``listed`` (both null where no rule fits) to rows with host and path.

    ``rules``: (host/path, verdict) pairs. The lookup is a literal array: the list is the
    caller's, not data.
    """
    cut = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for r, v in rules]
    # Longest first (the rule text breaks ties), so the first that fits wins.
    cut.sort(key=lambda x: (-len(x[2]), x[2]))
    rule = verdict = None
    for host, path, name, v in reversed(cut):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(name)) if rule is None else F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)) if verdict is None else F.when(fits, F.lit(v)).otherwise(verdict)
    if rule is None:
        rule = verdict = F.lit(None).cast("string")
    return pages.withColumn("rule", rule).withColumn("listed", verdict)


def same_rows(labelled: DataFrame) -> DataFrame:
    """token, item: tokens that stand in the very same rows share an item, the smallest of them.

    A token's rows are compared by their number and two xor'ed hashes of the row.
    """
    rows = labelled.select(F.explode("tokens").alias("token"), "_row")
    prints = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("_row")).alias("h"), F.bit_xor(F.xxhash64(F.lit(3), "_row")).alias("g")
    )
    named = prints.groupBy("n", "h", "g").agg(F.min("token").alias("item"))
    return prints.join(named, ["n", "h", "g"]).select("token", "item")


def as_items(rows: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    """id, ``set``: the sorted distinct items of each row that has any."""
    found = rows.select(id_col, F.explode("tokens").alias("token")).join(items, "token")
    return found.groupBy(id_col).agg(F.array_sort(F.collect_set("item")).alias("set"))


def mine_rules(labelled: DataFrame, min_support=0.005, min_confidence=0.6) -> DataFrame:
    """rule_tokens, verdict, confidence, support, anchor from rows of ``tokens`` (items) and ``label``.

    FP-growth runs on the distinct items of each labelled url; the labels are two more items.
    """
    items = labelled.where(F.col("label").isNotNull()).select(
        F.array_union("tokens", F.array(F.concat(F.lit(VERDICT), "label"))).alias("items")
    )
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    single = staged(found.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq"))
    rules = staged(
        found.associationRules.where(F.col("consequent")[0].startswith(VERDICT))
        .where(F.forall("antecedent", lambda x: ~x.startswith(VERDICT)))
        .select(
            F.array_sort("antecedent").alias("rule_tokens"), F.expr(f"substring(consequent[0], {len(VERDICT) + 1})").alias("verdict"),
            "confidence", "support",
        )
    )
    # Pruned: a rule with the same verdict and one token less is at least as confident.
    smaller = rules.select(
        F.explode(F.transform("rule_tokens", lambda t: F.array_remove("rule_tokens", t))).alias("part"), "verdict", "confidence",
        F.col("rule_tokens").alias("whole"),
    )
    beaten = smaller.alias("a").join(
        rules.alias("b"), (F.col("a.part") == F.col("b.rule_tokens")) & (F.col("a.verdict") == F.col("b.verdict"))
    ).where("b.confidence >= a.confidence").select(F.col("a.whole").alias("rule_tokens"), F.col("a.verdict").alias("verdict")).distinct()
    left = rules.join(beaten, ["rule_tokens", "verdict"], "left_anti")
    # Filed under the rarest token.
    anchors = (
        left.select("rule_tokens", "verdict", F.explode("rule_tokens").alias("token")).join(single, "token")
        .groupBy("rule_tokens", "verdict").agg(F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    )
    return staged(left.join(anchors, ["rule_tokens", "verdict"]))


def match_rules(urls: DataFrame, rules: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    """id, mined, mined_rule, confidence: the best mined rule of each row that has one.

    ``urls`` has the id and ``tokens``.
    """
    known = rules.select(F.explode("rule_tokens").alias("item")).distinct()
    indexed = staged(as_items(urls, items.join(known, "item"), id_col))
    sets = indexed.select("set").distinct()
    hits = (
        sets.select("set", F.explode("set").alias("anchor")).join(rules, "anchor")
        .where(F.size(F.array_except("rule_tokens", "set")) == 0)
    )
    best = hits.groupBy("set").agg(
        F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "rule_tokens", "verdict")).alias("best")
    )
    return indexed.join(best, "set").select(
        id_col, F.col("best.verdict").alias("mined"), F.col("best.rule_tokens").alias("mined_rule"), (-F.col("best.c")).alias("confidence")
    )


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labels: DataFrame | None = None, id_col="page_id", url_col="url",
    default="allow", min_support=0.005, min_confidence=0.6,
) -> DataFrame:
    """id, host, path, rule, verdict, mined_rule, confidence for every row.

    ``labels`` (id, label) are verdicts known for some ids; rows decided by a listed rule
    count as labelled with its verdict.
    """
    host, path = split_url(F.col(url_col))
    base = pages.select(F.col(id_col), F.col(url_col).alias("_url"), host.alias("host"), path.alias("path"))
    judged = listed_verdicts(base, rules).withColumn("tokens", url_tokens(F.col("_url"), F.col("host"), F.col("path"))).drop("_url")
    judged = staged(judged.withColumn("_row", F.monotonically_increasing_id()))
    known = judged.where("listed is not null").select("_row", "tokens", F.col("listed").alias("label"))
    if labels is not None:
        voted = labels.groupBy(F.col(id_col).alias("_id")).agg(F.min("label").alias("label"))
        more = judged.where("listed is null").join(voted, judged[id_col] == voted["_id"]).select("_row", "tokens", "label")
        known = known.unionByName(more)
    known = staged(known)
    items = staged(same_rows(known))
    merged = known.join(as_items(known, items, "_row"), "_row", "left").select(
        F.coalesce("set", F.array().cast("array<string>")).alias("tokens"), "label"
    )
    mined = mine_rules(merged, min_support, min_confidence)
    open_ = judged.where("listed is null")
    hits = match_rules(open_.select("_row", "tokens"), mined, items, "_row")
    return judged.join(hits, "_row", "left").select(
        id_col, "host", "path", "rule", F.coalesce("listed", "mined", F.lit(default)).alias("verdict"),
        F.array_join("mined_rule", " ").alias("mined_rule"), "confidence",
    )
