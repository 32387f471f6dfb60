"""Not-modified revisits: which earlier full response a revisit record stands for.

An as-of join by canonical url: each revisit looks for the latest earlier full response.
Its validators must agree (the entity tag if both have one, weakly compared, else the date of
the last modification); then the revisit is resolved and gets the response's headers, in
which the revisit's own values replace or add those that a 304 may carry.

The join reduces both sides to distinct (url, time) first (one response and any number of
revisits of a url at one time need a single place), and runs a window over those. A url with
more than ``piece_rows`` distinct times is cut into pieces of time at its own quantiles; the
last response of each piece is handed on to the later ones through one row per piece. The
answer then returns to the revisits by an equi join on (url, time).

Defined cases: a null url, time or kind takes no part (verdict ``not_a_capture``); of several
responses at the same url and time the one with the largest record id counts; a response at
the very time of the revisit is not earlier; no earlier response: ``no_response``; validators
that differ, or none in common: ``changed`` or ``no_validator``; null headers are an empty
map, header names compare in lower case; repeated rows are resolved each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may update. Fixed values of the HTTP caching standard.
UPDATABLE = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Lower-case host without www., m. or blog.-less port; path without index file, .html or
    trailing slashes; no scheme, query or fragment."""
    rest = F.regexp_replace(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"(?s)[?#].*$", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/]*(/.*)$", 1), r"(/index)?(\.html?)?/*$", "")
    return F.concat(host, path)


def strong(tag: Column) -> Column:
    """An entity tag without its weakness mark, for weak comparison."""
    return F.regexp_replace(tag, "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the permitted headers of ``update`` in place of its own."""
    empty = F.create_map().cast("map<string,string>")
    allowed = F.map_filter(F.coalesce(update, empty), lambda k, v: F.lower(k).isin(*UPDATABLE) & v.isNotNull())
    names = F.transform(F.map_keys(allowed), lambda k: F.lower(k))
    kept = F.map_filter(F.coalesce(stored, empty), lambda k, v: ~F.array_contains(names, F.lower(k)))
    return F.map_from_entries(F.concat(F.map_entries(kept), F.map_entries(allowed)))


def _as_of(times: DataFrame, piece_rows: int) -> DataFrame:
    """url, at, found: the latest response before ``at``, from one row for each (url, at) with
    ``answer`` (a struct, null without a response)."""
    sizes = times.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high"))
    long = sizes.where(F.col("n") > piece_rows)
    borders = times.join(long.select("url"), "url", "left_semi").groupBy("url").agg(
        F.percentile_approx("at", [i / 64 for i in range(1, 64)], 2000).alias("borders")
    )
    cut = times.join(borders, "url", "left").withColumn(
        "piece", F.when(F.col("borders").isNull(), 0).otherwise(F.size(F.filter("borders", lambda b: b < F.col("at"))))
    ).drop("borders")
    inside = Window.partitionBy("url", "piece").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn("found", F.last("answer", ignorenulls=True).over(inside))
    ends = cut.where("answer is not null").groupBy("url", "piece").agg(F.max_by("answer", "at").alias("last"))
    # At most 64 pieces of a url.
    pieces = cut.select("url", "piece").distinct().join(ends, ["url", "piece"], "left")
    before = Window.partitionBy("url").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.withColumn("carried", F.last("last", ignorenulls=True).over(before)).drop("last")
    return here.join(carried, ["url", "piece"]).select("url", "at", F.coalesce("found", "carried").alias("found"))


def resolve_revisits(captures: DataFrame, piece_rows: int = 200_000) -> DataFrame:
    """One row per revisit or unusable capture.

    ``captures``: record_id, url, at, kind ('response' or 'revisit'), etag, last_modified,
    headers (map). Result: record_id, url (canonical), at, refers_to, verdict, headers.
    """
    usable = F.col("url").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin("response", "revisit")
    known = captures.select(
        "record_id", canonical_url(F.col("url")).alias("url"), "at", "kind", "etag", "last_modified", "headers",
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    taking = known.where("usable")
    key = F.when(F.col("kind") == "response", F.struct("record_id", "etag", "last_modified", "headers"))
    # Maps do not order: the largest id is picked first, the rest follows it.
    answers = taking.groupBy("url", "at").agg(F.max_by(key, F.when(F.col("kind") == "response", F.col("record_id"))).alias("answer"))
    found = _as_of(answers, piece_rows)
    revisits = taking.where("kind = 'revisit'").join(found, ["url", "at"])
    both_tags = F.col("etag").isNotNull() & F.col("found.etag").isNotNull()
    both_dates = F.col("last_modified").isNotNull() & F.col("found.last_modified").isNotNull()
    same = F.when(both_tags, strong(F.col("etag")) == strong(F.col("found.etag"))).when(
        both_dates, F.col("last_modified") == F.col("found.last_modified")
    )
    verdict = (
        F.when(F.col("found").isNull(), "no_response").when(same.isNull(), "no_validator")
        .when(same, "resolved").otherwise("changed")
    )
    resolved = verdict == "resolved"
    out = revisits.select(
        "record_id", "url", "at", F.when(resolved, F.col("found.record_id")).alias("refers_to"), verdict.alias("verdict"),
        F.when(resolved, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )
    rest = known.where("not usable").select(
        "record_id", "url", "at", F.lit(None).cast(dict(captures.dtypes)["record_id"]).alias("refers_to"),
        F.lit("not_a_capture").alias("verdict"), "headers",
    )
    return out.unionByName(rest)
