"""Small builders for the tests."""

from waymend.roles import BASE

STOPS = "row_id bigint, " + ", ".join(f"{c} string" for c in BASE)


def stops(spark, rows, start=0):
    """Rows as dicts of roles; missing roles are null, row_id counts up."""
    return spark.createDataFrame(
        [(i + start, *[r.get(c) for c in BASE]) for i, r in enumerate(rows)], STOPS
    )


def table(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
