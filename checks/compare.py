"""Run registered queries next to their SQL and report differences.

    python -m checks.compare [folder] [query ...]
"""

import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(v):
    if v is None or v != v:
        return "<null>"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, connection, folder, name, query, sql):
    """(ok, message, spark seconds)."""
    begin = time.time()
    df = query(spark, folder)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - begin
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL", took
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = sorted_rows(names, result.fetchall())
    wrong = {c: (t, types.get(c)) for c, t in df.dtypes if KINDS.get(t, t) != types.get(c)}
    if got[0] != want[0] or wrong:
        return False, f"columns {got[0]} / {want[0]} types {wrong}", took
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return False, (
            f"{len(got[1])} / {len(want[1])} rows; only here {sorted(a - b)[:3]}; only there {sorted(b - a)[:3]}"
        ), took
    return True, f"{len(got[1])} rows", took


def main():
    from pyspark.sql import SparkSession

    from checks import all_queries, all_sql

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    # Default settings on purpose: results must not lean on the package's own session.
    spark = (
        SparkSession.builder.appName("compare").master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    sqls, bad = all_sql(), 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            ok, message, took = compare(spark, connection, folder, name, query, sqls.get(name))
        except Exception as error:  # report and go on with the next query
            ok, message, took = False, f"{type(error).__name__}: {str(error)[:1500]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name:28s} {took:6.1f}s  {message}", flush=True)
    spark.stop()
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
