"""Run registered queries against their DuckDB oracles and print the differences.

    python tests/check_oracles.py [--sf 0.01] [name ...]
"""

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if hasattr(value, "asDict"):
        return plain(list(value))
    return str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_result(df):
    return table(df.columns, df.collect())


def duck_result(con, sql):
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    return table(names, done.fetchall())


# Spark type -> DuckDB type, where they are spelled differently.
SPELLINGS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql):
    """Columns whose types differ, as {name: (spark, duckdb)}."""
    ours = {c: SPELLINGS.get(t, t.upper()) for c, t in df.dtypes}
    theirs = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (ours.get(c), theirs.get(c)) for c in {*ours, *theirs} if ours.get(c) != theirs.get(c)}


def difference(left, right):
    """A short description of how two results differ, or None."""
    (names_a, rows_a), (names_b, rows_b) = left, right
    if names_a != names_b:
        return f"columns {names_a} vs {names_b}"
    if rows_a == rows_b:
        return None
    only_a = [r for r in rows_a if r not in set(rows_b)][:3]
    only_b = [r for r in rows_b if r not in set(rows_a)][:3]
    return f"{len(rows_a)} vs {len(rows_b)} rows {names_a}\n   spark only {only_a}\n   duck only  {only_b}"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from tidemark.session import build_session

    spark = build_session(
        "oracles", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con, oracles, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            got = spark_result(run(spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"rows {name:28s} {len(got[1]):8d} {took:6.2f}s", flush=True)
                continue
            diff = difference(got, duck_result(con, oracles[name]))
            mark = "ok  " if diff is None else "DIFF"
            bad += diff is not None
            print(f"{mark} {name:28s} {len(got[1]):8d} {took:6.2f}s {diff or ''}", flush=True)
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name:28s} {type(error).__name__}: {str(error)[:900]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
